"""Cell text, folding keys, quoted mail, references and web text.

Each key folds in its own way for its own use; they are kept apart on purpose.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CJK = "\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}"

#: Kinds of reference numbers and how each is spelled.
REFERENCES = {
    "sales_order": r"\bSO\d{7}\b",
    "quotation": r"\bQU\d{9}\b",
    "order_confirmation": r"\bOC\d{8}\b",
    "purchase_order": r"\bPO\d{7}\b",
    "supplier_contract": r"\bOBR\d{7}\b",
    "drawing": r"\b[3-5]-\d{3}-\d{3}-\d{4}\b",
}
#: Lines after which a mail only repeats older ones.
QUOTE_MARKERS = r"^(?:>|-{2,}\s*(?:Original Message|Forwarded message|Ursprüngliche Nachricht|原始邮件)|_{10,}$|(?:From|Von|发件人)\s*[:：].*@|On .+ wrote:\s*$|Am .+ schrieb.*:\s*$|.*写道\s*[:：]\s*$)"
REPLY_PREFIX = r"^(?:\s*(?:re|fw|fwd|aw|wg|答复|回复|转发)\s*[:：]\s*)+"


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition, which Spark has no function for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def without_accents(text: pd.Series) -> pd.Series:
    """Letters without their marks; all other characters stay."""

    def plain(t: str | None) -> str | None:
        if t is None:
            return None
        return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFKD", t) if unicodedata.category(c) != "Mn"))

    return text.map(plain)


def cell_text(text: Column) -> Column:
    """White space folded, ``12.0`` as ``12``, placeholders as null."""
    s = F.trim(F.regexp_replace(text, "[\\s\\u00a0]+", " "))
    s = F.regexp_replace(s, "^(-?\\d+)\\.0$", "$1")
    return F.when(~F.lower(s).isin("", "/", "-", "—", "none", "n/a", "not offer", "无", "暂无", "没有"), s)


def fold_key(text: Column) -> Column:
    """Small letters and digits of any script, nothing else."""
    return F.regexp_replace(F.lower(nfkc(text)), "[^\\p{L}\\p{N}]", "")


def label_key(text: Column) -> Column:
    """For header labels: small letters, single spaces, no colon at the ends."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(F.translate(text, "（）／", "()/")), "\\s+", " ")), "^[:： ]+|[:： ]+$", "")


def person_key(name: Column) -> Column:
    """A person's words in order of the alphabet, so that first and last name may be swapped."""
    words = F.filter(F.split(F.lower(name), "[^\\p{L}]+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def company_key(name: Column) -> Column:
    """For exact matches: no accents, bracket in front, legal form, marks or spaces."""
    s = F.regexp_replace(F.lower(without_accents(nfkc(name))), "^\\s*[(\\[（【][^)\\]）】]*[)\\]）】]", " ")
    s = F.regexp_replace(s, f"[^0-9a-z{CJK}]+", " ")
    s = F.regexp_replace(s, "有限责任公司|股份有限公司|有限公司|股份|集团|(?<![a-z])(?:co ltd|gmbh|inc|ltd)(?![a-z])", " ")
    return F.regexp_replace(s, "\\s", "")


def customer_codes(text: Column) -> Column:
    """Codes such as ``KD00123`` in capitals and without zeros in front."""
    found = F.regexp_extract_all(text, F.lit("(?<![A-Za-z0-9])0*([A-Za-z]{2,4}\\d{5,})(?!\\d)"), F.lit(1))
    return F.transform(found, lambda c: F.ltrim(F.upper(c), F.lit("0")))


def latin_alias(text: Column) -> Column:
    """A Latin name in brackets, or the Latin tail behind other script."""
    inside = F.regexp_extract(text, "[(（]\\s*([A-Za-z][A-Za-z0-9 .&-]{2,})\\s*[)）]", 1)
    tail = F.regexp_extract(text, f"[{CJK}]\\s*([A-Za-z][A-Za-z0-9 .&-]{{2,}})$", 1)
    return F.coalesce(F.nullif(F.trim(inside), F.lit("")), F.nullif(F.trim(tail), F.lit("")))


def has_cjk(text: Column) -> Column:
    return text.rlike(f"[{CJK}]")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", "-"), "^-+|-+$", "")


def plain_subject(subject: Column) -> Column:
    """Without ``Re:``, ``Fw:`` and their like."""
    return F.trim(F.regexp_replace(subject, f"(?i){REPLY_PREFIX}", ""))


def top_reply(body: Column, marker: str = QUOTE_MARKERS) -> Column:
    """The lines before the first that starts a quotation."""
    lines = F.split(F.regexp_replace(body, "\\r\\n?", "\n"), "\n")
    first = F.array_position(F.transform(lines, lambda x: x.rlike(marker)), F.lit(True)).cast("int")
    return F.trim(F.array_join(F.when(first > 0, F.slice(lines, F.lit(1), first - 1)).otherwise(lines), "\n"))


def quoted_history(body: Column, marker: str = QUOTE_MARKERS) -> Column:
    """What :func:`top_reply` leaves out."""
    lines = F.split(F.regexp_replace(body, "\\r\\n?", "\n"), "\n")
    first = F.array_position(F.transform(lines, lambda x: x.rlike(marker)), F.lit(True)).cast("int")
    return F.when(first > 0, F.array_join(F.slice(lines, first, F.size(lines)), "\n")).otherwise("")


def html_text(html: Column) -> Column:
    """The text of a mail's HTML part: breaks at blocks, no styles, scripts or tags."""
    s = F.regexp_replace(html, "(?is)<(script|style|head)\\b.*?</\\1>|<!--.*?-->", " ")
    s = F.regexp_replace(s, "(?i)<br\\s*/?>|</(?:p|div|tr|li|h[1-6])>", "\n")
    s = F.regexp_replace(s, "<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(char))
    s = F.regexp_replace(s, "[ \\t\\u00a0]+", " ")
    return F.trim(F.regexp_replace(s, " ?\\n[ \\n]*", "\n"))


def references(text: Column) -> Column:
    """``{kind: [numbers]}`` of the kinds that occur; ``S0`` in front of seven digits is read as ``SO``."""
    fixed = F.regexp_replace(text, r"\bS0(\d{7})\b", "SO$1")
    found = [F.struct(F.lit(k).alias("key"), F.array_sort(F.array_distinct(F.regexp_extract_all(fixed, F.lit(p), F.lit(0)))).alias("value")) for k, p in REFERENCES.items()]
    return F.map_from_entries(F.filter(F.array(*found), lambda e: F.size(e["value"]) > 0))


def follow_up_by(phrase: Column) -> Column:
    """Who "will follow up"."""
    return F.nullif(F.regexp_extract(phrase, r"(?i)^\s*([A-Za-z][\w. -]{0,40}?)\s+will\s+follow", 1), F.lit(""))


def sensitive(label: Column) -> Column:
    """Labels of columns that are never read."""
    return F.lower(label).rlike("税号|纳税人|开户银行|银行账号|账号|法人|身份证|护照|iban|\\bbank\\b|account no|tax id|passport|id card|salary|birth")


def script_spaced(text: Column) -> Column:
    """A space where the script changes between CJK and Latin."""
    s = F.regexp_replace(text, f"([{CJK}])([A-Za-z0-9])", "$1 $2")
    return F.regexp_replace(s, f"([A-Za-z0-9])([{CJK}])", "$1 $2")
