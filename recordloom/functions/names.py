"""Names written in two languages, and people's names out of mail headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CJK, has_cjk

#: Legal forms behind a name, in either script.
CHINESE_FORM = "(?:股份有限公司|有限责任公司|有限公司)"
LATIN_FORM = "(?:[Cc][Oo]\\.?,? ?[Ll][Tt][Dd]\\.?|GmbH|[Ii]nc\\.?|LLC|[Ll]imited|[Cc]orp(?:oration|\\.)?)"
ADDRESS_LABEL = "^(?i)(?:addr(?:ess)?|地址) *[:：] *"
#: Region codes in front of a mailbox, which make it an office and not a person.
REGIONS = "cn|vn|sh|bj|gz|sz|de|us|uk|in|jp|kr|th|my|sg|hk|tw|eu|ap|hq|it|fr|es|mx|br|ru"


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, "^[\\s,;，；(（]+|[\\s,;，；)）]+$", "")


def bilingual_cell(text: Column) -> Column:
    """``name, other_name, address`` of a customer cell of one to three lines; null for a cell of any other shape.

    The first line has the name; its name in the other script stands behind its
    legal form, in brackets or on a line of its own, an address behind its label.
    """
    lines = F.filter(F.transform(F.split(text, "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    first, rest = F.get(lines, 0), F.when(F.size(lines) > 1, F.slice(lines, 2, 4)).otherwise(F.array().cast("array<string>"))
    found = lambda name, other, address: F.struct(_trimmed(name).alias("name"), F.nullif(_trimmed(other), F.lit("")).alias("other_name"), F.nullif(F.trim(address), F.lit("")).alias("address"))
    none = F.lit(None).cast("string")
    part = lambda pattern, n: F.regexp_extract(first, pattern, n)
    chinese_first = f"^(.*[{CJK}].*?{CHINESE_FORM})\\s*([A-Za-z][^{CJK}]*[A-Za-z]{{3}}[^{CJK}]*)$"
    latin_first = f"^([^{CJK}]*?{LATIN_FORM})\\s*([{CJK}][^A-Za-z]*)$"
    bracketed = f"^(.*[{CJK}].*?{CHINESE_FORM})\\s*[(（]\\s*([A-Za-z].*?)\\s*[)）]?$"
    alias = F.when(first.rlike(bracketed), part(bracketed, 2))
    base = F.when(first.rlike(bracketed), part(bracketed, 1)).otherwise(first)
    labelled = F.filter(rest, lambda x: x.rlike(ADDRESS_LABEL))
    latin = F.filter(rest, lambda x: ~x.rlike(ADDRESS_LABEL) & ~has_cjk(x) & x.rlike(f"^[(（] *[A-Za-z].*[)）]$|{LATIN_FORM}$"))
    whole = (F.size(rest) <= 2) & (F.size(labelled) <= 1) & (F.size(latin) <= F.when(alias.isNull(), 1).otherwise(0)) & (F.size(labelled) + F.size(latin) == F.size(rest))
    other, address = F.coalesce(alias, F.get(latin, 0)), F.regexp_replace(F.get(labelled, 0), ADDRESS_LABEL, "")
    return (
        F.when((F.size(lines) == 1) & first.rlike(chinese_first), found(part(chinese_first, 1), part(chinese_first, 2), none))
        .when((F.size(lines) == 1) & first.rlike(latin_first), found(part(latin_first, 1), part(latin_first, 2), none))
        .when((F.size(lines) == 2) & ~has_cjk(first) & first.rlike(f"{LATIN_FORM}$") & has_cjk(F.get(lines, 1)) & ~F.get(lines, 1).rlike(ADDRESS_LABEL), found(first, F.get(lines, 1), none))
        .when(has_cjk(first) & whole & F.coalesce(other, address).isNotNull(), found(base, other, address))
    )


def person_name(name: Column, address: Column) -> Column:
    """A name as it is spoken: no brackets or quotes, ``Last, First`` turned round; from ``first.last@`` if there is none; else null."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), "\\([^)]*\\)|\\[[^\\]]*\\]|[\"']", " "), "\\s+", " "))
    local = F.substring_index(F.lower(address), "@", 1)
    spelled = F.when(local.rlike("^[a-z]+[._-][a-z]+$") & ~local.rlike(f"^(?:{REGIONS})[._-]"), F.initcap(F.regexp_replace(local, "[._-]", " ")))
    turned = "^([^,\\s]+(?: [^,\\s]+){0,2}), ?([^,\\s]+(?: [^,\\s]+){0,2})$"
    spoken = F.when(~has_cjk(plain) & plain.rlike(turned), F.regexp_replace(plain, turned, "$2 $1")).otherwise(plain)
    return F.when((plain == "") | plain.contains("@"), spelled).otherwise(spoken)
