"""People's names: surnames by longest prefix, and names out of mail headers and signatures.

Surnames are a table, not a list in the code.  A name meets it through all its
beginnings, exploded and joined by equality; the longest known one wins.  That
holds for either script, and names are made distinct before they are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Forms of address, the last words of a firm's name, and common transliterated surnames.
SALUTATIONS = ("mr", "ms", "mrs", "mister", "miss")
LEGAL_TAIL = ("co", "ltd", "inc", "corp", "corporation", "limited", "gmbh", "llc", "plc", "group", "company")
LATIN_SURNAMES = (
    "zhang", "wang", "li", "liu", "chen", "yang", "huang", "zhao", "zhou", "wu", "xu", "sun", "ma", "zhu", "hu", "guo", "he", "lin", "gao", "luo", "qian", "tang", "song",
)
#: Endings that make a Chinese name an address, and words that make a text no person's name.
HONORIFIC = "(?:小姐|先生|女士|老师|经理|总监|总|工|姐|哥)$"
ROLE = (
    r"(?i)\b(?:services?|cent(?:er|re)|team|support|sales|info|invoice|billing|accounts?|accounting|department|dept|office|admin|purchasing|procurement|logistics|"
    r"customer|hotline|notification|system|user|group|china|shanghai|suzhou|gmbh|ltd|inc|co|company|express|import|export|airimport|inhouse|mailbox|reception|management|"
    r"consulting|automation|technology)\b|部|中心|团队|客服|发票|结算|公司|集团|商旅|管理|报告|系统|速运|官网"
)
#: Beginnings and whole later parts of shared mailboxes.
ROLE_START = (
    "^(?:sales|info|service|support|admin|office|contact|enquir|inquir|invoice|billing|account|finance|hr|purchas|marketing|export|import|logistic|order|shipping|customer|"
    "kefu|fapiao|bill|cs|team|hello|mail|webmaster|reception|bearing|airimport|wcn-|ncs|newcustomers|srm|erp|rpa|sap|system|robot|auto)"
)
ROLE_PARTS = (
    "finance helpdesk sales info service services support admin office invoice invoices billing account accounts accounting hr purchase purchasing marketing "
    "export import logistics order orders shipping customer team reception it"
).split()
SIGN_OFF = r"(?i)^\s*(?:(?:best|kind|warm|with kind|many)?\s*(?:regards|rgds|wishes|greetings)|best|thanks|thank you|sincerely.*|mit freundlichen gr\S+|viele gr\S+|谢谢|此致.*|顺祝.*|祝好)\s*[,，!.。]?\s*$"

HAN = "[\\x{4e00}-\\x{9fff}]"
_LATIN = r"^[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’\-]*\.?(?: [A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’\-]*\.?){1,3}$"
_SIGNED = rf"^((?:[A-Z][a-zà-ÿ]+|[A-Z]{{2,}})(?: (?:[A-Z][a-zà-ÿ]+|[A-Z]{{2,}})){{0,2}})\s*({HAN}{{2,4}})?$"
#: Region codes in front of a mailbox, which make it an office and not a person.
REGIONS = "cn|vn|sh|bj|gz|sz|de|us|uk|in|jp|kr|th|my|sg|hk|tw|eu|ap|hq|it|fr|es|mx|br|ru"


def _none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# ---- surnames


def name_words(name: Column) -> Column:
    """The words of a name in small letters, without a form of address in front and legal forms behind."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), rf"^(?:{'|'.join(SALUTATIONS)})(?:\.\s*|\s+|$)", "")
    words = F.filter(F.split(bare, r"[\s.,/\\]+"), lambda w: w != "")
    last = F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit(0).alias("keep")), lambda a, w: F.struct((a["n"] + 1).alias("n"), F.when(w.isin(*LEGAL_TAIL), a["keep"]).otherwise(a["n"] + 1).alias("keep")))
    return F.slice(words, F.lit(1), last["keep"])


def longest_prefix(texts: DataFrame, text: str, known: DataFrame, prefix: str) -> DataFrame:
    """``text, prefix``: the longest value of ``known`` that each distinct text begins with; texts without one are left out.

    Beginnings are as long as the longest known value, which is asked for once.
    """
    longest = known.agg(F.coalesce(F.max(F.length(prefix)), F.lit(0)).alias("n")).first()[0]
    values = known.select(F.col(prefix).alias("__p")).where("__p <> ''").distinct()
    distinct = texts.select(F.col(text).alias("__t")).where("__t <> ''").distinct()
    begun = distinct.select("__t", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("__t"), F.lit(max(1, longest)))), lambda i: F.substring("__t", F.lit(1), i))).alias("__p"))
    return begun.join(values, "__p").groupBy(F.col("__t").alias(text)).agg(F.max_by("__p", F.length("__p")).alias(prefix))


def surnames(people: DataFrame, name: str, known: DataFrame, surname: str) -> DataFrame:
    """``people`` with ``surname, given, surname_key, spelled_out, verdict``.

    ``verdict`` is ``first`` or ``last`` (a word of its own), ``run together`` (at
    the start of a single word), ``alone``, or a question: ``two surnames`` where
    first and last word are both known, ``unknown surname``, ``no name``.
    ``surname_key`` is what names are grouped by: the longest known beginning, or
    all letters where there is none.  A null name has no name; repeated rows stay.
    """
    known = known.select(F.lower(F.col(surname)).alias("surname"))
    rows = people.withColumn("__w", name_words(F.col(name))).withColumn("__all", F.array_join("__w", ""))
    first, last, n = F.get("__w", 0), F.element_at("__w", -1), F.size("__w")
    rows = rows.withColumn("__first", first).withColumn("__last", F.when(n > 0, last))
    begun = longest_prefix(rows, "__all", known, "surname").withColumnRenamed("surname", "__begun")
    exact = known.where("surname <> ''").distinct()
    rows = rows.join(begun, "__all", "left")
    rows = rows.join(exact.select(F.col("surname").alias("__first"), F.lit(True).alias("__is_first")), "__first", "left")
    rows = rows.join(exact.select(F.col("surname").alias("__last"), F.lit(True).alias("__is_last")), "__last", "left")
    is_first, is_last = (F.coalesce(F.col(c), F.lit(False)) for c in ("__is_first", "__is_last"))
    verdict = (
        F.when(n == 0, "no name")
        .when((n == 1) & F.col("__begun").isNull(), "unknown surname")
        .when(n == 1, F.when(F.col("__begun") == F.col("__all"), "alone").otherwise("run together"))
        .when(is_first & is_last & (F.col("__first") != F.col("__last")), "two surnames")
        .when(is_first, "first").when(is_last, "last").otherwise("unknown surname")
    )
    rows = rows.withColumn("verdict", verdict)
    v = F.col("verdict")
    found = F.when(v == "first", F.col("__first")).when(v == "last", F.col("__last")).when(v.isin("alone", "run together"), F.col("__begun"))
    rest = F.when(v == "first", F.array_join(F.slice("__w", F.lit(2), n), " ")).when(v == "last", F.array_join(F.slice("__w", F.lit(1), n - 1), " "))
    rest = rest.when(v == "run together", F.expr("substring(__all, length(__begun) + 1)"))
    spelled = (n >= 2) | (v == "run together")
    return rows.select(*people.columns, found.alias("surname"), rest.alias("given"), F.coalesce("__begun", "__all").alias("surname_key"), spelled.alias("spelled_out"), "verdict")


# ---- names out of headers and signatures


def is_role_address(address: Column) -> Column:
    """A shared mailbox: begins like one, has two digits, or a later part that is one."""
    local = F.substring_index(F.lower(address), "@", 1)
    parts = F.split(local, "[._-]")
    later = F.exists(F.slice(parts, F.lit(2), F.size(parts)), lambda p: p.isin(*ROLE_PARTS))
    return F.coalesce(local.rlike(ROLE_START) | (F.regexp_count(local, F.lit("[0-9]")) >= 2) | later | (F.get(parts, 0) == "it"), F.lit(False))


def _han_shaped(c: Column) -> Column:
    return c.rlike(f"^{HAN}{{2,4}}$") & ~c.rlike(ROLE) & ~c.rlike(HONORIFIC)


def _latin_shaped(c: Column) -> Column:
    return c.rlike(_LATIN) & ~c.rlike(ROLE)


def _titled(c: Column) -> Column:
    return F.when(c == F.lower(c), F.initcap(c)).otherwise(c)


def _spoken(c: Column) -> Column:
    """``Last, First`` turned round where it is one comma and no Chinese."""
    turned = r"^([^,\s]+(?: [^,\s]+){0,2}) ?, ?([^,\s]+(?: [^,\s]+){0,2})$"
    return F.when(~c.rlike(HAN), F.regexp_replace(c, turned, "$2 $1")).otherwise(c)


def address_name(address: Column) -> Column:
    """``first.last@`` as a name, but for offices of a region; else null."""
    local = F.substring_index(address, "@", 1)
    return F.when(local.rlike("^[a-z]+[._-][a-z]+$") & ~local.rlike(f"^(?:{REGIONS})[._-]"), F.initcap(F.regexp_replace(local, "[._-]", " ")))


def header_shapes(display: Column, address: Column) -> Column:
    """``latin, hans, native`` of a display name: what has the shape of a name in either script, before surnames are looked up.

    ``hans`` are spellings that may stand for the whole name, ``native`` one in
    brackets behind it; with ``both``, the Latin one holds only together with them.
    """
    quoted = "^[\"' ]+|[\"' ]+$"
    raw = F.regexp_replace(F.trim(F.coalesce(display, F.lit(""))), quoted, "")
    bracketed = F.regexp_extract(raw, f"[(（]({HAN}{{2,4}})[)）]", 1)
    native = F.when(_han_shaped(bracketed), bracketed)
    raw = F.when(F.lower(raw).isin("") | (F.lower(raw) == F.lower(F.substring_index(address, "@", 1))) | (F.lower(raw) == F.lower(address)), "").otherwise(raw)
    raw = F.trim(F.regexp_replace(F.regexp_replace(raw, r"\s*[(（][^)）]*[)）]", ""), r"\s+", " "))
    pair = rf"^([A-Za-z][A-Za-z'\-]+(?: [A-Za-z][A-Za-z'\-]+){{1,2}}) ({HAN}{{2,4}})$"
    parts = F.filter(F.transform(F.split(raw, "/"), F.trim), lambda p: p != "")
    latin = F.get(F.filter(F.transform(parts, _spoken), _latin_shaped), 0)
    hans = F.filter(parts, _han_shaped)
    plain = F.when(raw.contains("@") | (raw == ""), address_name(address)).otherwise(_spoken(raw))
    is_pair = raw.rlike(pair) & _latin_shaped(F.regexp_extract(raw, pair, 1))
    shaped = lambda a, b, c, both: F.struct(a.alias("latin"), b.alias("hans"), c.alias("native"), F.lit(both).alias("both"))
    none = F.lit(None).cast("string")
    return (
        F.when(is_pair, shaped(_titled(F.regexp_extract(raw, pair, 1)), F.filter(F.array(F.regexp_extract(raw, pair, 2)), _han_shaped), none, True))
        .when(raw.contains("/"), shaped(_titled(latin), hans, native, False))
        .otherwise(shaped(F.when(_latin_shaped(plain), _titled(plain)), F.filter(F.array(plain), _han_shaped), F.when(_latin_shaped(plain), native), False))
    )


def signature_shapes(text: Column) -> Column:
    """``latin, hans, native, both`` (as in :func:`header_shapes`) from the two lines after the last sign-off, or of the last eighteen lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n")
    at = F.coalesce(F.array_max(F.transform(lines, lambda x, i: F.when(x.rlike(SIGN_OFF), i + 1))), F.greatest(F.size(lines) - 18, F.lit(0)))
    block = F.filter(F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0))), lambda x: F.trim(x) != "")

    def named(line: Column) -> Column:
        parts = F.transform(F.split(F.regexp_replace(line, r"\s*[(（].*$|^[ ,]+|[ ,]+$", ""), r"\s*/\s*|\s{2,}|\t"), F.trim)
        greeting = r"(?i)\b(?:best|regards|rgds|thanks|dear|hello|hi)\b"
        good = F.filter(parts, lambda p: p.rlike(_SIGNED) & ~F.regexp_extract(p, _SIGNED, 1).rlike(rf"^[A-Z]+$|{greeting}") & ~F.regexp_extract(p, _SIGNED, 1).rlike(ROLE) & ~p.rlike(SIGN_OFF))
        latin = _none_if_empty(F.regexp_extract(F.get(good, 0), _SIGNED, 1))
        beside = F.filter(F.array(F.regexp_extract(F.coalesce(F.get(good, 0), F.lit("")), _SIGNED, 2)), _han_shaped)
        return F.struct(latin.alias("latin"), F.concat(beside, F.filter(parts, _han_shaped)).alias("hans"))

    two = F.transform(F.slice(block, F.lit(1), F.lit(2)), named)

    def joined(x: Column) -> Column:
        a, b = F.get(x, 0), F.get(x, 1)
        nothing = a["latin"].isNull() & (F.coalesce(F.size(a["hans"]), F.lit(0)) <= 0)
        latin = F.when(~nothing, F.coalesce(a["latin"], b["latin"]))
        empty = F.array().cast("array<string>")
        hans = F.when(nothing, empty).when(F.size(a["hans"]) > 0, a["hans"]).otherwise(F.coalesce(b["hans"], empty))
        return F.struct(latin.alias("latin"), F.coalesce(hans, empty).alias("hans"), F.lit(None).cast("string").alias("native"), F.lit(False).alias("both"))

    return F.transform(F.array(two), joined)[0]


def settled(rows: DataFrame, shapes: str, keys: list[str], han_surnames: DataFrame, surname: str) -> DataFrame:
    """``keys, latin, han`` for each row: a Chinese spelling counts only if it begins with a known surname (the longest-prefix join).

    Rows are told apart by ``keys``; rows without either spelling are left out.
    """
    spellings = rows.select(*keys, F.col(f"{shapes}.latin").alias("latin"), F.col(f"{shapes}.both").alias("both"), F.posexplode_outer(F.array_compact(F.array_append(f"{shapes}.hans", F.col(f"{shapes}.native")))).alias("at", "han"))
    known = longest_prefix(spellings, "han", han_surnames, surname).where(F.length("han") > F.length(surname))
    checked = spellings.join(known.select("han", F.lit(True).alias("known")), "han", "left")
    best = F.min_by("han", F.when(F.col("known"), F.col("at")))
    out = checked.groupBy(*keys).agg(F.first("latin").alias("latin"), F.first("both").alias("both"), best.alias("han"))
    return out.where((F.col("latin").isNotNull() | F.col("han").isNotNull()) & ~(F.col("both") & F.col("han").isNull())).drop("both")


def _words_of(name: Column) -> Column:
    return F.filter(F.array_sort(F.array_distinct(F.split(F.lower(name), r"[^\p{L}]+"))), lambda w: w != "")


def names_of_senders(messages: DataFrame, key: str, address: str, display: str, text: str, order: str, han_surnames: DataFrame, surname: str = "surname", colleagues: DataFrame | None = None) -> DataFrame:
    """``address, name, native, source, review``: what the owner of each address is called.

    The most frequent header name counts, the first seen on a tie (then ``review``
    says so); a signature that spells the same person out in full replaces it.
    Without a header name a signature does: a full name at once, a lone first name
    seen twice and not in a shared mailbox.  Then ``first.last@``, and what is left
    is a ``mailbox``.  Signatures that name one of ``colleagues`` (a column of
    names) are quoted replies and do not count.  Null addresses are left out.
    Votes are counted before they are dealt out, so a busy address is a few rows a task.
    """
    rows = messages.where(F.col(address).isNotNull()).select(F.col(key).alias("key"), F.col(address).alias("address"), F.col(order).alias("at"), F.col(display).alias("display"), F.col(text).alias("text"))
    at = rows.select("key", "address", "at")
    # Where the header says nothing, the name in the address waits for the signatures.
    said = rows.where(F.trim(F.coalesce("display", F.lit(""))) != "").withColumn("s", header_shapes(F.col("display"), F.lit("")))
    heads = settled(said, "s", ["key"], han_surnames, surname).join(at, "key")
    head_votes = heads.groupBy("address", F.coalesce("latin", "han").alias("name"), F.when(F.col("latin").isNotNull(), F.col("han")).alias("native")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    by_name = head_votes.groupBy("address", "name").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.min_by("native", F.when(F.col("native").isNotNull(), F.struct((-F.col("n")).alias("n"), "first"))).alias("native"))
    order_of = F.struct((-F.col("n")).alias("n"), F.col("first"), F.col("name"))
    header = by_name.groupBy("address").agg(
        F.min_by(F.struct("name", "native"), order_of).alias("head"),
        F.max("n").alias("most"), F.collect_list(F.struct("n", "name")).alias("votes"),
    )
    header = header.select("address", "head.*", (F.size(F.filter("votes", lambda v: v["n"] == F.col("most"))) > 1).alias("tied"))
    signs = settled(rows.where("text is not null").withColumn("s", signature_shapes(F.col("text"))), "s", ["key"], han_surnames, surname).join(at, "key")
    votes = signs.groupBy("address", "latin", "han").agg(F.count("*").alias("n"), F.min("at").alias("first")).withColumn("words", _words_of(F.coalesce("latin", "han")))
    if colleagues is not None:
        votes = votes.join(colleagues.select(_words_of(F.col(colleagues.columns[0])).alias("words")).distinct(), "words", "left_anti")
    votes = votes.withColumn("strong", F.col("han").isNotNull() | F.coalesce(F.col("latin").contains(" "), F.lit(False)))
    nth = F.struct((-F.col("n")).alias("n"), F.col("first"), F.coalesce("latin", F.lit("")).alias("latin"), F.coalesce("han", F.lit("")).alias("han"))
    longer = votes.join(header.select("address", _words_of(F.col("name")).alias("head_words")), "address")
    longer = longer.where("strong and latin is not null and size(head_words) > 0 and size(words) > size(head_words) and size(array_except(head_words, words)) = 0")
    longer = longer.groupBy("address").agg(F.min_by("latin", nth).alias("longer"))
    role = is_role_address(F.col("address"))
    usable = F.col("strong") | ((F.col("n") >= 2) & ~role & (F.length("latin") > 3))
    signed = votes.where(usable).groupBy("address").agg(F.min_by(F.struct("latin", "han"), nth).alias("signed"))
    out = at.select("address").distinct().join(header, "address", "left").join(longer, "address", "left").join(signed, "address", "left")
    from_address = F.when(~role, F.when(_latin_shaped(address_name(F.col("address"))), address_name(F.col("address"))))
    source = F.when(F.col("longer").isNotNull() | (F.col("name").isNull() & F.col("signed").isNotNull()), "signature").when(F.col("name").isNotNull(), "header").when(from_address.isNotNull(), "address").otherwise("mailbox")
    chosen = F.coalesce("longer", "name", "signed.latin", "signed.han", from_address, F.col("address"))
    native = F.when(F.col("name").isNotNull(), F.col("native")).when(F.col("signed.latin").isNotNull(), F.col("signed.han"))
    review = F.when(F.coalesce(F.col("tied"), F.lit(False)) & F.col("longer").isNull(), "header names tie").when(source == "mailbox", "no name")
    return out.select("address", chosen.alias("name"), native.alias("native"), source.alias("source"), review.alias("review"))
