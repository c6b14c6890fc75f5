"""Customer lists of several layouts: filled regions of a sheet, their layout by the labels they have, and typed rows.

A sheet may hold several tables, one below or beside the other.  Regions of filled
cells are found first; in each, rows near the top are tried as headers of every
layout, and the first layout that has all it needs reads the region.  Nothing is left
out without a row in the review.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CJK, label_key
from ..sources.shared import stored
from .headers import SHEET
from .lookups import roots

#: The labels of each layout in the order in which fields choose their columns; ``=`` asks for the whole label.
LAYOUTS: dict[str, dict[str, Sequence[str]]] = {
    "erp": {
        "code": ["=客户编码"], "cn": ["=客户名称"], "short": ["=客户简称"], "mnemonic": ["=助记码"], "area": ["=地区名称"], "industry": ["=所属行业"], "address": ["=地址"], "rep": ["=专营业务员名称"],
        "province": ["=省直辖市"], "note": ["=purpose_topics visit"], "contact": ["=联系人"], "phone": ["=电话"], "mobile": ["=手机"], "email": ["=email地址"],
    },
    "master": {
        "code": ["=customer code"], "cn": ["=cn name"], "en": ["=en name"], "province": ["=province"], "region": ["=region"], "area": ["=area"], "supporting": ["supporting"], "dealer": ["=dealer"], "first_order": ["first order"],
    },
    "supporting": {
        "cn": ["=客户 customer"], "en": ["company english"], "city": ["=city"], "province": ["=province"], "industry": ["industry segment"], "area": ["tables category"], "existing": ["existing customer"], "active": ["active status"],
        "rep": ["u8 as"], "supporting": ["supported by"],
    },
    "sections": {
        "cn": ["客户名称", "厂家名称"], "en": ["english name"], "place": ["地址", "产地"], "contact": ["联系人", "销售代表"], "phone": ["电话"], "application": ["主要应用型号"], "competitor": ["竞争对手"], "forecast": ["预测全年采购数量"],
        "possible": ["可能需求转台型号", "产品系列"], "region": ["所属区域"], "intel": ["已建立联系"],
    },
    "registration": {
        "cn": ["customer name", "客户名称"], "place": ["location", "地点"], "industry": ["industry", "所属行业"], "application": ["application", "应用"], "brand": ["current brand", "现使用"],
    },
}
#: What a header of a layout must have, in the order in which layouts are tried.
NEEDS = {"erp": ("code", "cn"), "master": ("code", "cn"), "supporting": ("cn", "existing"), "sections": ("cn", "en"), "registration": ("cn", "place", "application")}
#: A customer code inside other text, an identity or account number, a request to fill something in, and marks for nothing.
CODE = r"(?:^|[^A-Za-z0-9])0*([A-Za-z]{2,4}\d{5,})(?![A-Za-z0-9])"
ID_LIKE = r"^(?=[0-9A-Z]*\d)[0-9A-Z]{15,20}$|^\d{10,}$"
REQUEST = r"(?i)^\s*pl(?:ea)?se?\b.*\bfill\b"
PLACEHOLDER = r"(?i)^(?:[-—–/.]+|none|n/?a|无|暂无|没有)$"
FIELDS = ("code", "cn", "en", "short", "province", "city", "region", "industry", "address", "rep", "supporting", "dealer", "area", "first_order", "application", "competitor", "contact", "phone", "mobile", "email")
TEXTS = tuple(f for f in FIELDS if f not in ("code", "contact", "phone", "mobile", "email"))
HEADER_ROWS, TITLE_ROWS = 8, 3


@dataclass(frozen=True)
class Read:
    """``records`` and ``review`` of :func:`read`."""

    records: DataFrame
    review: DataFrame


def flat(cell: Column) -> Column:
    """A cell as one line: its lines joined by ``" / "``, marks for nothing gone; null if nothing is left."""
    lines = F.transform(F.split(cell, "\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    text = F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike(PLACEHOLDER)), " / ")
    return F.nullif(F.regexp_replace(text, r"^(-?\d+)\.0$", "$1"), F.lit(""))


def spaced(text: Column) -> Column:
    """A space where the script changes."""
    return F.regexp_replace(F.regexp_replace(text, f"([{CJK}）)])([A-Za-z])", "$1 $2"), f"([A-Za-z])([{CJK}])", "$1 $2")


def latin_tail(text: Column) -> Column:
    """The Latin words behind the last Chinese letter, null where there are none."""
    tail = F.btrim(F.regexp_replace(text, f"^.*[{CJK}]", ""), F.lit(" |/,;:()（）-"))
    return F.when(tail.rlike("[A-Za-z]{2}"), tail)


def regions(cells: DataFrame) -> DataFrame:
    """``cells`` that hold something, with ``block`` (its first row and column, as text), ``top`` and ``left``.

    Cells of a row that touch are a run; runs of neighbouring rows that touch, corners
    included, are one region; so is what lies wholly between the edges of a larger
    one (a value with empty cells around it).  Components are found by hooking every
    run to its least neighbour and following the hooks, round by round.
    """
    filled = cells.where(F.trim("text") != "")
    lane = Window.partitionBy(*SHEET, "row").orderBy("col")
    runs = filled.select(*SHEET, "row", "col").distinct().withColumn("g", F.col("col") - F.row_number().over(lane))
    runs = runs.groupBy(*SHEET, "row", "g").agg(F.min("col").alias("first"), F.max("col").alias("last"))
    name = F.format_string("%08d:%06d", "row", "first")
    runs = stored(runs.select(*SHEET, "row", "first", "last", F.to_json(F.struct(*SHEET, name.alias("at"))).alias("id")), "runs")
    below = runs.select(*SHEET, (F.col("row") - 1).alias("row"), F.col("first").alias("f"), F.col("last").alias("l"), F.col("id").alias("other"))
    edges = stored(runs.join(below, [*SHEET, "row"]).where("f <= last + 1 and l >= first - 1").select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")), "edges")
    named = runs.select("id", F.col("id").alias("root"))
    while not edges.isEmpty():
        hooks = named.select(F.col("root").alias("k")).distinct().join(edges.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("up")), "k", "left")
        ends = roots(hooks, "k", "up").select("k", F.col("root").alias("end"))
        named = stored(named.join(ends, named.root == ends.k).select("id", F.col("end").alias("root")), "named")
        of = lambda c, ends=ends: ends.select(F.col("k").alias(c), F.col("end").alias(f"{c}_end"))
        moved = edges.join(of("a"), "a").join(of("b"), "b").where("a_end <> b_end")
        edges = stored(moved.select(F.greatest("a_end", "b_end").alias("a"), F.least("a_end", "b_end").alias("b")).distinct(), "edges")
    placed = runs.join(named, "id")
    boxes = placed.groupBy(*SHEET, "root").agg(F.min("row").alias("top"), F.max("row").alias("bottom"), F.min("first").alias("left"), F.max("last").alias("right"))
    outer = boxes.select(*SHEET, F.col("root").alias("o_root"), *[F.col(c).alias(f"o_{c}") for c in ("top", "bottom", "left", "right")])
    inside = boxes.join(outer, list(SHEET)).where("root <> o_root and o_top <= top and bottom <= o_bottom and o_left <= left and right <= o_right")
    size = (F.col("o_bottom") - F.col("o_top") + 1) * (F.col("o_right") - F.col("o_left") + 1)
    # Of boxes around a box the largest, which lies in no other; of equal boxes the first.
    held = inside.groupBy(*SHEET, "root").agg(F.max_by(F.struct("o_root", "o_top", "o_left"), F.struct(size, -F.col("o_top"), -F.col("o_left"))).alias("o"))
    homes = boxes.join(held, [*SHEET, "root"], "left").select(*SHEET, "root", F.coalesce("o.o_top", "top").alias("top"), F.coalesce("o.o_left", "left").alias("left"))
    spans = placed.join(homes, [*SHEET, "root"]).select(*SHEET, "row", "first", "last", "top", "left")
    out = filled.join(spans, [*SHEET, "row"]).where("col between first and last").drop("first", "last")
    return out.withColumn("block", F.concat_ws(":", "top", "left"))


def headers(cells: DataFrame, layouts: Mapping[str, Mapping[str, Sequence[str]]] = LAYOUTS, needs: Mapping[str, Sequence[str]] = NEEDS) -> DataFrame:
    """``file, sheet, block, row, layout, votes, fields`` (field to column): rows of regions that are headers.

    Fields choose in their order, each the first column that fits and is still free.
    A region has one layout: the first in the list of ``needs`` that some row meets.
    ``sections`` may have several headers anywhere, other layouts one in the first eight rows.
    """
    labels = cells.where("text is not null").withColumn("key", label_key(F.col("text"))).where("key <> ''")
    row = [*SHEET, "block", "top", "row"]
    best = None
    for rank, (layout, need) in enumerate(needs.items()):
        words = layouts[layout]
        fit = lambda f, words=words: F.exists(F.array(*[(F.col("key") == w[1:]) if w.startswith("=") else F.col("key").contains(w) for w in words[f]]), lambda x: x)
        fields = F.array_compact(F.array(*[F.when(fit(f), F.lit(k)) for k, f in enumerate(words)]))
        rows = labels.select(*row, "col", fields.alias("fs")).where("size(fs) > 0").groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("col", "fs"))).alias("cols"))

        def choose(done: Column, f: Column) -> Column:
            free = F.filter("cols", lambda c: F.array_contains(c["fs"], f) & ~F.array_contains(F.transform(done, lambda d: d["col"]), c["col"]))
            return F.when(F.size(free) > 0, F.concat(done, F.array(F.struct(f.alias("f"), F.get(free, 0)["col"].alias("col"))))).otherwise(done)

        start = F.array().cast("array<struct<f:int,col:int>>")
        chosen = F.aggregate(F.array(*[F.lit(k) for k in range(len(words))]), start, choose)
        names = F.array(*[F.lit(f) for f in words])
        as_map = F.map_from_entries(F.transform("chosen", lambda c: F.struct(F.get(names, c["f"]).alias("field"), c["col"])))
        rows = rows.withColumn("cols", F.transform("cols", lambda c: F.struct(c["col"].cast("int").alias("col"), c["fs"].alias("fs")))).withColumn("chosen", chosen)
        rows = rows.select(*row, F.lit(layout).alias("layout"), F.lit(rank).alias("rank"), F.size("chosen").alias("votes"), as_map.alias("fields"))
        for f in need:
            rows = rows.where(F.col("fields")[f].isNotNull())
        if layout != "sections":
            rows = rows.where(F.col("row") < F.col("top") + HEADER_ROWS)
        best = rows if best is None else best.unionByName(rows)
    region = Window.partitionBy(*SHEET, "block")
    best = best.withColumn("least", F.min("rank").over(region)).where("rank = least")
    first = F.row_number().over(region.orderBy("row"))
    return best.withColumn("nth", first).where("layout = 'sections' or nth = 1").select(*SHEET, "block", "row", "layout", "votes", "fields")


def titles(cells: DataFrame, found: DataFrame) -> DataFrame:
    """``file, sheet, block, row, title``: the text nearest above a header, in the first column and at most three rows away."""
    left = cells.where((F.col("col") == 1) & flat(F.col("text")).isNotNull() & ~F.coalesce(flat(F.col("text")), F.lit("")).rlike(r"^[\d.]+$"))
    above = left.select(*SHEET, F.col("row").alias("at"), flat(F.col("text")).alias("title"))
    near = found.select(*SHEET, "block", "row").withColumn("at", F.explode(F.sequence(F.col("row") - TITLE_ROWS, F.col("row") - 1))).join(above, [*SHEET, "at"])
    return near.groupBy(*SHEET, "block", "row").agg(F.max_by("title", "at").alias("title"))


def read(cells: DataFrame) -> Read:
    """Records and review of all customer lists in ``cells`` (``file, sheet, row, col, text``).

    ``records``: ``file, sheet, block, row, layout, kind`` (``account``,
    ``competitor`` or ``lead``), the closed list of :data:`FIELDS`, ``existing,
    forecast, names, notes``.  ``review``: ``file, sheet, row, field, value, reason``;
    among the reasons are regions of ten cells or more without a known header
    (``unrecognised``) and sections that none of the kinds fits.  An empty
    table gives two empty tables.
    """
    placed = stored(regions(cells.select(*SHEET, "row", "col", "text")), "regions")
    found = stored(headers(placed), "headers")
    heads = found.join(titles(placed, found), [*SHEET, "block", "row"], "left")
    order = Window.partitionBy(*SHEET, "block").orderBy("row")
    heads = heads.withColumn("until", F.lead("row").over(order))
    has = lambda f: F.col("fields")[f].isNotNull()
    section = F.when(has("competitor"), F.when(F.col("title").rlike("(?i)新客户|new customers"), "new").otherwise("old")).when(has("intel"), "competitors").when(has("possible"), "exhibition")
    heads = heads.withColumn("kind", F.when(F.col("layout") == "sections", F.when(section.isin("new", "old"), "account").when(section == "competitors", "competitor").when(section == "exhibition", "lead")).when(F.col("layout") == "registration", "lead").otherwise("account"))
    heads = heads.withColumn("named", F.when(F.col("layout") == "sections", section).otherwise(F.col("layout"))).withColumnRenamed("row", "head")
    unknown = heads.where("kind is null").select(*SHEET, F.col("head").alias("row"), F.lit("section").alias("field"), F.coalesce(latin_tail(F.col("title")), "title").alias("value"), F.lit("unrecognised_section").alias("reason"))
    bare = placed.groupBy(*SHEET, "block", "top").agg(F.count("*").alias("n")).where("n >= 10").join(found.select(*SHEET, "block").distinct(), [*SHEET, "block"], "left_anti")
    bare = bare.select(*SHEET, F.col("top").alias("row"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), F.lit("unrecognised").alias("reason"))
    columns = heads.where("kind is not null").select(*SHEET, "block", "head", "until", "named", "kind", "title", F.explode("fields").alias("field", "col"))
    body = placed.join(columns, [*SHEET, "block", "col"]).where("row > head and (until is null or row < until)")
    every = sorted({f for words in LAYOUTS.values() for f in words})
    rows = body.groupBy(*SHEET, "block", "head", "row", "named", "kind", "title").agg(
        *[flat(F.max(F.when(F.col("field") == f, F.col("text")))).alias(f) for f in every],
        F.max(F.when(F.col("field") == "cn", F.col("text"))).alias("name_cell"),
    )
    intel = placed.join(columns.where("field = 'intel'").select(*SHEET, "block", "head", "col"), [*SHEET, "block", "col"]).where("row = head").select(*SHEET, "block", "head", flat(F.col("text")).alias("intel_label"))
    rows = stored(rows.join(intel, [*SHEET, "block", "head"], "left"), "rows")
    named, in_section = F.col("named"), F.col("named").isin("new", "old", "competitors", "exhibition")
    names = F.filter(F.transform(F.split("name_cell", "\r?\n"), flat), lambda x: x.isNotNull())
    first = F.when(in_section, F.get(names, 0)).otherwise(F.col("cn"))
    code = F.nullif(F.upper(F.regexp_extract(F.coalesce("code", F.lit("")), CODE, 1)), F.lit(""))
    beside = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("code", F.lit("")), CODE, " "), "[ /]+", " "))
    latin_only = ~F.coalesce(first, F.lit("")).rlike(f"[{CJK}]") & (in_section | (named == "registration"))
    en = F.when((named == "erp") & F.col("mnemonic").rlike("[A-Za-z]{3}.*[ .]"), F.col("mnemonic")).otherwise(F.col("en"))
    place = spaced(F.col("place"))
    note = lambda c, text: F.when(c, text)
    notes = F.array_compact(F.array(
        note((named == "erp") & F.col("industry").rlike("(?i)do not use"), F.lit("marked: do not use")),
        note(F.col("note").isNotNull(), F.concat(F.lit("topics: "), "note")),
        note(F.lower("active").isin("y", "n"), F.concat(F.lit("order placed: "), F.upper("active"))),
        note(F.col("active").isNotNull() & ~F.lower("active").isin("y", "n") & ~F.col("active").rlike(REQUEST), F.concat(F.lit("order placed: "), "active")),
        note(named == "competitors", F.concat_ws(". ", F.coalesce(latin_tail(F.col("title")), "title"), "intel_label")),
        note((named == "exhibition") & F.col("title").isNotNull(), F.coalesce(latin_tail(F.col("title")), "title")),
    ))
    units = F.regexp_extract(F.coalesce("forecast", F.lit("")), r"(?i)^\s*(\d+(?:\.\d+)?)\s*(?:台|pcs?|sets?|units?)?\s*$", 1)
    industry = F.when(~F.coalesce(F.col("industry").rlike("(?i)do not use"), F.lit(False)), F.col("industry"))
    city = F.coalesce(spaced(F.col("city")), F.when(in_section | (named == "registration"), place))
    ordered = F.regexp_replace("first_order", r"^(\d{4})[./-](\d{1,2})$", "$1-$2")
    one = {
        "code": code, "cn": F.when(~latin_only, first), "en": F.when(latin_only, F.coalesce("en", first)).otherwise(en), "province": spaced(F.col("province")), "city": city, "industry": industry,
        "first_order": ordered, "application": F.coalesce("application", "possible"),
    }
    typed = rows.select(
        *SHEET, "block", "row", F.col("named").alias("layout"), "kind", *[one.get(f, F.col(f)).alias(f) for f in FIELDS],
        F.when(F.lower("existing").isin("y", "yes"), True).when(F.lower("existing").isin("n", "no"), False).alias("existing"),
        F.nullif(units, F.lit("")).cast("double").alias("forecast"), F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0))).alias("names"), notes.alias("notes"),
        F.col("code").alias("code_cell"), beside.alias("beside"), F.col("active").alias("active_cell"), F.col("forecast").alias("forecast_cell"), F.col("industry").alias("industry_cell"),
    )
    is_id = lambda f: F.regexp_replace(F.coalesce(F.col(f), F.lit("")), " ", "").rlike(ID_LIKE)
    nameless = F.coalesce("cn", "en", F.when(F.col("layout") == "erp", F.lit(None)).otherwise(F.col("short"))).isNull()
    reason = F.when(nameless & (F.coalesce(*[F.col(f) for f in FIELDS]).isNull()), "blank").when((F.col("layout") == "erp") & F.col("cn").isNull() | nameless, "no_name").when((F.col("layout") == "erp") & F.col("code").isNull(), "no_code")
    typed = typed.withColumn("reason", reason)
    issue = lambda c, f, v, why: F.when(c, F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"), F.lit(why).alias("reason")))
    kept = F.col("reason").isNull()
    issues = F.array_compact(F.array(
        issue(F.col("reason") == "no_name", "cn", F.col("code_cell"), "no_name"), issue(F.col("reason") == "no_code", "code", F.col("code_cell"), "no_code"),
        issue(kept & F.col("code").isNotNull() & (F.col("beside") != ""), "code", F.col("code"), "code_cell_has_text"),
        issue(kept & F.col("industry_cell").rlike("(?i)do not use"), "industry", F.col("cn"), "do_not_use"),
        issue(kept & F.col("active_cell").rlike(REQUEST), "active", F.col("active_cell"), "instruction_not_data"),
        issue(kept & F.col("forecast_cell").isNotNull() & F.col("forecast").isNull(), "forecast", F.col("forecast_cell"), "forecast_not_a_number"),
        # A number of that kind is never shown, not even in the review.
        *[issue(kept & is_id(f), f, F.lit(""), "id_number_in_text_field") for f in TEXTS],
    ))
    review = typed.select(*SHEET, "row", F.inline(issues)).unionByName(unknown).unionByName(bare)
    records = typed.where(kept).withColumns({f: F.when(~is_id(f), F.col(f)) for f in TEXTS})
    return Read(records.drop("code_cell", "beside", "active_cell", "forecast_cell", "industry_cell", "reason"), review)


def leads_and_accounts(records: DataFrame, found: DataFrame) -> DataFrame:
    """``key, what, rows``: records under one key (``code``, else the name in small letters) as one ``account`` or ``lead``.

    A lead only if all of its rows are leads and the name is not among ``found``
    (names of known companies, in its first column).
    """
    name = F.lower(F.regexp_replace(F.coalesce("cn", "en", "short"), r"\s", ""))
    keyed = records.withColumn("key", F.coalesce(F.concat(F.lit("code:"), "code"), F.concat(F.lit("name:"), name)))
    known = found.select(F.concat(F.lit("name:"), F.lower(F.regexp_replace(F.col(found.columns[0]), r"\s", ""))).alias("key"), F.lit(True).alias("hit")).distinct()
    groups = keyed.groupBy("key").agg(F.bool_and(F.col("kind") == "lead").alias("leads"), F.count("*").alias("rows")).join(known, "key", "left")
    return groups.select("key", F.when(F.col("leads") & F.col("hit").isNull(), "lead").otherwise("account").alias("what"), "rows")


def file_kinds(cells: DataFrame) -> DataFrame:
    """``file, kind, layouts``: ``accounts`` with its layouts in order, or ``unrecognised``."""
    found = headers(regions(cells.select(*SHEET, "row", "col", "text"))).groupBy("file").agg(F.array_sort(F.collect_set("layout")).alias("layouts"))
    files = cells.select("file").distinct().join(found, "file", "left")
    return files.select("file", F.when(F.col("layouts").isNull(), "unrecognised").otherwise("accounts").alias("kind"), F.array_join("layouts", ", ").alias("layouts"))
