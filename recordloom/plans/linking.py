"""Queries: blocks, joins, plans, comparison of sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import blocks, lookups, planning
from .registry import query

BY_USER, IN_ORDER = ["user_id"], ["ts", "event_id"]


@query("select event_id, user_id, row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) - 1 ordinal, cast(cast(ts as date) as timestamp) + to_hours(9 + 2 * (row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) - 1)) slot from events")
def order_in_day(t):
    """A user's events of a day in order, with a two-hour slot for each."""
    rows = blocks.ordinals(t("events"), ["user_id", F.col("ts").cast("date")], IN_ORDER)
    return rows.select("event_id", "user_id", F.col("ordinal").cast("bigint").alias("ordinal"), blocks.slots(F.col("ts").cast("date"), F.col("ordinal")).alias("slot"))


_NUMBERED = """(select *, sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) block,
  row_number() over (partition by user_id order by ts, event_id) pos from events)"""
_SPANS = f"(select user_id, block, min(pos) as first, max(pos) as last, count(*) items from {_NUMBERED} where block > 0 group by all)"


def _positions(t):
    return blocks.ordinals(t("events"), BY_USER, IN_ORDER, "pos").withColumn("pos", (F.col("pos") + 1).cast("bigint"))


@query(f"select user_id, cast(block as bigint) block, first, last, items from {_SPANS}")
def block_segments(t):
    return blocks.block_spans(_positions(t), BY_USER, IN_ORDER, F.col("event_type") == "signup", "pos")


@query(f"select e.event_id, e.user_id, cast(s.block as bigint) block from {_NUMBERED} e join {_SPANS} s on e.user_id = s.user_id and e.pos between s.first and s.last where e.event_type = 'error'")
def interval_attach(t):
    rows = _positions(t)
    spans = blocks.block_spans(rows, BY_USER, IN_ORDER, F.col("event_type") == "signup", "pos")
    return blocks.attach_to_intervals(rows.where("event_type = 'error'"), spans, BY_USER, "pos").select("event_id", "user_id", "block")


@query("select event_id, last_value(case when event_type = 'signup' then value end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) label from events")
def fill_down(t):
    value = F.when(F.col("event_type") == "signup", F.col("value"))
    return blocks.fill_down(t("events"), BY_USER, IN_ORDER, value, "label").select("event_id", "label")


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def missing_in_target(t):
    return lookups.missing(t("orders"), t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity >= 49)")
def used_dimension(t):
    facts = t("lineitem").where("l_returnflag = 'R' and l_quantity >= 49").withColumnRenamed("l_partkey", "p_partkey")
    return lookups.used(t("part"), facts, ["p_partkey"]).select("p_partkey", "p_name")


@query("""with a as (select c_custkey, unnest([upper(c_name), replace(c_name, '#', ' '), c_name]) as name, unnest([0, 1, 2]) alias_pos from customer),
  k as (select case when c_custkey % 3 = 0 then c_name when c_custkey % 3 = 1 then replace(c_name, '#', ' ') end as name, c_custkey target from customer)
  select c_custkey, arg_min(target, (alias_pos, target)) target, min(alias_pos) alias_pos from a join k on a.name = k.name group by all""")
def alias_join(t):
    """Three spellings of a customer; the first that the target knows counts, and a third of them is unknown."""
    c = t("customer")
    spaced = F.replace("c_name", F.lit("#"), F.lit(" "))
    rows = c.select("c_custkey", F.array(F.upper("c_name"), spaced, F.col("c_name")).alias("aliases"))
    known = c.select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, spaced).alias("name"), F.col("c_custkey").alias("target")).where("name is not null")
    return lookups.first_alias(rows, "c_custkey", "aliases", known, "name", "target")


@query("""with n as (select distinct p_name from part), k as (select p_name, count(distinct p_partkey) n, min(p_partkey) one from part where p_size > 40 and p_retailprice > 1500 group by all)
  select p_name, case when n = 1 then one end p_partkey, case when n is null then 'none' when n = 1 then 'unique' else 'ambiguous' end state from n left join k using (p_name)""")
def unique_or_ambiguous(t):
    return lookups.unique_match(t("part"), "p_name", t("part").where("p_size > 40 and p_retailprice > 1500"), "p_partkey")


@query("""with n as (select distinct p_name from part) select a.p_name a, b.p_name b, levenshtein(a.p_name, b.p_name) as distance from n a join n b on a.p_name < b.p_name
  and (levenshtein(a.p_name, b.p_name) <= 2 or string_split(a.p_name, ' ')[-1] = string_split(b.p_name, ' ')[-1])""")
def lookalike_pairs(t):
    """Part names that share their noun or differ in two letters at most.

    Names two edits apart give one text when two letters or less are taken from each, so
    pairs meet on equal texts of that kind, or on an equal noun.
    """
    names = t("part").select(F.col("p_name").alias("a")).distinct()
    less = lambda text: F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    once = F.array_distinct(less(F.col("a")))
    deleted = F.array_distinct(F.concat(F.array("a"), once, F.flatten(F.transform(once, less))))
    keyed = names.select("a", F.explode(F.array_append(deleted, F.concat(F.lit("noun:"), F.element_at(F.split("a", " "), -1)))).alias("key"))
    pairs = keyed.join(keyed.withColumnRenamed("a", "b"), "key").where("a < b").select("a", "b").distinct()
    noun = F.element_at(F.split("a", " "), -1) == F.element_at(F.split("b", " "), -1)
    return pairs.withColumn("distance", F.levenshtein("a", "b").cast("bigint")).where(noun | (F.col("distance") <= 2))


@query("""with o as (select o_orderkey, cast(o_orderdate as date) ref, day(o_orderdate) d, month(o_orderdate) m, year(o_orderdate) y from orders),
  c as (select o_orderkey, ref + 3 as r, make_date(y, m, d) a, case when d <= 12 then make_date(y, d, m) end b from o)
  select o_orderkey, case when b is null or abs(a - r) <= abs(b - r) then a else b end as day, b is not null and b <> a ambiguous from c""")
def nearest_date(t):
    """Order dates written day first: both readings, and the one nearest to a day of the same week."""
    from ..functions.dates import make_day

    day = F.col("o_orderdate").cast("date")
    rows = t("orders").select("o_orderkey", F.date_add(day, 3).alias("ref"), F.year(day).alias("y"), F.dayofmonth(day).alias("d"), F.month(day).alias("m"))
    both = rows.select("o_orderkey", "ref", make_day(F.col("y"), F.col("m"), F.col("d")).alias("a"), make_day(F.col("y"), F.col("d"), F.col("m")).alias("b"))
    best = lookups.nearest_of(F.array("a", "b"), F.col("ref"))
    return both.select("o_orderkey", best["day"].alias("day"), F.coalesce(F.col("b").isNotNull() & (F.col("a") != F.col("b")), F.lit(False)).alias("ambiguous"))


@query("""with h as (select o_orderkey, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end p, case when o_orderkey % 10 = 0 then cast(o_orderdate as date) + 1 else cast(o_orderdate as date) end s from orders where o_orderdate < timestamp '1998-01-01')
  select o.o_orderkey, case when h.o_orderkey is null then 'create' when h.p = o.o_totalprice then 'same' when h.s > cast(o.o_orderdate as date) then 'newer' else 'update' end as action from orders o left join h using (o_orderkey)""")
def upsert_plan(t):
    """Orders against a target that lacks the newest year and holds some other prices."""
    rows = t("orders").withColumn("s", F.col("o_orderdate").cast("date"))
    held = rows.where(F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'")).withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    held = held.withColumn("s", F.when(F.col("o_orderkey") % 10 == 0, F.date_add("s", 1)).otherwise(F.col("s")))
    return planning.decide(rows, held, "o_orderkey", "s", ["o_totalprice"])


@query("select distinct o_custkey, 'zero' as action from orders where o_orderdate < timestamp '1998-07-01' and o_custkey not in (select o_custkey from orders where o_orderdate >= timestamp '1998-07-01')")
def paid_to_zero(t):
    at = F.expr("TIMESTAMP_NTZ'1998-07-01 00:00:00'")
    return planning.zero_missing(t("orders").where(F.col("o_orderdate") < at), t("orders").where(F.col("o_orderdate") >= at), "o_custkey")


@query("""with h as (select o_custkey, list(distinct o_orderpriority order by o_orderpriority) have from orders where o_orderdate < timestamp '1998-07-01' group by all),
  n as (select o_custkey, list(distinct o_orderpriority order by o_orderpriority) new from orders where o_orderdate >= timestamp '1998-07-01' group by all)
  select o_custkey, array_to_string(list_concat(have, list_filter(new, lambda x: not list_contains(have, x))), ',') merged, have[1] primary_value from h join n using (o_custkey)""")
def reachability_merge(t):
    """Values held keep their order and the first stays primary; new ones go behind."""
    at = F.expr("TIMESTAMP_NTZ'1998-07-01 00:00:00'")
    side = lambda df, name: df.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias(name))
    both = side(t("orders").where(F.col("o_orderdate") < at), "have").join(side(t("orders").where(F.col("o_orderdate") >= at), "new"), "o_custkey")
    return both.select("o_custkey", F.array_join(planning.extended(F.col("have"), F.col("new")), ",").alias("merged"), F.col("have")[0].alias("primary_value"))


_ACTUAL = """(select o_orderkey k, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end st, o_orderpriority pr from orders where o_orderkey % 11 <> 0
  union all select o_orderkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end, o_orderpriority from orders where o_orderkey % 13 = 0 and o_orderkey % 11 <> 0
  union all select -o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 17 = 0)"""
_FOUND = f"""(with e as (select o_orderkey k, count(*) n, min(o_orderstatus) st, min(o_orderpriority) pr from orders group by all), a as (select k, count(*) n, min(st) st, min(pr) pr from {_ACTUAL} group by all),
  b as (select coalesce(e.k, a.k) k, e.n ne, a.n na, e.st e_st, a.st a_st, e.pr e_pr, a.pr a_pr from e full join a on e.k = a.k),
  f as (select k, ne, na, 'st' field, e_st expected, a_st actual from b union all select k, ne, na, 'pr', e_pr, a_pr from b)
  select k, field, expected, actual, case when na is null then 'MISSING' when ne is null then 'EXTRA' when na > ne then 'DUPLICATE' when expected is not distinct from actual then 'VERIFIED' else 'CHANGED' end status from f)"""


def _findings(t):
    rows = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pr"))
    some = rows.where("k % 11 <> 0").withColumn("st", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("st")))
    actual = some.unionByName(some.where("k % 13 = 0")).unionByName(rows.where("k % 17 = 0").withColumn("k", -F.col("k")))
    return planning.reconcile(rows, actual, "k", ["st", "pr"])


@query(f"select * from {_FOUND} where status <> 'VERIFIED'")
def reconcile(t):
    """Orders against a copy with lost, changed, doubled and added rows: all that is not verified."""
    return _findings(t).where("status <> 'VERIFIED'")


@query(f"""select field, count(*) filter (status = 'VERIFIED') verified, count(*) filter (status = 'CHANGED') changed, count(*) filter (status = 'MISSING') missing,
  count(*) filter (status = 'EXTRA') extra, count(*) filter (status = 'DUPLICATE') duplicate from {_FOUND} group by field""")
def reconcile_table(t):
    return planning.cross_tab(_findings(t), ["VERIFIED", "CHANGED", "MISSING", "EXTRA", "DUPLICATE"])


@query("""with a as (select doc_id, quality, toxic from labels), b as (select doc_id, case when n_chars < 300 then 0 else 1 end quality, 0 toxic from documents)
  select coalesce(a.doc_id, b.doc_id) doc_id, case when a.doc_id is null or b.doc_id is null then 'single' when a.quality = b.quality and a.toxic = b.toxic then 'agree' else 'disputed' end state,
  case when a.doc_id is not null and b.doc_id is not null and not (a.quality = b.quality and a.toxic = b.toxic) then concat_ws(',', case when a.quality <> b.quality then 'quality' end, case when a.toxic <> b.toxic then 'toxic' end) end differing
  from a full join b on a.doc_id = b.doc_id""")
def consensus(t):
    """Labels, which cover some documents, against a guess from the length of each."""
    a = t("labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    b = t("documents").select("doc_id", F.when(F.col("n_chars") < 300, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    return planning.consensus(a, b, "doc_id", ["quality", "toxic"])


@query()
def overlap_assignment(t):
    """Documents of a case (fifty neighbours) paired greedily with others by the long words they share."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), "[^\\p{L}]+"), lambda w: F.length(w) >= 12))
    rows = t("documents").where("text is not null").select("doc_id", F.floor(F.col("doc_id") / 50).alias("grp"), words.alias("words"))
    left, right = rows.where("doc_id % 2 = 0").withColumnRenamed("doc_id", "left_id"), rows.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "right_id")
    return lookups.greedy_overlap(left, right, "grp", "left_id", "right_id", "words")


@query("""with recursive m as (select conv_id * 1000 + turn id, case when turn > 0 then conv_id * 1000 + turn - 1 end up from conversations),
  r as (select id, id root, 0 as depth from m where up is null or up not in (select id from m) union all select m.id, r.root, r.depth + 1 from m join r on m.up = r.id)
  select id, root, cast(depth as bigint) depth from r""")
def threads(t):
    """Each turn answers the one before: roots and depths by pointer jumping."""
    rows = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.when(F.col("turn") > 0, F.col("conv_id") * 1000 + F.col("turn") - 1).alias("up"))
    return lookups.roots(rows, "id", "up")


@query("""with recursive s as (select conv_id, turn, length(coalesce(text, '')) n, row_number() over (partition by conv_id order by turn) k from conversations),
  r as (select conv_id, turn, k, n as filled, cast(0 as bigint) as part from s where k = 1
    union all select s.conv_id, s.turn, s.k, case when filled > 0 and filled + n > 2000 then n else filled + n end, part + case when filled > 0 and filled + n > 2000 then 1 else 0 end from r join s on s.conv_id = r.conv_id and s.k = r.k + 1)
  select conv_id, turn, part from r""")
def bin_pack(t):
    """Turns of a conversation in parts of at most 2,000 characters, in order."""
    rows = t("conversations").select("conv_id", "turn", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return lookups.reset_running(rows, "conv_id", "turn", "n", 2000)


@query("""select a.p_partkey, b.p_partkey candidate, levenshtein(a.p_name, b.p_name) as distance, row_number() over (partition by a.p_partkey order by levenshtein(a.p_name, b.p_name), b.p_partkey) place
  from part a join part b on a.p_brand = b.p_brand and a.p_type = b.p_type and a.p_partkey <> b.p_partkey qualify place <= 3""")
def top3_candidates(t):
    """The three nearest names of the same brand and type.

    Names are compared, not parts: each name of a group stands for its four least keys, of which one may be the part itself.
    """
    group = ["p_brand", "p_type"]
    parts = t("part").select("p_partkey", "p_name", *group)
    pool = lookups.top_per_key(parts.select(*group, F.col("p_name").alias("other"), F.col("p_partkey").alias("candidate")), [*group, "other"], [F.col("candidate")], 4).drop("place")
    names = parts.select(*group, "p_name").distinct().join(pool, group).withColumn("distance", F.levenshtein("p_name", "other").cast("bigint"))
    order = [F.col("distance"), F.col("candidate")]
    near = lookups.top_per_key(names, [*group, "p_name"], order, 4).drop("place", "other")
    pairs = parts.join(near, [*group, "p_name"]).where("p_partkey <> candidate")
    return lookups.top_per_key(pairs, ["p_partkey"], order, 3).select("p_partkey", "candidate", "distance", F.col("place").cast("bigint").alias("place"))


@query("""with c as (select conv_id, turn, text, 'M' || row_number() over (partition by conv_id order by turn) as alias, count(*) over (partition by conv_id) size from conversations)
  select conv_id, turn, alias, size from c""")
def case_aliases(t):
    """Short names M1, M2, ... for the messages of a case."""
    case = Window.partitionBy("conv_id")
    rows = blocks.ordinals(t("conversations"), ["conv_id"], [F.col("turn")])
    return rows.select("conv_id", "turn", F.concat(F.lit("M"), (F.col("ordinal") + 1).cast("string")).alias("alias"), F.count("*").over(case).alias("size"))
