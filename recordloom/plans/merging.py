"""Queries: winners, merges, roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rollups, winners
from .registry import query

KEY = ["o_custkey", "d"]


def _day():
    return F.col("o_orderdate").cast("date")


def _newest():
    return [(F.col("o_orderstatus") != "P").desc(), F.col("o_totalprice").desc(), F.col("o_orderkey").desc()]


_RANKED = """(select o_custkey, cast(o_orderdate as date) d, o_orderkey,
  row_number() over w rn, count(*) over (partition by o_custkey, cast(o_orderdate as date)) n, first_value(o_orderkey) over w kept
  from orders window w as (partition by o_custkey, cast(o_orderdate as date) order by (o_orderstatus <> 'P') desc, o_totalprice desc, o_orderkey desc))"""


@query(f"select o_custkey, d, o_orderkey kept, n - 1 superseded from {_RANKED} where rn = 1")
def newest_wins(t):
    """Orders as reads of a customer's day: which read counts, and how many it replaces."""
    rows = t("orders").withColumn("d", _day())
    return winners.newest_wins(rows, KEY, _newest()).select("o_custkey", "d", F.col("o_orderkey").alias("kept"), "superseded")


@query(f"select o_custkey, d, o_orderkey, kept, 'superseded' reason from {_RANKED} where rn > 1")
def superseded_list(t):
    rows = t("orders").withColumn("d", _day())
    return winners.superseded(rows, KEY, _newest(), "o_orderkey").select("o_custkey", "d", "o_orderkey", "kept", "reason")


@query("""select l_orderkey, count(*) as lines, cast(sum(cast(l_quantity as decimal(18,2))) as double) quantity,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) amount from lineitem group by l_orderkey""")
def order_rollup(t):
    out = rollups.documents(t("lineitem"), "l_orderkey", "l_extendedprice", "l_quantity")
    return out.select("l_orderkey", "lines", F.col("quantity").cast("double").alias("quantity"), F.col("amount").cast("double").alias("amount"))


@query("""with d as (select l_orderkey, count(*) as lines, count(l_extendedprice) amounts, count(distinct l_suppkey) parties,
  sum(cast(l_extendedprice as decimal(18,2))) total, max(cast(l_extendedprice as decimal(18,2))) largest from lineitem group by l_orderkey)
  select l_orderkey, lines, parties > 1 several_parties, amounts < lines missing_amount,
  amounts >= 3 and abs(largest - (total - largest)) <= greatest(0.05, (total - largest) * 0.05) hidden_total from d""")
def order_issues(t):
    return rollups.document_issues(t("lineitem"), "l_orderkey", "l_extendedprice", "l_suppkey", share=0.05)


@query("""with j as (select o_orderkey, o_totalprice, case when l_linenumber % 7 <> 0 then l_extendedprice end amount from orders join lineitem on o_orderkey = l_orderkey)
  select o_orderkey, cast(case when count(amount) = count(*) then sum(cast(amount as decimal(18,2)))
  when count(distinct o_totalprice) = 1 then max(cast(o_totalprice as decimal(18,2))) end as double) total from j group by o_orderkey""")
def local_total(t):
    """Sum of the lines where all have an amount (every seventh has none), else the document's own total."""
    lines = t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    amount = F.when(F.col("l_linenumber") % 7 != 0, F.col("l_extendedprice"))
    return rollups.total_of_lines_or_stated(t("orders"), lines, "o_orderkey", amount, F.col("o_totalprice")).select("o_orderkey", F.col("total").cast("double").alias("total"))


@query("""select l_partkey, l_quantity, l_extendedprice, max(n) copies from (select l_linestatus, l_partkey, l_quantity, l_extendedprice, count(*) n
  from lineitem group by all) group by all""")
def multiset_union(t):
    return winners.multiset_union(t("lineitem"), [], "l_linestatus", ["l_partkey", "l_quantity", "l_extendedprice"])


_BOTH = """(select 'c' src, c_custkey id, c_nationkey nation, c_name as name, case when c_acctbal >= 0 then c_mktsegment end as segment, case when c_acctbal > 5000 then c_acctbal end as balance from customer
  union all select 's', s_suppkey, s_nationkey, s_name, null, case when s_acctbal > 0 then s_acctbal end from supplier)"""
_FIELDS = ["name", "segment", "balance"]


def _both(t):
    c = t("customer").select(F.lit("c").alias("src"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"), F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal")).alias("balance"))
    s = t("supplier").select(F.lit("s").alias("src"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("segment"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("balance"))
    return c.unionByName(s)


def _order():
    return F.struct((-winners.richness(_FIELDS)).alias("poor"), F.col("src"), F.col("id"))


_RICH = "(name is not null)::int + (segment is not null)::int + (balance is not null)::int"
_BEST = f"""(select nation, arg_min(name, r) filter (name is not null) as name, arg_min(segment, r) filter (segment is not null) as segment, arg_min(balance, r) filter (balance is not null) as balance, count(*) members
  from (select *, row_number() over (order by -({_RICH}), src, id) r from {_BOTH}) group by nation)"""


@query(f"select * from {_BEST}")
def richest_merge(t):
    """Customers and suppliers of a nation as copies of one record: the first known value of each field, richest first."""
    return winners.first_known(_both(t), ["nation"], _order(), _FIELDS)


@query(f"""select b.nation, b.src, b.id, 'segment' field, b.segment as "value", k.segment kept from {_BOTH} b join {_BEST} k on b.nation = k.nation where b.segment <> k.segment
  union all select b.nation, b.src, b.id, 'name', b.name, k.name from {_BOTH} b join {_BEST} k on b.nation = k.nation where b.name <> k.name""")
def conflicts(t):
    rows = _both(t).withColumn("row", F.struct("src", "id"))
    out = winners.conflicts(rows, ["nation"], _order(), ["name", "segment"], "row")
    return out.select("nation", "row.src", "row.id", "field", "value", "kept")


@query("""with c as (select l_partkey, l_returnflag, count(*) n, min(l_orderkey) f from lineitem group by all)
  select l_partkey, l_returnflag, n from c qualify row_number() over (partition by l_partkey order by n desc, f, l_returnflag) = 1""")
def mode_first_seen(t):
    return winners.most_frequent(t("lineitem"), ["l_partkey"], "l_returnflag", F.struct("l_orderkey", "l_returnflag"))


@query("""select o_custkey, min(cast(o_orderdate as date)) first_day, max(cast(o_orderdate as date)) last_day, count(*) visits,
  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) latest_o_orderstatus, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) all_o_orderpriority from orders group by o_custkey""")
def company_profile(t):
    rows = t("orders").withColumn("d", _day())
    return rollups.profile(rows, "o_custkey", "d", F.struct("o_orderdate", "o_orderkey"), ["o_orderstatus"], "o_orderpriority")


@query("""select o_custkey, count(*) n_open, cast(sum(cast(o_totalprice as decimal(18,2))) as double) "open", count(*) filter (due < date '1998-06-01') n_overdue,
  cast(coalesce(sum(cast(o_totalprice as decimal(18,2))) filter (due < date '1998-06-01'), 0) as double) overdue, min(due) oldest_due, count(o_orderkey) > count(distinct o_orderkey) number_twice
  from (select *, cast(o_orderdate as date) + 30 due from orders where o_orderstatus = 'O') where o_totalprice <> 0 group by o_custkey""")
def receivables_snapshot(t):
    """Open orders as invoices due after thirty days."""
    rows = t("orders").where("o_orderstatus = 'O'").withColumn("due", F.date_add(_day(), 30))
    out = rollups.receivables(rows, "o_custkey", "o_orderkey", "due", "o_totalprice", F.lit("1998-06-01").cast("date"))
    return out.withColumn("open", F.col("open").cast("double")).withColumn("overdue", F.col("overdue").cast("double"))


@query("select o_orderkey, date_trunc('month', o_orderdate)::date m from orders where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)")
def newest_snapshot(t):
    rows = t("orders").withColumn("m", F.trunc(_day(), "month"))
    return winners.newest_snapshot(rows, "m").select("o_orderkey", "m")


@query("""with s as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) computed from lineitem group by all)
  select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) - computed as double) difference, abs(cast(o_totalprice as decimal(18,2)) - computed) > 1 warning from orders join s on o_orderkey = l_orderkey""")
def stated_vs_computed(t):
    sums = rollups.documents(t("lineitem"), "l_orderkey", "l_extendedprice", "l_quantity")
    off = F.col("o_totalprice").cast("decimal(18,2)") - F.col("amount")
    return t("orders").join(sums, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", off.cast("double").alias("difference"), (F.abs(off) > 1).alias("warning"))


@query("""select o_custkey, cast(year(o_orderdate) as int) y, o_orderpriority currency, count(*) n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) amount,
  count(*) filter (o_orderstatus <> 'F') n_open, cast(coalesce(sum(cast(o_totalprice as decimal(18,2))) filter (o_orderstatus <> 'F'), 0) as double) open_amount from orders group by all""")
def yearly_overview(t):
    """Sums per customer, year and currency (the priority stands in), never across currencies."""
    m, unfinished = F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderstatus") != "F"
    return t("orders").groupBy("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("currency")).agg(
        F.count("*").alias("n"), F.sum(m).cast("double").alias("amount"), F.count_if(unfinished).alias("n_open"), rollups.money_sum(F.when(unfinished, m)).cast("double").alias("open_amount"),
    )


_LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""with p as (select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LINE}) - 1 deal_part from lineitem),
  q as (select *, count(*) over w revisions, row_number() over (partition by l_orderkey, deal_part order by l_linenumber desc) rn from p window w as (partition by l_orderkey, deal_part))
  select l_orderkey, cast(deal_part as int) deal_part, l_linenumber, l_partkey, revisions from q where rn = 1""")
def revision_chain(t):
    order = [F.col(c.strip()) for c in _LINE.split(",")]
    return winners.live_revision(t("lineitem"), ["l_orderkey"], "l_linenumber", order).select("l_orderkey", F.col("deal_part").cast("int").alias("deal_part"), "l_linenumber", "l_partkey", "revisions")


@query("""with e as (select event_id, user_id || ':' || event_type || ':' || cast(ts as date) as name, row_number() over (partition by user_id, event_type, cast(ts as date) order by ts, event_id) nth from events)
  select event_id, cast(nth as int) nth, case when nth = 1 then name else name || '#' || nth end unique_id from e""")
def duplicate_suffix(t):
    day = F.col("ts").cast("date")
    rows = t("events").withColumn("day", day)
    name = F.concat_ws(":", "user_id", "event_type", "day")
    return winners.numbered_repeats(rows, ["user_id", "event_type", "day"], [F.col("ts"), F.col("event_id")], name).select("event_id", "nth", "unique_id")


@query("""with c as (select user_id, cast(ts as date) d, event_type, count(*) n from events group by all),
  r as (select *, row_number() over (partition by user_id, d order by n desc, event_type desc) rn from c),
  f as (select user_id, d, max(n) filter (rn = 1) n_first, coalesce(max(n) filter (rn = 2), 0) n_second, max(event_type) filter (rn = 1) e from r group by all)
  select user_id, d, case when n_first >= 3 * n_second then e end event_type, case when n_first >= 3 * n_second then 'dominant' else 'conflict' end verdict, n_first, n_second from f""")
def dominance_pick(t):
    return rollups.dominant(t("events").withColumn("d", F.col("ts").cast("date")), ["user_id", "d"], "event_type")


@query("""with u as (select user_id, count(*) n, count(*) filter (event_type = 'error') errors, count(*) filter (event_type = 'purchase') purchases, count(*) filter (event_type = 'signup') signups from events group by all)
  select user_id, n, errors, purchases, signups, case when purchases >= 3 then 'customer' when errors > purchases + signups then 'trouble' when signups > 0 then 'prospect' else 'unknown' end reason from u""")
def evidence_decision(t):
    """Counters per user, then the first rule that holds."""
    kind = lambda k: F.count_if(F.col("event_type") == k)
    counts = t("events").groupBy("user_id").agg(F.count("*").alias("n"), kind("error").alias("errors"), kind("purchase").alias("purchases"), kind("signup").alias("signups"))
    rules = [(F.col("purchases") >= 3, "customer"), (F.col("errors") > F.col("purchases") + F.col("signups"), "trouble"), (F.col("signups") > 0, "prospect")]
    return counts.withColumn("reason", rollups.decision(rules, "unknown"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"


@query(f"""with p as (select array_to_string(string_split({_HOST}, '.')[-2:], '.') org, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1) lang from pages), c as (select org, lang, count(*) n from p group by all),
  a as (select org, lang, n from c qualify row_number() over (partition by org order by n desc, lang) = 1), b as (select org, lang from c qualify row_number() over (partition by lang order by n desc, org) = 1)
  select org, lang, n from a join b using (org, lang)""")
def domain_vote(t):
    """Organisation and language of pages that are each other's most frequent partner."""
    from ..functions.emails import org_domain

    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))
    rows = t("pages").select(org_domain(host).alias("org"), F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)", 1).alias("lang"))
    return rollups.mutual_best(rows, "org", "lang")
