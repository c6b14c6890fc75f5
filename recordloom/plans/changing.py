"""Queries: what a run would write."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes
from .registry import query


@query("""with h as (select o_custkey, min(cast(o_orderdate as date)) first_day, max(cast(o_orderdate as date)) last_day, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) city from orders where o_orderkey % 2 = 0 group by 1),
  w as (select o_custkey, min(cast(o_orderdate as date)) first_day, max(cast(o_orderdate as date)) last_day, case when o_custkey % 3 = 0 then null else arg_max(o_orderpriority, (o_orderdate, o_orderkey)) end city from orders where o_orderkey % 2 = 1 group by 1),
  n as (select h.o_custkey, least(h.first_day, w.first_day) first_day, greatest(h.last_day, w.last_day) last_day, case when w.last_day >= h.last_day then coalesce(w.city, h.city) else coalesce(h.city, w.city) end city, h.first_day hf, h.last_day hl, h.city hc
    from h join w using (o_custkey))
  select o_custkey, first_day, last_day, city from n where first_day <> hf or last_day <> hl or city <> hc""")
def enriched_companies(t):
    """Companies as held (visits with an even number) against those just read (the others)."""
    rows = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderdate").cast("date").alias("d"), "o_orderpriority")

    def side(odd):
        part = rows.where(F.col("o_orderkey") % 2 == odd).groupBy("o_custkey").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("city"))
        return part.withColumn("city", F.when(F.col("o_custkey") % 3 != 0, F.col("city"))) if odd else part

    return changes.enriched(side(0), side(1), "o_custkey", "first_day", "last_day", ["city"])


@query("""with p as (select c_custkey, c_custkey % 5 as k from customer)
  select c_custkey, case when k = 0 then 'reuse' else 'create' end as action, case when k = 0 then 'P' || c_custkey end as contact,
    case k when 0 then 'new' || c_custkey || '@x.com' when 1 then 'new' || c_custkey || '@x.com' when 2 then '' else 'own' || c_custkey || '@x.com,new' || c_custkey || '@x.com' end as emails from p""")
def people_with_addresses(t):
    """People whose address the target holds under their name, under another name, or not at all; some have none."""
    k, n = F.col("c_custkey") % 5, F.col("c_custkey").cast("string")
    address = lambda word: F.concat(F.lit(word), n, F.lit("@x.com"))
    name = F.concat(F.lit("Anna Berg "), F.translate(n, "0123456789", "abcdefghij"))
    people = t("customer").select("c_custkey", name.alias("name"), F.when(k != 2, F.array(F.upper(address("own")), address("new"))).alias("emails"))
    held = t("customer").select(
        F.concat(F.lit("P"), n).alias("id"), F.when(k == 0, F.concat_ws(" ", F.translate(n, "0123456789", "abcdefghij"), F.lit("Berg Anna"))).otherwise("Carl Stein").alias("name"),
        F.when(k <= 1, F.array(address("own"))).otherwise(F.array(address("far"))).alias("emails"),
    )
    out = changes.people_to_write(people, "c_custkey", "name", "emails", held, "id")
    return out.select("c_custkey", "action", "contact", F.array_join("emails", ",").alias("emails"))


@query("""with a as (select l_orderkey, l_linenumber, l_shipdate, case l_returnflag when 'A' then 'approve' when 'R' then 'reject' else 'ask' end as answer from lineitem),
  x as (select l_orderkey, arg_max(answer, (l_shipdate, answer)) last from a group by 1)
  select l_orderkey, case last when 'approve' then 'approved' when 'reject' then 'rejected' else 'pending' end as state from x""")
def approval_states(t):
    """Lines as answers about their order."""
    answer = F.when(F.col("l_returnflag") == "A", "approve").when(F.col("l_returnflag") == "R", "reject").otherwise("ask")
    return changes.approval_state(t("lineitem").select("l_orderkey", "l_shipdate", answer.alias("answer")), "l_orderkey", "l_shipdate", "answer")


@query("""with r as (select p_brand, p_partkey, case when p_partkey % 3 = 0 then null else p_type end role, case when p_partkey % 2 = 0 then null else p_size end size, p_name from part),
  o as (select *, -((role is not null)::int + (size is not null)::int) as rich from r)
  select p_brand, arg_min(role, (rich, p_partkey)) filter (role is not null) as role, arg_min(size, (rich, p_partkey)) filter (size is not null) as size, array_to_string(list_sort(list_distinct(list(lower(p_name)))), ',') as names,
    concat_ws(',', case when count(distinct lower(role)) > 1 then 'role' end, case when count(distinct size) > 1 then 'size' end) as differing, count(*) as members from o group by p_brand""")
def merged_contacts(t):
    """Parts of a brand as rows of one contact."""
    k = F.col("p_partkey")
    rows = t("part").select("p_brand", "p_partkey", F.when(k % 3 != 0, F.col("p_type")).alias("role"), F.when(k % 2 != 0, F.col("p_size")).alias("size"), F.array(F.col("p_name"), F.upper("p_name")).alias("names"))
    out = changes.merged_contacts(rows, ["p_brand"], F.col("p_partkey"), ["role", "size"], ["names"])
    return out.select("p_brand", "role", "size", F.array_join("names", ",").alias("names"), F.array_join("differing", ",").alias("differing"), "members")


@query("""with o as (select *, year(o_orderdate) y from orders), p as (select o_custkey, y, count(*) n, sum(cast(o_totalprice as decimal(18,2))) total from o group by all),
  b as (select o_custkey, string_agg(y || ': ' || n || ' orders, ' || total, E'\\n' order by y) body from p group by 1), s as (select o_custkey, max(o_orderdate) stamp, max(o_orderkey) as big from o group by 1)
  select o_custkey, body, case o_custkey % 5 when 0 then 'create' when 1 then 'same' when 2 then 'newer' when 3 then 'newer' else 'update' end as action from b join s using (o_custkey)""".replace("\\\\n", "\\n"))
def order_overviews(t):
    """One note for each customer, which the target lacks, holds as it is, holds newer, holds with an order more, or holds older."""
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    year = F.year("o_orderdate")
    nothing = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("").alias("body"), F.array(F.lit(-1).cast("long")).alias("counted"), F.lit(None).cast("timestamp_ntz").alias("exported")).where("false")
    own = changes.overviews(orders, "o_custkey", "o_orderkey", year, "o_totalprice", "o_orderdate", nothing)
    k = F.col("o_custkey") % 5
    newest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    held = own.join(newest, "o_custkey").where(k > 0).select(
        "o_custkey", F.when(k == 1, F.col("body")).otherwise("other").alias("body"), F.when(k == 3, F.array(F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>")).alias("counted"),
        F.when(k == 2, F.col("last") + F.expr("interval 1 day")).otherwise(F.col("last")).alias("exported"),
    )
    return changes.overviews(orders, "o_custkey", "o_orderkey", year, "o_totalprice", "o_orderdate", held)


@query("""with p as (select event_type family, user_id, case when event_id % 4 = 0 then 'create' when event_id % 4 = 1 then 'same' when event_id % 4 = 2 then 'newer' else 'update' end action, value > 50 and user_id % 3 = 0 failed from events),
  f as (select user_id, count(*) filter (not failed and action in ('create', 'update')) written, count(*) filter (not failed and action = 'same') present, count(*) filter (not failed and action = 'newer') skipped, count(*) filter (failed) failed from p group by 1)
  select *, case when failed > 0 and written = 0 then 'failed' when failed > 0 then 'partial' when written > 0 then 'done' else 'nothing_new' end as status from f""")
def write_report(t):
    """Events as planned writes of their user, some of which fail."""
    k = F.col("event_id") % 4
    plan = t("events").select(
        "user_id", F.when(k == 0, "create").when(k == 1, "same").when(k == 2, "newer").otherwise("update").alias("action"), F.when((F.col("value") > 50) & (F.col("user_id") % 3 == 0), "refused").alias("error"),
    )
    return changes.report(plan, "user_id", "action", "error")


@query("""select o_custkey, case when bool_or(o_orderpriority = '1-URGENT' and o_orderstatus = 'P') then '' when bool_or(o_orderstatus = 'F') then 'customer' when bool_or(o_orderstatus = 'O') then 'prospect' else '' end as stage from orders group by 1""")
def lifecycles(t):
    """The furthest stage of a customer's orders; an urgent one in part bars the account."""
    s = F.col("o_orderstatus")
    stage = F.when(s == "F", "customer").when(s == "O", "prospect")
    return t("orders").groupBy("o_custkey").agg(changes.lifecycle(stage, (F.col("o_orderpriority") == "1-URGENT") & (s == "P")).alias("stage"))
