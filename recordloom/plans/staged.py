"""Queries on change plans in stages: what a first run does, and that a second does nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import staged_plans
from ..sources.shared import stored
from .registry import query


def _number(c):
    return F.lpad(c.cast("string"), 9, "0")


def visit_rows(t):
    """Orders as visits: a person for two of three, a next step for two of five."""
    o = t("orders").where("o_custkey is not null")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        F.concat(F.lit("v"), k).alias("visit_id"), F.concat(F.when(k % 2 == 0, "Customer#").otherwise("CUSTOMER "), _number(c)).alias("customer"), F.when(k % 7 != 0, "Wuxi").alias("city"), F.lit(None).cast("string").alias("potential"),
        F.when(k % 3 != 0, F.concat(F.lit("Ann Berg"), F.translate((c % 2).cast("string"), "01", "ab"))).alias("person"), F.when(k % 3 == 1, F.concat(F.lit("+49"), _number(c))).alias("phone"), F.lit(None).cast("string").alias("email"), day.alias("day"),
        F.col("o_orderpriority").alias("purpose"), F.when(k % 5 < 2, "call").alias("step"), F.date_add(day, 10).alias("due"), F.lit("1998-01-01").cast("date").alias("cutoff"),
    )


def visit_state(t):
    """The target before: two of three customers, some in another city, one of four people (under another name but with the number), and one of ten notes, half of them as they are now."""
    c, key = t("customer"), F.col("c_custkey")
    ident = lambda p, k: F.concat(F.lit(p), k.cast("string"))
    companies = c.where(key % 3 != 0).select(ident("C", key).alias("id"), F.concat(F.lit("Customer#"), _number(key)).alias("name"), F.when(key % 4 == 0, F.create_map(F.lit("city"), F.lit("Suzhou"))).otherwise(F.create_map().cast("map<string,string>")).alias("fields"))
    people = c.where((key % 3 != 0) & (key % 4 == 0)).select(ident("P", key).alias("id"), ident("C", key).alias("company"), F.lit("Old Name").alias("name"), F.array(F.concat(F.lit("+49"), _number(key))).alias("phones"), F.array().cast("array<string>").alias("emails"))
    day = F.col("o_orderdate").cast("date").cast("string")
    fields = F.create_map(F.lit("day"), day, F.lit("purpose"), F.when(F.col("o_orderkey") % 20 == 0, F.col("o_orderpriority")).otherwise("other"))
    notes = t("orders").where("o_orderkey % 10 = 0 and o_orderkey % 3 = 0 and o_custkey % 3 <> 0").select(ident("v", F.col("o_orderkey")).alias("id"), F.lit("note").alias("kind"), ident("C", F.col("o_custkey")).alias("company"), F.lit(None).cast("string").alias("contact"), fields.alias("fields"), F.when(F.col("o_orderkey") % 4 == 2, "2999-01-01").otherwise(day).alias("stamp"))
    return staged_plans.State(companies, people, notes)


_PLAN = """
o as (select o_orderkey as k, o_custkey as c from orders),
co as (select c, max(case when k % 7 <> 0 then 1 else 0 end) as has_city, max(case when k % 3 <> 0 then 1 else 0 end) as met, max(case when k % 3 = 1 then 1 else 0 end) as called from o group by c),
first as (
  select 1 as stage, 'company' as kind, case when c % 3 = 0 then 'create' when c % 4 <> 0 and has_city = 1 then 'patch' else 'same' end as action from co
  union all select 1, 'company', 'conflict' from co where c % 3 <> 0 and c % 4 = 0 and has_city = 1
  union all select 2, 'contact', case when c % 3 <> 0 and c % 4 = 0 and called = 1 then 'same' else 'create' end from co where met = 1
  union all select 3, 'note', case when k % 10 = 0 and k % 3 = 0 and c % 3 <> 0 then case when k % 20 = 0 then 'same' when k % 4 = 2 then 'newer' else 'update' end else 'create' end from o
  union all select 3, 'task', 'create' from o where k % 5 < 2),
n as (select stage, kind, action, count(*) as n from first group by all)"""


@query(f"with {_PLAN} select stage, kind, action, n from n")
def visit_plan(t):
    """What a run over the visits would do, stage by stage."""
    return staged_plans.counts(staged_plans.plan(staged_plans.visits(visit_rows(t)), visit_state(t)))


@query(f"""with {_PLAN}
select stage, kind, case when action in ('newer', 'conflict') then action else 'same' end as action, sum(n)::bigint as n from n group by all""")
def visit_plan_again(t):
    """The same plan against the target that its first run leaves: nothing to do but the conflicts and newer notes that were there before."""
    wanted, state = staged_plans.visits(visit_rows(t)), visit_state(t)
    first = stored(staged_plans.plan(wanted, state), "plan")
    return staged_plans.counts(staged_plans.plan(wanted, staged_plans.applied(first, state)))


@query("""with s as (select o_custkey as c, arg_max(struct_pack(day := day, price := price), (day, k)) as l from (select o_orderkey as k, o_custkey, cast(o_orderdate as date) as day, cast(round(o_totalprice * 100) as bigint) as price from orders where o_orderkey % 4 <> 0) group by 1)
  select case when c % 2 = 0 then 'C' || c end as ref, case when c % 2 = 0 then 'patch' else 'create' end as action, l.price::varchar as open_amount, l.day::varchar as as_of from s""")
def receivables_plan(t):
    """Balances of customers, of which half are known with an older one: those are replaced, a list in another currency is left out."""
    o, key = t("orders"), F.col("o_custkey")
    rows = o.select(F.concat(F.lit("Customer#"), _number(key)).alias("customer"), F.when(F.col("o_orderkey") % 4 != 0, "CNY").otherwise("EUR").alias("currency"), F.round(F.col("o_totalprice") * 100).cast("long").alias("open_amount"), F.lit(0).alias("overdue"), F.col("o_orderdate").cast("date").alias("as_of"), "o_orderkey")
    # One row a customer and day, the last of its orders.
    rows = rows.groupBy("customer", "currency", "as_of").agg(F.max_by(F.struct("open_amount", "overdue"), "o_orderkey").alias("x")).select("customer", "currency", "as_of", "x.*")
    held = t("customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"), F.concat(F.lit("customer "), _number(F.col("c_custkey"))).alias("name"), F.create_map(F.lit("open_amount"), F.lit("-1"), F.lit("overdue"), F.lit("0")).alias("fields"))
    spark = held.sparkSession
    state = staged_plans.State(held, spark.createDataFrame([], "id string, company string, name string, phones array<string>, emails array<string>"), spark.createDataFrame([], "id string, kind string, company string, contact string, fields map<string,string>, stamp string"))
    got = staged_plans.plan(staged_plans.receivables(rows), state)
    return got.select(F.when(~F.col("ref").startswith("new:"), F.col("ref")).alias("ref"), "action", F.col("fields")["open_amount"].alias("open_amount"), F.col("fields")["as_of"].alias("as_of"))
