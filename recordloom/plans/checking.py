"""Queries that check the library's own work: what went in came out, and how far a job has come."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import conservation
from ..operators.progress import Progress
from ..sources.shared import stored
from .registry import query

_HEAD = ["Document No.", "Document Date", "Customer", "Order Status", "Sales Quantity", "Net amount"]


def order_cells(t):
    """A workbook of orders for each 50th customer number: a line without its number where the key ends in 9, an amount in words where in 8, and a total below."""
    o = t("orders").select((F.col("o_custkey") % 50).alias("book"), "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    nth = F.row_number().over(Window.partitionBy("book").orderBy("o_orderkey")) + 2
    k = F.col("o_orderkey") % 10
    file = F.concat(F.lit("orders "), F.col("book").cast("string"), F.lit(".xlsx")).alias("file")
    number = F.when(k != 9, F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")))
    values = [number, F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")), F.lit("open"), (k + 1).cast("string"), F.when(k == 8, "as agreed").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))]
    cell = lambda c, text: F.struct(F.lit(c).alias("col"), text.alias("text"))
    body = o.withColumn("row", nth).select(file, "row", F.inline(F.array(*[cell(c, v) for c, v in enumerate(values, 1)])))
    ends = o.groupBy("book").agg((F.count("*") + 3).cast("int").alias("row"))
    fixed = ends.select(file, "row", F.lit(1).alias("col"), F.lit("Total").alias("text"))
    heads = ends.select(file, F.lit(2).alias("row"), F.inline(F.array(*[cell(c, F.lit(v)) for c, v in enumerate(_HEAD, 1)])))
    rows = body.unionByName(fixed).unionByName(heads).where("text is not null")
    return rows.select("file", F.lit("Export").alias("sheet"), F.col("row").cast("int").alias("row"), "col", "text")


def contact_cells(t):
    """A workbook of contacts for each nation; every tenth has no name."""
    c = t("customer").select("c_nationkey", "c_custkey")
    row = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) + 1
    file = F.concat(F.lit("contacts "), F.col("c_nationkey").cast("string"), F.lit(".xlsx")).alias("file")
    k = F.col("c_custkey").cast("string")
    values = [F.concat(F.lit("Company "), k), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("Person "), k)), F.concat(F.lit("+86139"), F.lpad(k, 8, "0")), F.concat(F.lit("p"), k, F.lit("@x.com"))]
    cell = lambda col, text: F.struct(F.lit(col).alias("col"), text.alias("text"))
    body = c.withColumn("row", row).select(file, "row", F.inline(F.array(*[cell(n, v) for n, v in enumerate(values, 1)])))
    heads = c.select("c_nationkey").distinct().select(file, F.lit(1).alias("row"), F.inline(F.array(*[cell(n, F.lit(v)) for n, v in enumerate(["公司名称", "联系人", "电话", "Email"], 1)])))
    return body.unionByName(heads).where("text is not null").select("file", F.lit("S").alias("sheet"), F.col("row").cast("int").alias("row"), "col", "text")


@query("""select 'orders' as family, (select count(*) + count(distinct o_custkey % 50) from orders)::bigint as lines, (select count(*) from orders where o_orderkey % 10 <> 9)::bigint as records,
    (select count(*) filter (where o_orderkey % 10 = 9) + count(distinct o_custkey % 50) from orders)::bigint as rows_left, 0::bigint as findings
  union all select 'contacts', count(*), count(*) filter (where c_custkey % 10 <> 0), count(*) filter (where c_custkey % 10 = 0), 0 from customer
  union all select 'receivables', 0, 0, 0, 0""")
def families_self_test(t):
    """Workbooks of orders and contacts through their readers: lines that went in, records and reasons that came out."""
    cells = stored(order_cells(t).unionByName(contact_cells(t)), "cells")
    return conservation.self_test(cells, {n: conservation.ADAPTERS[n] for n in ("orders", "contacts", "receivables")})


@dataclass(frozen=True)
class Careless(conservation.Labelled):
    """A reader of orders that forgets some rows, reads others twice and rounds amounts."""

    def read(self, cells: DataFrame) -> conservation.Reading:
        records, review = super().read(cells)
        k = F.substring("document_no", 3, 20).cast("long")
        twice = records.where(k % 13 == 0)
        net = F.when(k % 17 == 0, F.floor("net").cast("decimal(18,2)")).otherwise(F.col("net"))
        return conservation.Reading(records.where(k % 11 != 0).unionByName(twice.where(k % 11 != 0)).withColumn("net", net), review)


@query("""with o as (select *, o_orderkey as k, row_number() over (partition by o_custkey % 50 order by o_orderkey) + 2 as row, o_totalprice::decimal(18,2) as net from orders),
  r as (select 'orders ' || o_custkey % 50 || '.xlsx' as file, row::int as row, k, net from o where k % 10 <> 9)
  select file, row, 'lost' as finding, null as field, 1::double as went_in, 0::double as came_out from r where k % 11 = 0 and k % 10 <> 8
  union all select file, row, 'made', null, 1, 2 from r where k % 13 = 0 and k % 11 <> 0
  union all select file, row, 'changed', 'net', net::double, floor(net)::double from r where k % 17 = 0 and k % 11 <> 0 and k % 13 <> 0 and k % 10 <> 8 and net <> floor(net)""")
def careless_reader(t):
    """What the check finds in a reader that loses, doubles and changes; a row whose amount is in the review anyway does not count as lost."""
    family = Careless("orders", ("net",))
    found = conservation.findings(conservation.balance(stored(order_cells(t), "cells"), family), family.amounts)
    return found.select("file", "row", "finding", "field", F.col("went_in").cast("double").alias("went_in"), F.col("came_out").cast("double").alias("came_out"))


@query("""with l as (select l_orderkey, l_quantity, l_extendedprice::decimal(18,2) as price, l_returnflag from lineitem), k as (select * from l where l_returnflag <> 'R'), d as (select l_orderkey, sum(price) as total from k group by l_orderkey)
  select 'lines' as stage, 1 as nth, 'rows' as measure, count(*)::double as value from l union all select 'lines', 1, 'amount', coalesce(sum(price), 0)::double from l
  union all select 'kept', 2, 'rows', count(*)::double from k union all select 'kept', 2, 'amount', coalesce(sum(price), 0)::double from k
  union all select 'orders', 3, 'rows', count(*)::double from d union all select 'orders', 3, 'amount', coalesce(sum(total), 0)::double from d union all select 'orders', 3, 'largest', coalesce(max(total), 0)::double from d""")
def stage_counts(t):
    """Order lines in three stages, with rows and amounts counted as each was written."""
    source = t("lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_returnflag")
    job = Progress(source.sparkSession)
    lines = job.stage("lines", source, {"amount": F.sum("price")})
    kept = job.stage("kept", lines.where("l_returnflag <> 'R'"), {"amount": F.sum("price")})
    job.stage("orders", kept.groupBy("l_orderkey").agg(F.sum("price").alias("total")), {"amount": F.sum("total"), "largest": F.max("total")})
    return job.report().select("stage", "nth", "measure", F.col("value").cast("double").alias("value"))
