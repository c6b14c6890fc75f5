"""Queries on workbooks that are written from tables and read again."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources import sinks, workbook
from ..sources.shared import new_path
from .registry import query


def customer_books(t) -> str:
    """The path of a workbook for each nation with a sheet for each segment: a merged title, a header, then the customers; some have no balance, names with marks that XML cannot hold."""
    c = t("customer")
    n = F.row_number().over(Window.partitionBy("c_nationkey", "c_mktsegment").orderBy("c_custkey"))
    rows = c.select(F.format_string("n%02d.xlsx", "c_nationkey").alias("file"), F.col("c_mktsegment").alias("sheet"), (n + 2).alias("row"), "c_custkey", "c_name", "c_acctbal")
    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    cell = lambda col, text=none, value=number, top=None: F.struct(
        F.lit(col).alias("col"), text.alias("text"), value.alias("number"), F.lit(top).cast("int").alias("merge_row"), F.lit(top).cast("int").alias("merge_col")
    )
    name = F.concat("c_name", F.when(F.col("c_custkey") % 7 == 0, F.lit(" <&> _x0041_ \x0b")).otherwise(""))
    balance = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    cells = F.array(cell(1, value=F.col("c_custkey").cast("double")), cell(2, name), cell(28, value=balance))
    body = rows.select("file", "sheet", "row", F.explode(cells).alias("c")).select("file", "sheet", "row", "c.*")
    sheets = rows.select("file", "sheet").distinct()
    title = sheets.select("file", "sheet", F.lit(1).alias("row"), F.explode(F.array(cell(1, F.col("sheet"), top=1), cell(2, top=1), cell(3, top=1))).alias("c"))
    header = sheets.select("file", "sheet", F.lit(2).alias("row"), F.explode(F.array(cell(1, F.lit("No")), cell(2, F.lit("Name")), cell(28, F.lit("Balance")))).alias("c"))
    head = title.unionByName(header).select("file", "sheet", "row", "c.*")
    path = new_path(c.sparkSession, "books")
    sinks.workbooks(head.unionByName(body).withColumn("formula", none), path).write.format("noop").mode("overwrite").save()
    return path


_CELLS = """r as (select format('n{:02d}.xlsx', c_nationkey::int) as file, c_mktsegment as sheet, (row_number() over (partition by c_nationkey, c_mktsegment order by c_custkey) + 2)::int as row, * from customer),
  s as (select distinct file, sheet from r),
  cells as (select file, sheet, row, 1 as col, null as text, c_custkey::double as number, null::int as merge_row from r
    union all select file, sheet, row, 2, c_name || case when c_custkey % 7 = 0 then ' <&> _x0041_ ' || chr(11) else '' end, null, null from r
    union all select file, sheet, row, 28, null, c_acctbal::double, null from r where c_custkey % 5 <> 0
    union all select file, sheet, 1, 1, sheet, null, 1 from s union all select file, sheet, 1, 2, null, null, 1 from s union all select file, sheet, 1, 3, null, null, 1 from s
    union all select file, sheet, 2, 1, 'No', null, null from s union all select file, sheet, 2, 2, 'Name', null, null from s union all select file, sheet, 2, 28, 'Balance', null, null from s)"""


@query(f"with {_CELLS} select * from cells")
def workbook_cells(t):
    """All cells of the customers' workbooks, read by sheets."""
    spark = t("customer").sparkSession
    workbook.register(spark)
    # Each sheet of these small books is a partition of its own.
    read = spark.read.format("workbook").option("splitBytes", 1).load(customer_books(t))
    return read.select(F.element_at(F.split("file", "/"), -1).alias("file"), "sheet", "row", "col", F.when(F.col("number").isNull(), F.col("text")).alias("text"), "number", "merge_row")


@query(f"with {_CELLS} select a.file, a.number::bigint as no, b.text as name, c.number as balance from cells a join cells b using (file, sheet, row) left join cells c on c.file = a.file and c.sheet = a.sheet and c.row = a.row and c.col = 28 where a.sheet = 'BUILDING' and a.col = 1 and b.col = 2 and a.row > 2")
def master_rows_of_workbooks(t):
    """The bulk scan of a master list: one sheet of every workbook below its header, as columns."""
    spark = t("customer").sparkSession
    workbook.register(spark)
    cells = spark.read.format("workbook").schema("file string, sheet string, row int, col int, text string, number double").load(customer_books(t))
    rows = cells.where("sheet = 'BUILDING' and row > 2 and col in (1, 2, 28)").groupBy("file", "row")
    at = lambda col, value: F.max(F.when(F.col("col") == col, F.col(value)))
    return rows.agg(at(1, "number").cast("bigint").alias("no"), at(2, "text").alias("name"), at(28, "number").alias("balance")).select(F.element_at(F.split("file", "/"), -1).alias("file"), "no", "name", "balance")
