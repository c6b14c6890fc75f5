"""Queries on customer lists of several layouts, two of them side by side on a sheet."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import account_sheets
from .registry import query


def list_cells(t):
    """A sheet for each nation: its suppliers as an ERP list, a master list beside it, and two sections below, with a name missing, a code beside text, and a number that must not be read."""
    place = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    s = t("supplier").select("s_nationkey", "s_suppkey", "s_name", (F.row_number().over(place) - 1).alias("nth"), F.count("*").over(Window.partitionBy("s_nationkey")).alias("n"))
    key = F.col("s_suppkey").cast("string")
    code = F.concat(F.lit("CR"), F.lpad(key, 6, "0"))
    cell = lambda row, col, text: F.struct(row.cast("int").alias("row"), F.lit(col).alias("col"), text.alias("text"))
    nth, n = F.col("nth"), F.col("n")
    erp, master, first, second = nth + 4, nth + 3, n + 9 + nth, 2 * n + 13 + nth
    body = [
        cell(erp, 1, F.when(F.col("s_suppkey") % 5 == 1, F.concat(F.lit("old "), code)).when(F.col("s_suppkey") % 5 != 2, F.concat(F.lit("00"), code))), cell(erp, 2, F.when(F.col("s_suppkey") % 5 != 3, F.concat(F.lit("甲"), "s_name"))),
        cell(erp, 3, F.when(F.col("s_suppkey") % 5 == 4, F.concat(F.lit("91310000"), F.lpad(key, 10, "0"))).otherwise(F.lit("江苏省Jiangsu"))), cell(erp, 4, F.lit("61234567890123")),
        cell(master, 7, F.when(F.col("s_suppkey") % 2 == 0, code).otherwise("New")), cell(master, 8, F.concat(F.lit("乙"), key)), cell(master, 9, F.col("s_name")), cell(master, 10, F.lit("2021.12")),
        cell(first, 1, F.concat(F.lit("丙"), key, F.lit("\n丁"), key)), cell(first, 2, F.lit("-")), cell(first, 3, F.when(F.col("s_suppkey") % 3 == 0, F.lit("many")).otherwise(F.concat(key, F.lit(" 台")))), cell(first, 4, F.lit("Rival")),
        cell(second, 1, F.concat(F.lit("Maker "), key)), cell(second, 2, F.lit("Maker")), cell(second, 3, F.lit("B 1")),
    ]
    top = s.where("nth = 0")
    fixed = lambda row, labels, at=1: [cell(row, at + k, F.lit(x)) for k, x in enumerate(labels)]
    heads = [
        *fixed(F.lit(1), ["List of customers"]), *fixed(F.lit(3), ["客户编码", "客户名称", "省直辖市", "银行账号"]), *fixed(F.lit(2), ["Customer Code", "CN Name", "EN Name", "First order time"], 7),
        *fixed(n + 6, ["重点 New customers"]), *fixed(n + 8, ["客户名称", "English name", "预测全年采购数量", "竞争对手"]), *fixed(2 * n + 11, ["Seen at the fair"]), *fixed(2 * n + 12, ["厂家名称", "English name", "产品系列"]),
    ]
    sheet = [F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file"), F.lit("S").alias("sheet")]
    return s.select(*sheet, F.inline(F.array(*body))).unionByName(top.select(*sheet, F.inline(F.array(*heads)))).where("text is not null")


_LIST = """s as (select s_nationkey, s_suppkey as k, s_name, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as nth, count(*) over (partition by s_nationkey) as n from supplier),
f as (select *, 'n' || s_nationkey || '.xlsx' as file, 'CR' || lpad(k::varchar, 6, '0') as code from s)"""


@query(f"""with {_LIST}
select file, (nth + 4)::int as row, 'erp' as layout, 'account' as kind, code, '甲' || s_name as cn, null as en, case when k % 5 <> 4 then '江苏省 Jiangsu' end as province, null as first_order, null::double as forecast, '' as names, '' as notes from f where k % 5 not in (2, 3)
union all select file, (nth + 3)::int, 'master', 'account', case when k % 2 = 0 then code end, '乙' || k, s_name, null, '2021-12', null, '', '' from f
union all select file, (n + 9 + nth)::int, 'new', 'account', null, '丙' || k, null, null, null, case when k % 3 <> 0 then k end, '丁' || k, '' from f
union all select file, (2 * n + 13 + nth)::int, 'exhibition', 'lead', null, null, 'Maker', null, null, null, '', 'Seen at the fair' from f""")
def account_lists(t):
    """Records of four layouts; the bank account beside them is never read."""
    got = account_sheets.read(list_cells(t)).records
    return got.select("file", "row", "layout", "kind", "code", "cn", "en", "province", "first_order", "forecast", F.array_join("names", ",").alias("names"), F.array_join("notes", ",").alias("notes"))


@query(f"""with {_LIST}
select file, (nth + 4)::int as row, 'code' as field, code as value, 'code_cell_has_text' as reason from f where k % 5 = 1
union all select file, (nth + 4)::int, 'code', null, 'no_code' from f where k % 5 = 2
union all select file, (nth + 4)::int, 'cn', '00' || code, 'no_name' from f where k % 5 = 3
union all select file, (nth + 4)::int, 'province', '', 'id_number_in_text_field' from f where k % 5 = 4
union all select file, (n + 9 + nth)::int, 'forecast', 'many', 'forecast_not_a_number' from f where k % 3 = 0""")
def account_review(t):
    """What a person must look at in the same lists."""
    return account_sheets.read(list_cells(t)).review.drop("sheet")
