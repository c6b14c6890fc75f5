"""Queries on business papers: fields, line items and sums of four kinds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents
from .registry import query

_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
#: Orders with their lines, and what goes into their papers: wrong sums for every tenth, wrapped descriptions for odd lines.
_BASE = f"""l as (select l_orderkey as k, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) as nth, l_partkey, cast(l_quantity as int) as qty, {_CENTS} as net, cast(l_shipdate as date) as ship from lineitem),
o as (select o_orderkey as k, o_custkey, o_orderkey % 4 as form, cast(o_orderdate as date) as day, sum(net)::bigint as items, count(*) as n from orders join l on k = o_orderkey group by all),
d as (select *, items + case when k % 10 = 0 then 100 else 0 end as stated, items // 10 as vat from o)"""


def _money(cents):
    return F.format_number(cents / 100, 2)


def papers(t):
    """Orders as papers of four kinds: order confirmations, sales contracts, purchase contracts and invoices."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    net = F.round(F.col("l_extendedprice") * 100).cast("long")
    lines = t("lineitem").select(F.col("l_orderkey").alias("k"), F.row_number().over(order).alias("nth"), "l_partkey", F.col("l_quantity").cast("int").alias("qty"), net.alias("net"), F.col("l_shipdate").cast("date").alias("ship"))
    unit = F.round(F.col("net") / F.col("qty")).cast("long")
    breaks = F.when(F.col("nth") % 2 == 1, F.lit("\n  made of\n  steel ")).otherwise(F.lit(" "))
    confirmed = F.concat(F.lpad(F.col("nth").cast("string"), 3, " "), F.lit(" Part "), F.col("l_partkey").cast("string"), breaks, F.format_string("%d.00", "qty"), F.lit("  "), _money(unit), F.lit("  "), _money(F.col("net")), F.lit("  "), F.col("ship").cast("string"), F.lit("\n   see the drawing"))
    sold = F.concat(F.lit("AB.1"), F.col("l_partkey").cast("string"), F.lit(" part"), breaks, F.col("qty").cast("string"), F.lit(" ￥"), _money(unit), F.lit(" ￥"), _money(F.col("net")))
    # Only confirmations and sales contracts show their lines, each in its own way.
    form = F.col("k") % 4
    said = F.when(form == 0, F.struct("nth", confirmed.alias("s"))).when(form == 1, F.struct("nth", sold.alias("s")))
    shown = F.array_join(F.transform(F.sort_array(F.collect_list(said)), lambda x: x["s"]), "\n")
    per = lines.groupBy("k").agg(F.sum("net").alias("items"), shown.alias("shown"))
    o = t("orders").select(F.col("o_orderkey").alias("k"), "o_custkey", F.col("o_orderdate").cast("date").alias("day")).join(per, "k")
    o = o.withColumns({"stated": F.col("items") + F.when(F.col("k") % 10 == 0, 100).otherwise(0), "vat": F.floor(F.col("items") / 10)})
    number = F.lpad(F.col("k").cast("string"), 7, "0")
    total = F.col("stated") + F.col("vat")
    ymd = lambda fmt: F.date_format("day", fmt)
    texts = [
        F.concat(F.lit("Order Confirmation\nOrder NO.: S0"), number, F.lit("\nDate: "), F.col("day").cast("string"), F.lit("\nCustomer No.: K"), F.col("o_custkey").cast("string"), F.lit("\nCurrency: EUR\nPos Description Qty Unit Net Delivery\n"), "shown",
                 F.lit("\nNet Value: "), _money(F.col("stated")), F.lit("\nVAT: "), _money(F.col("vat")), F.lit("\nTotal Value: "), _money(total), F.lit("\n1 Extra 1.00 9.00 9.00 2020-01-01")),
        F.concat(F.lit("合同细则 Contract\nContract number: SO"), number, F.lit("\nDate  "), ymd("yyyyMMdd"), F.lit("\nParty B： Buyer "), F.col("o_custkey").cast("string"), F.lit("\n"), "shown", F.lit("\nNet Total Amount ￥"), F.translate(_money(F.col("stated")), "0123456789,.", "０１２３４５６７８９，．"),
                 F.lit("\n本合同价款为 ￥"), _money(total), F.lit("\n交货时间：约 6 周")),
        F.concat(F.lit("买卖合同\n合同编号：HT"), number, F.lit("\n签订时间："), ymd("yyyy年MM月dd日"), F.lit("\n合计人民币金额（大写）：￥"), F.regexp_replace(_money(total), r"\.00$", ""), F.lit("\n交货期限：30 天\n结算方式：月结60天")),
        F.concat(F.lit("电子发票 发票号码："), F.lpad(F.col("k").cast("string"), 20, "9"), F.lit("\n"), ymd("yyyy年MM月dd日"), F.lit("\n名称：Buyer "), F.col("o_custkey").cast("string"), F.lit("\n名称：Seller\n金额 ￥"), _money(F.col("stated")), F.lit(" 税额 ￥"), _money(F.col("vat")), F.lit("\n价税合计（小写）￥"), _money(total)),
    ]
    return o.select("k", F.when(form == 0, texts[0]).when(form == 1, texts[1]).when(form == 2, texts[2]).when(form == 3, texts[3]).alias("text"))


@query(f"""with {_BASE}
select k, ['order_confirmation', 'sales_contract', 'purchase_contract', 'invoice'][form + 1] as kind,
       case form when 0 then 'SO' || lpad(k::varchar, 7, '0') when 1 then 'SO' || lpad(k::varchar, 7, '0') when 2 then 'HT' || lpad(k::varchar, 7, '0') else lpad(k::varchar, 20, '9') end as number,
       day::varchar as date, case form when 0 then 'EUR' else 'CNY' end as currency, case when form <> 2 then stated end as net_minor, case when form in (0, 3) then vat end as vat_minor, stated + vat as total_minor,
       case form when 0 then 'K' || o_custkey when 1 then 'Buyer ' || o_custkey when 3 then 'Buyer ' || o_custkey end as party, case form when 1 then '6' when 2 then '30' end as delivery
from d""")
def papers_read(t):
    """Kind and fields of every order's paper, full-width figures and a misread order number among them."""
    got = documents.read(papers(t), "k", "text")
    f = F.col("fields")
    return got.select("k", "kind", "number", "date", "currency", "net_minor", "vat_minor", "total_minor", F.coalesce(f["customer_no"], f["party"], f["buyer"]).alias("party"), F.coalesce(f["delivery_weeks"], f["delivery_days"]).alias("delivery"))


@query(f"""with {_BASE}
select l.k, l.nth::int as nth, case form when 0 then nth || ' Part ' || l_partkey else 'AB.1' || l_partkey || ' part' end || case when nth % 2 = 1 then ' made of steel' else '' end as text, qty::double as quantity,
       round(net / qty)::bigint as unit_minor, net as net_minor, case form when 0 then ship::varchar end as delivery, case when nth % 2 = 1 then 3 else 1 end::bigint as lines
from l join d using (k) where form < 2""")
def paper_items(t):
    """Line items of order confirmations and sales contracts; descriptions wrap over three lines, and a line behind the totals is none."""
    got = documents.line_items(documents.read(papers(t), "k", "text"), "k")
    return got.withColumn("quantity", F.col("quantity").cast("double"))


@query(f"""with {_BASE}, off as (select k, count(*) filter (where abs(qty * round(net / qty) - net) > 1) as n_off from l group by k)
select k, 'items differ from the net value' as finding from d where form < 2 and k % 10 = 0
union all select k, 'quantity times price differs' from d join off using (k) where form < 2 and n_off > 0""")
def paper_findings(t):
    """Papers whose items do not add up to what they state."""
    return documents.own_findings(documents.read(papers(t), "k", "text"), "k")
