"""Business papers: kinds, fields, items over several lines, tables under a header, sums."""

from decimal import Decimal

from recordloom.operators import documents

CONFIRMED = """Order Confirmation
Order NO.: S01234567   Date: 2026-05-04
Customer No.: K77
Contact Person: Ann Berg Tel 1
Terms of delivery: EXW
1 Table for the
  left side
  AB.12 2.00 1,000.00 2,000.00 2026-06-01
   drawing 3-123-456-7890
2 Screw 10.00 0.50 5.00 2026-06-02
Net Value: 2,005.00
VAT: 200.50
Total Value: 2,205.50
3 Not an item 1.00 1.00 1.00 2026-06-02
"""
CONTRACT = "合同细则 Contract\n合同号：SO7654321\nDate 20260504\nParty B: Some Buyer\n1 AB.12.3 Table\n with a cover 2 ￥1，000.00 ￥2，000.00\nNet Total Amount ￥2,000.00\nContract value is two\nthousand yuan (￥2,260.00)\nwithin the 30 calendar days"
PURCHASE = "买卖合同\n合同编号：HT12\n签订时间：2026年05月04日\n合计人民币金额：￥1,234\n提供12个月的保修\n结算方式：月结60天"
INVOICE = "电子发票\n12345678901234567890\n2026年05月04日\n名称：买方公司 名称：卖方公司\n91310000AAAAAAAAA1 91310000BBBBBBBBB2\n￥100.00 ￥13.00\n价税合计（小写）￥113.00"
BROKEN = "Order Confirmation\nOrder NO.: SO1111111\n1 A 2.00 10.00 25.00 2026-01-01\nNet Value: 30.00\nVAT: 3.00\nTotal Value: 30.00"
PAPERS = [(1, CONFIRMED), (2, CONTRACT), (3, PURCHASE), (4, INVOICE), (5, BROKEN), (6, "Order Confirmation without a number"), (7, None), (8, ""), (9, "Order Confirmation\nOrder NO. SO2222222"), (10, "x\n" * 5000)]


def read(spark, papers=PAPERS):
    return documents.read(spark.createDataFrame([(*p, "clash") for p in papers], "k int, body string, kind string"), "k", "body")


def test_kinds_and_fields(spark):
    got = {r.k: r for r in read(spark).collect()}
    head = {k: (r.kind, r.number, r.date, r.currency, r.net_minor, r.vat_minor, r.total_minor) for k, r in got.items()}
    none = (None,) * 7
    assert head == {
        1: ("order_confirmation", "SO1234567", "2026-05-04", "CNY", 200500, 20050, 220550), 2: ("sales_contract", "SO7654321", "2026-05-04", "CNY", 200000, None, 226000), 3: ("purchase_contract", "HT12", "2026-05-04", "CNY", None, None, 123400),
        4: ("invoice", "12345678901234567890", "2026-05-04", "CNY", 10000, 1300, 11300), 5: ("order_confirmation", "SO1111111", None, "CNY", 3000, 300, 3000), 6: none, 7: none, 8: none, 9: ("order_confirmation", "SO2222222", None, "CNY", None, None, None), 10: none,
    }
    assert got[1].fields == {"customer_no": "K77", "contact": "Ann Berg", "incoterm": "EXW"} and got[2].fields == {"party": "Some Buyer", "payment_days": "30"}
    assert got[3].fields == {"warranty_months": "12", "payment_days": "60"} and got[4].fields == {"buyer": "买方公司", "seller": "卖方公司", "buyer_tax_id": "91310000AAAAAAAAA1", "seller_tax_id": "91310000BBBBBBBBB2"}


def test_items_and_findings(spark):
    papers = read(spark)
    items = documents.line_items(papers, "k")
    got = {(r.k, r.nth): (r.text, r.quantity, r.unit_minor, r.net_minor, r.delivery, r.lines) for r in items.collect()}
    assert got == {
        (1, 1): ("1 Table for the left side AB.12", Decimal(2), 100000, 200000, "2026-06-01", 3), (1, 2): ("2 Screw", Decimal(10), 50, 500, "2026-06-02", 1),
        (2, 1): ("1 AB.12.3 Table with a cover", Decimal(2), 100000, 200000, None, 2), (5, 1): ("1 A", Decimal(2), 1000, 2500, "2026-01-01", 1),
    }
    assert {(r.k, r.finding) for r in documents.findings(papers, items, "k").collect()} == {
        (5, "items differ from the net value"), (5, "quantity times price differs"), (5, "net and tax differ from the total"), (9, "no line items"),
    }
    assert read(spark, []).count() == 0 and documents.line_items(read(spark, []), "k").count() == 0


def test_cells_under_a_header(spark):
    lines = ["List of parts", "Pos  Name          Qty", "1    Table for     2", "     the left", "2    Screw (M 8)   10", "", "3    Not here      1"]
    rows = spark.createDataFrame([("d", k, x) for k, x in enumerate(lines)] + [("e", 0, "no table")], "k string, at int, line string")
    got = documents.under_header(rows, ["k"], "at", "line", ["Pos", "Name", "Qty"]).orderBy("at").collect()
    assert [(r.at, r.Pos, r.Name, r.Qty) for r in got] == [(2, "1", "Table for the left", "2"), (4, "2", "Screw (M 8)", "10")]
