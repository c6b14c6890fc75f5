"""Families of workbooks and the mail operators on small tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from recordloom.operators import families, mail
from recordloom.sources import sinks

CELLS = "file string, sheet string, row int, col int, text string, merge_row int, merge_col int"


def sheet(spark, *books):
    rows = [(f, s, r, c, t, None, None) for f, s, lines in books for r, line in enumerate(lines, 1) for c, t in enumerate(line, 1) if t is not None]
    return spark.createDataFrame(rows, CELLS)


ORDERS = ("o.xlsx", "Export", [["Export 2026"], ["Document No.", "Document Date", "Customer", "Order Status", "Sales Quantity", "Amount Excl. Tax", "Bank account", "Colour"],
          ["SO1", "2026-03-04", "Delta", "Completed", "2", "1,234.50", "secret", "red"], ["SO2", "soon", "Iota", "open", "1", "x", None, None], ["Total", None, None, None, "3", "2,000"], [None, None, "no number", None]])
VISITS = ("v.xlsx", "CW21", [["Owner:", "Li"], ["Date", "Customer (full address)", "Potential", "Next Step / Action", "Due Date"], ["18-May", "Delta Ltd", "A", "send offer", "next week"], [None, None, None, "call back", "5.20"], ["19-May", "Iota", None, None, None], [None, "No date", None, None, None]])


def test_orders(spark):
    records, review = families.read(sheet(spark, ORDERS), "orders")
    got = {r.document_no: r for r in records.collect()}
    assert set(got) == {"SO1", "SO2"}
    assert (got["SO1"].date, got["SO1"].net, got["SO1"].status, got["SO1"].extra) == (dt.date(2026, 3, 4), Decimal("1234.50"), "completed", {"Colour": "red"})
    assert sorted(got["SO2"].issues) == ["date", "net"]
    assert "secret" not in str(records.collect()) + str(review.collect())
    assert sorted((r.row, r.field or "", r.reason) for r in review.collect()) == [(4, "date", "unreadable value"), (4, "net", "unreadable value"), (5, "", "total row"), (6, "", "no key")]
    labels = {r.label: r.sensitive for r in families.unread_labels(sheet(spark, ORDERS), "orders").collect()}
    assert labels == {"Bank account": True, "Colour": False}


def test_classify(spark):
    other = ("x.xlsx", "S", [["a", "b"], ["c", "d"]])
    got = {r.file: r.family for r in families.classify(sheet(spark, ORDERS, VISITS, other)).collect()}
    assert got == {"o.xlsx": "orders", "v.xlsx": "visits", "x.xlsx": "unrecognised"}


def test_visits(spark):
    kept, review = families.visits(sheet(spark, VISITS), F.lit(2026), "owner")
    got = {r.customer: r for r in kept.collect()}
    assert set(got) == {"Delta Ltd", "Iota"}
    delta = got["Delta Ltd"]
    assert (delta.owner, delta.day, delta.first_row, delta.last_row) == ("Li", dt.date(2026, 5, 18), 3, 4)
    assert [(n.text, n.due) for n in delta.notes] == [("send offer", dt.date(2026, 5, 25)), ("call back", dt.date(2026, 5, 20))]
    assert delta.visit_id == "li:2026-05-18:deltaltd"
    assert [(r.customer, r.reason) for r in review.collect()] == [("No date", "no date")]


MAILS = "message_id string, date string, sender struct<name:string,email:string>, recipients array<struct<name:string,email:string>>, copies array<struct<name:string,email:string>>, subject string, body string, bulk boolean"


def mails(spark):
    me, jane, wei = ("Me", "me@own.com"), ("Jane Doe", "jane@mail.delta.com"), ("张伟", "jane@mail.delta.com")
    crowd = [("x", f"a@d{k}.com") for k in range(9)]
    rows = [
        ("1", "2026-01-01", jane, [me], [], "RFQ", "please quote", False), ("2", "2026-01-02", me, [jane], None, "Re: RFQ", "our offer", False), ("3", "2026-01-03", ("News", "news@list.org"), [me], [], "hello", "x", True),
        ("4", "2026-01-04", me, crowd, [], "party", "x", False), ("5", "2026-01-05", wei, [me], [], "Re: RFQ", "ok", False),
    ]
    return spark.createDataFrame(rows, MAILS)


def test_relevance(spark):
    got = {r.key: r for r in mail.relevance(mail.evidence(mails(spark), ["own.com"])).collect()}
    assert (got["delta.com"].keep, got["delta.com"].reason, got["delta.com"]["in"], got["delta.com"].out) == (True, "inquiries", 2, 1)
    assert (got["list.org"].keep, got["list.org"].reason) == (False, "automated only")
    assert got["d3.com"].reason == "mass mail only"


def test_people(spark):
    got = {r.email: r for r in mail.people(mails(spark)).collect()}
    jane = got["jane@mail.delta.com"]
    assert (jane.name, jane.native_name, jane.messages, jane.sent, jane.first_seen) == ("Jane Doe", "张伟", 3, 2, "2026-01-01")


def test_signature_and_phones(spark):
    text = "Hi\n\nJane Doe\nSales Manager\nDelta Machines Co., Ltd.\nTel: +86 021 3416 1967"
    got = spark.range(1).select(mail.signature(F.lit(text)).alias("s"), mail.without_legal_form(F.lit("Delta Machines Co., Ltd.")).alias("n")).first()
    assert (got.s.phones, got.s.company, got.s.title, got.n) == (["+862134161967"], "Delta Machines Co., Ltd.", "Sales Manager", "Delta Machines")
    found = spark.createDataFrame([("1", "a", "A"), ("1", "b", "A"), ("2", "a", "A"), ("2", "c", "C"), ("3", "a", "A"), ("3", "a", "A"), ("3", "c", "C")], "phone string, person string, company string")
    assert sorted(tuple(r) for r in mail.phone_owner(found, "phone", "person", "company").collect()) == [("1", "a"), ("1", "b"), ("3", "a")]


def test_folders_and_facts(spark):
    got = spark.range(1).select(mail.folder_class(F.lit("Customers/Delta/Offers")).alias("f")).first().f
    assert (got.company, got.kind, got.sent, got.topic) == ("Delta", "customer", False, "Offers")
    facts = spark.createDataFrame([(1, ["SO123", "jane@x.com"]), (2, ["SO999"])], "fact_id int, tokens array<string>")
    corpus = spark.createDataFrame([("Order SO123 for jane@x.com, thanks",)], "text string")
    kept, rejected = mail.grounded(facts, "tokens", corpus, "text")
    assert [r.fact_id for r in kept.collect()] == [1]
    assert [(r.fact_id, r.unknown) for r in rejected.collect()] == [(2, ["so999"])]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert sinks.append_missing(rows, str(tmp_path / "t"), ["k"]).count() == 2
    assert sinks.append_missing(rows, str(tmp_path / "t"), ["k"]).count() == 0
    sinks.report_csv(rows.withColumn("l", F.array("v")), str(tmp_path / "r"), ["k"])
    assert (tmp_path / "r").exists()
    plan = sinks.field_plan(spark.createDataFrame([("a", "int"), ("b", "int"), ("c", "int")], "name string, type string"), spark.createDataFrame([("a", "int"), ("b", "text")], "name string, type string"))
    assert {r.name: (r.action, r.target) for r in plan.collect()} == {"a": ("reuse", "a"), "b": ("suffix", "b_int"), "c": ("create", "c")}
