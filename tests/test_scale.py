"""Plans that must keep their shape at size: no joins on missing keys, no work left to one task, no part of a text worked on twice."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry
from recordloom.operators import accounts, documents, rollups

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]


def test_totals_meet_their_documents_without_a_join(spark):
    docs = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 7.0), (2, 8.0), (3, 9.0), (4, 1.0), (5, None), (None, 2.0)], "k int, stated double")
    lines = spark.createDataFrame([(1, 1.25), (1, 2.0), (2, None), (3, 1.0), (3, None), (5, None), (6, 3.0), (None, 4.0)], "k int, amount double")
    got = rollups.total_of_lines_or_stated(docs, lines, "k", F.col("amount"), F.col("stated"))
    joined = rollups.total_or_stated(docs.join(lines, "k"), ["k"], F.col("amount"), F.col("stated"))
    want = {1: Decimal("6.50"), 2: None, 3: Decimal("9.00"), 5: None}
    assert dict(got.collect()) == dict(joined.collect()) == want
    assert "Join" not in plan(entry.queries()["local_total"](spark, SF))


def test_people_read_distinct_rows_and_join_nothing(spark):
    rows = [(1, 3, "Li Wei", "010-12345678", None, "/"), (1, 1, "li wei", None, "13812345678", "a@b.com"), (1, 2, "Li Wei", "010-12345678", None, "/"), (1, None, None, "12", None, None), (1, 4, None, "12", None, None)]
    df = spark.createDataFrame(rows, "account int, row int, name string, phone string, mobile string, email string")
    out = accounts.people(df, "account", "row", "name", "phone", "mobile", "email")
    got = {r.person: (r.name, r.phones, r.emails, r.other) for r in out.collect()}
    assert got == {"liwei": ("li wei", ["+8613812345678", "+861012345678"], ["a@b.com"], []), None: (None, [], [], ["phone 12"])}
    assert "Join" not in plan(out)


def test_phone_cells_of_a_small_file_are_many_tasks(spark):
    assert entry.queries()["account_phones"](spark, SF).rdd.getNumPartitions() > 1


def test_letters_are_not_sorted_by_a_lambda(spark):
    assert "lambdafunction" not in plan(entry.queries()["cell_conservation"](spark, SF))


def test_an_archive_writes_the_indexes_it_is_asked_for(spark):
    from recordloom.plans.archives import order_archive

    name = order_archive(lambda table: spark.read.parquet(f"{SF}/{table}.parquet"), ("id", "source"))
    assert [spark.catalog.tableExists(f"{name}_by_{index}") for index in ("id", "source", "sender", "participant")] == [True, True, False, False]


def test_lines_of_papers_stay_in_their_rows(spark):
    rows = [(1, "Order Confirmation\nOrder NO.: SO1111111\n1 A\n 2 B 2.00 10.00 25.00 2026-01-01\nskipped\n3 C 1.00 1.00 1.00 2026-01-01\nNet Value: 30.00\nVAT: 3.00\nTotal Value: 30.00\n4 D 1.00 1.00 1.00 2026-01-01"), (2, "Order Confirmation\nOrder NO. SO2222222"), (3, "other"), (4, None)]
    papers = documents.read(spark.createDataFrame(rows, "k int, body string"), "k", "body")
    items = documents.line_items(papers, "k")
    assert "Exchange" not in plan(items) and "Window" not in plan(items)
    assert [(r.k, r.nth, r.text, r.lines) for r in items.orderBy("nth").collect()] == [(1, 1, "1 A 2 B", 2), (1, 2, "3 C", 1)]
    got, apart = documents.own_findings(papers, "k"), documents.findings(papers, items, "k")
    assert sorted(got.collect()) == sorted(apart.collect()) and "Join" not in plan(got)
    assert {r.finding for r in got.where("k = 2").collect()} == {"no line items"}


def test_a_number_is_cleaned_once(spark):
    from recordloom.functions.numbers import parse_number

    assert str(parse_number(F.col("t"))).count("translate(") == 1
