"""Counters of stages, and the check that what went into a reader came out."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators import conservation
from recordloom.operators.progress import Progress

CELLS = "file string, sheet string, row int, col int, text string, merge_row int, merge_col int"
HEAD = ["Document No.", "Document Date", "Customer", "Order Status", "Sales Quantity", "Net amount"]
BOOK = [["Export"], HEAD, ["SO1", "2026-03-04", "Delta", "open", "2", "10.50"], [None, "2026-03-04", "Delta", "open", "2", "3"], [None] * 6, ["SO2", "soon", "Iota", "open", "1", "x"], ["Total", None, None, None, None, "13.5"]]


def cells(spark, *lines):
    rows = [("o.xlsx", "S", r, c, t, None, None) for r, line in enumerate(lines, 1) for c, t in enumerate(line, 1) if t is not None]
    return spark.createDataFrame(rows, CELLS)


def test_all_is_well(spark):
    family = conservation.ADAPTERS["orders"]
    balanced = conservation.balance(cells(spark, *BOOK), family)
    got = {r.row: (r.n_in, r.n_out, r.reviewed) for r in balanced.collect()}
    assert got == {3: (1, 1, False), 4: (1, 0, True), 6: (1, 1, True), 7: (1, 0, True)}
    assert conservation.findings(balanced, family.amounts).count() == 0
    row = conservation.self_test(cells(spark, *BOOK), {"orders": family}).first()
    assert tuple(row) == ("orders", 4, 2, 2, 0)


def test_no_cells(spark):
    got = conservation.self_test(spark.createDataFrame([], CELLS), {"orders": conservation.ADAPTERS["orders"]}).collect()
    assert [tuple(r) for r in got] == [("orders", 0, 0, 0, 0)]


def test_customer_lists_side_by_side(spark):
    erp = ["客户编码", "客户名称", "省直辖市", None, None, "Customer Code", "CN Name", "EN Name"]
    book = cells(spark, erp, ["CR000001", "甲一", "江苏省", None, None, "CR000002", "乙二", "B"], [None, "甲三", None, None, None, "CR000004", "丁", "D"])
    balanced = conservation.balance(book, conservation.CustomerLists())
    assert {r.row: (r.n_in, r.n_out, r.reviewed) for r in balanced.collect()} == {2: (2, 2, False), 3: (2, 1, True)}
    assert conservation.findings(balanced).count() == 0


def test_stages_are_counted_as_written(spark):
    heard = []
    job = Progress(spark, lambda stage, what, counts: heard.append((stage, what, counts.get("rows"))))
    first = job.stage("first", spark.range(1000).repartition(7), {"sum": F.sum("id"), "odd": F.sum(F.col("id") % 2)})
    second = job.stage("second", first.where("id < 0"), {"sum": F.sum("id")})
    assert (first.count(), second.count()) == (1000, 0)
    got = {(r.stage, r.nth, r.measure): int(r.value) for r in job.report().collect()}
    assert got == {("first", 1, "rows"): 1000, ("first", 1, "sum"): 499500, ("first", 1, "odd"): 500, ("second", 2, "rows"): 0, ("second", 2, "sum"): 0}
    assert [(s, w, None if n is None else int(n)) for s, w, n in heard] == [("first", "began", None), ("first", "ended", 1000), ("second", "began", None), ("second", "ended", 0)]
    assert job.checked().count() == 0
    with pytest.raises(ValueError, match="ran before"):
        job.stage("first", spark.range(1))


def test_a_stage_that_fails_leaves_no_counts_and_a_listener_stops_nothing(spark):
    def told(stage, what, counts):
        raise RuntimeError("listener")

    job = Progress(spark, told)
    with pytest.raises(Exception, match="boom"):
        job.stage("bad", spark.range(10).select(F.raise_error(F.lit("boom")).cast("string").alias("x")))
    assert job.report().count() == 0 and job.checked().count() == 0
    assert job.stage("bad", spark.range(3)).count() == 3
    table = job.tables["bad"][0]
    job.tables["bad"] = (table.where("id > 0"), job.tables["bad"][1])
    assert [(r.stage, r.measure, int(r.value), int(r.held)) for r in job.checked().collect()] == [("bad", "rows", 3, 2)]
