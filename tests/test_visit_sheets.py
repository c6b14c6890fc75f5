"""The fixed layout and trip reports."""

import datetime as dt

from pyspark.sql import functions as F

from recordloom.operators import visit_sheets

CELLS = "file string, sheet string, row int, col int, text string, fill string"


def cells(spark, sheet, table, file="Visits 2026.xlsx"):
    """``table``: row number to a list of (column, text) or (column, text, fill)."""
    rows = [(file, sheet, r, c[0], c[1], c[2] if len(c) > 2 else None) for r, line in table.items() for c in line]
    return spark.createDataFrame(rows, CELLS)


def test_fixed_layout(spark):
    good = cells(spark, "CW21", {
        1: [(1, "Name"), (2, "Anna Berg"), (10, "Summary")], 2: [(1, "Monday"), (2, "Visit Delta"), (10, "All went well")], 3: [(1, "Tue"), (10, "Next week more")],
        5: [(1, "Date"), (3, "Customer")],
        6: [(1, "18-May"), (2, "Suzhou"), (3, "Delta"), (10, "Talk"), (11, "Send quote", "FF92D050"), (12, "CW 22")], 7: [(11, "Call again")],
        8: [(1, "18-May"), (3, "Iota")], 9: [(1, "someday"), (3, "Rho")],
    })
    bad = cells(spark, "CW22", {1: [(1, "no header")]}).unionByName(cells(spark, "Plan", {4: [(1, "Date")]}))
    visits, weeks, review = visit_sheets.fixed_layout(good.unionByName(bad), F.regexp_extract("file", r"(20\d\d)", 1).cast("int"))
    got = {r.customer: r for r in visits.collect()}
    assert [(got[c].first_row, got[c].last_row, got[c].day, got[c].order_in_day, got[c].owner) for c in ("Delta", "Iota", "Rho")] == [
        (6, 7, dt.date(2026, 5, 18), 0, "Anna Berg"), (8, 8, dt.date(2026, 5, 18), 1, "Anna Berg"), (9, 9, None, 0, "Anna Berg"),
    ]
    assert [(n.text, n.highlight, n.deadline) for n in got["Delta"].notes] == [("Send quote", "green", "CW 22"), ("Call again", None, None)]
    (week,) = weeks.collect()
    assert (week.week, week.monday, week.summary) == (21, dt.date(2026, 5, 18), ["All went well", "Next week more"])
    assert [(d.day, d.plan) for d in week.days] == [(dt.date(2026, 5, 18), "Visit Delta"), (dt.date(2026, 5, 19), "")]
    assert {(r.sheet, r.reason) for r in review.collect()} == {("CW22", "no date header"), ("Plan", "no week in the sheet's name")}


def test_trip_report(spark):
    report = cells(spark, "5.18 Delta", {
        2: [(1, "Customer name:"), (3, "Delta Exhibition")], 4: [(1, "Participants:"), (2, "Li Wei"), (4, "director of Delta")], 5: [(2, "Wang Yao"), (4, "manager Iota Co., Ltd")], 7: [(2, "Not listed")],
        10: [(1, "ID"), (2, "Typ"), (3, "Date"), (4, "From"), (5, "General topic"), (6, "Details"), (7, "WV"), (8, "Wer"), (9, "Status")],
        11: [(1, "1"), (3, "2026-05-18"), (4, "Anna.Berg"), (5, "Visit to Iota and lunch"), (6, "first line"), (7, "2026-06-01"), (8, "Anna")], 12: [(6, "second line"), (9, "open")],
        13: [(1, "2"), (5, "General remarks"), (8, "Carl Stein")],
    })
    visits, review = visit_sheets.trip_reports(report, F.lit(2026), ["Anna Berg", "Carl Stein"])
    first, second = sorted(visits.collect(), key=lambda r: r.first_row)
    assert (first.customer, first.contact, first.owner, first.day, first.last_row, first.state, first.event) == ("Iota", "Wang Yao", "Anna Berg", dt.date(2026, 5, 18), 12, "open", "Delta Exhibition")
    assert [(n.text, n.highlight, n.due) for n in first.notes] == [("first line\nsecond line", None, None), ("Visit to Iota and lunch (Wer: Anna)", "green", dt.date(2026, 6, 1))]
    assert [p.name for p in first.people] == ["Li Wei", "Wang Yao"]
    # The second item has no date of its own: the sheet's name has one.
    assert (second.customer, second.contact, second.owner, second.day, second.kind) == ("Delta Exhibition", "Li Wei", "Carl Stein", dt.date(2026, 5, 18), "exhibition")
    assert review.count() == 0
    bare, missing = visit_sheets.trip_reports(report.where("row <> 2 and row < 12"), F.lit(2026), ["Anna Berg"])
    assert bare.count() == 0 and missing.count() == 0
