"""The log of answers and other JSON inputs."""

import datetime as dt

from recordloom.sources import decisions


def test_answers_are_a_log(spark, tmp_path):
    path = str(tmp_path / "answers")
    assert decisions.answers(spark, path).count() == 0
    day = lambda n: dt.datetime(2026, 5, n)
    rows = lambda *data: spark.createDataFrame(list(data), decisions.ANSWERS)
    decisions.remember(rows(("Delta", "new", "li", day(1)), ("Iota", "C1", "li", day(1)), (None, "x", "li", day(1))), path)
    decisions.remember(rows(("Delta", "C2", "wang", day(2)), ("Iota", None, "wang", day(3)), ("Rho", "C3", "li", day(1))), path)
    assert {r.question: r.answer for r in decisions.answers(spark, path).collect()} == {"Delta": "C2", "Rho": "C3"}
    (tmp_path / "answers" / "late.json").write_text('{"question": "Rho", "answer": "C4", "answered_at": "2026-05-09T00:00:00Z"}\nno json\n')
    rows, broken = decisions.side_input(spark, path, decisions.ANSWERS)
    assert rows.count() == 6 and [r.line for r in broken.collect()] == ["no json"]
    assert {r.question: r.answer for r in decisions.answers(spark, path).collect()}["Rho"] == "C4"


def test_suggestions(spark):
    table = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.9), ("b", "x", 0.84), ("c", "z", 0.85)], "q string, name string, score double")
    assert {(r.q, r.name) for r in decisions.suggestions(table, "q", "name", "score").collect()} == {("a", "x"), ("c", "z")}
