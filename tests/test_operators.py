"""Record operators: invariants and small cases."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import blocks, headers, lookups, planning, resolve, rollups, winners
from recordloom.streaming.latest import LatestSink, first_of_each, newest_state


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_newest_wins_whatever_the_order(spark):
    data = [(k % 3, k % 5, k) for k in range(40)] + [(None, 1, 100), (None, 1, 101)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = rows(spark, data, "key int, stamp int, id int").repartition(3)
        kept = winners.newest_wins(df, ["key"], [F.col("stamp").desc(), F.col("id").desc()])
        lost = winners.superseded(df, ["key"], [F.col("stamp").desc(), F.col("id").desc()], "id")
        got = sorted((r.key is None, r.key, r.id, r.superseded) for r in kept.collect() if r.key is not None)
        assert kept.where("key is null").count() == 2
        assert kept.count() + lost.count() == len(data)
        results.add(tuple(got))
    assert len(results) == 1


def test_first_known_and_conflicts(spark):
    df = rows(spark, [("a", 1, "x", None), ("a", 2, "y", 7), ("b", 3, None, None)], "k string, id int, name string, n int")
    best = {r.k: (r.name, r.n, r.members) for r in winners.first_known(df, ["k"], F.struct("id"), ["name", "n"]).collect()}
    assert best == {"a": ("x", 7, 2), "b": (None, None, 1)}
    assert [(r.id, r.field, r.value, r.kept) for r in winners.conflicts(df, ["k"], F.struct("id"), ["name", "n"], "id").collect()] == [(2, "name", "y", "x")]


def test_hidden_total(spark):
    df = rows(spark, [(1, 10.0, "a"), (1, 20.0, "a"), (1, 30.0, "a"), (2, 10.0, "a"), (2, 20.0, "b"), (2, None, "a")], "doc int, amount double, party string")
    got = {r.doc: (r.hidden_total, r.missing_amount, r.several_parties) for r in rollups.document_issues(df, "doc", "amount", "party").collect()}
    assert got == {1: (True, False, False), 2: (False, True, True)}


def test_blocks_and_intervals(spark):
    df = rows(spark, [("s", k, k in (2, 5)) for k in range(1, 8)], "sheet string, row int, start boolean")
    spans = blocks.block_spans(df, ["sheet"], ["row"], F.col("start"), "row")
    assert sorted((r.first, r.last, r["items"]) for r in spans.collect()) == [(2, 4, 3), (5, 7, 3)]
    assert blocks.attach_to_intervals(df, spans, ["sheet"], "row").count() == 6


def test_roots_cut_cycles(spark):
    df = rows(spark, [("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("x", "y"), ("y", "x"), ("z", "z")], "id string, up string")
    got = {r.id: (r.root, r.depth) for r in lookups.roots(df, "id", "up").collect()}
    assert got["c"] == ("a", 2)
    assert got["d"] == ("d", 0)
    assert got["z"] == ("z", 0)
    assert got["x"][1] == got["y"][1] == 0


def test_greedy_overlap_uses_each_left_item_once(spark):
    left = rows(spark, [("g", 1, ["a", "b"]), ("g", 2, ["a"])], "g string, l int, s array<string>")
    right = rows(spark, [("g", 10, ["a", "b"]), ("g", 11, ["a", "b"])], "g string, r int, s array<string>")
    got = sorted((r.r, r.l, r.overlap) for r in lookups.greedy_overlap(left, right, "g", "l", "r", "s").collect())
    assert got == [(10, 1, 2), (11, 2, 1)]


def test_reset_running(spark):
    df = rows(spark, [("c", k, n) for k, n in enumerate([40, 50, 30, 200, 10])], "c string, k int, n int")
    got = [r.part for r in lookups.reset_running(df, "c", "k", "n", 100).orderBy("k").collect()]
    assert got == [0, 0, 1, 2, 3]


def test_second_run_plans_nothing(spark):
    wanted = rows(spark, [(1, 5, "x"), (2, 5, "y"), (3, 5, None)], "k int, stamp int, v string")
    held = rows(spark, [(2, 4, "z")], "k int, stamp int, v string")
    first = {r.k: r.action for r in planning.decide(wanted, held, "k", "stamp", ["v"]).collect()}
    assert first == {1: "create", 2: "update", 3: "create"}
    again = {r.action for r in planning.decide(wanted, newest_state(held, wanted, "k", "stamp"), "k", "stamp", ["v"]).collect()}
    assert again == {"same"}


def test_fill_blanks_never_overwrites(spark):
    held = rows(spark, [(1, None, "a"), (2, "b", "c")], "k int, x string, y string")
    wanted = rows(spark, [(1, "new", "other"), (2, None, "c")], "k int, x string, y string")
    patches, conflicts = planning.fill_blanks(held, wanted, "k", ["x", "y"])
    assert [tuple(r) for r in patches.collect()] == [(1, "x", "new")]
    assert [tuple(r) for r in conflicts.collect()] == [(1, "y", "a", "other")]


def test_zero_waits_for_answers(spark):
    held, now = rows(spark, [(1,), (2,)], "k int"), rows(spark, [(1,)], "k int")
    assert [r.k for r in planning.zero_missing(held, now, "k").collect()] == [2]
    assert planning.zero_missing(held, now, "k", rows(spark, [("?",)], "q string")).count() == 0
    assert [r.k for r in planning.zero_missing(held, now, "k", rows(spark, [], "q string")).collect()] == [2]


def test_answers_are_of_unordered_pairs(spark):
    df = rows(spark, [("b", "a", 1, True), ("a", "b", 2, False)], "a string, b string, at int, same boolean")
    assert [tuple(r) for r in planning.latest_answers(df, "a", "b", "at", "same").collect()] == [("a", "b", False)]


def test_cascade(spark):
    master = rows(spark, [("KD100001", "Huaxin Zhongyuan Machinery Co., Ltd."), ("KD100002", "上海华星精密机械有限公司"), ("KD100003", "Brandenburger Werkzeuge GmbH"), ("KD100004", "Beijing Longfeng Tools"), ("KD100005", "Twin GmbH"), ("KD100006", "Twin Ltd")], "code string, name string")
    cases = {
        "KD0100001 anything": None, "0KD100003": ("KD100003", "code"), "huaxin zhongyuan machinery": None, "Brandenburger Werkzeuge": ("KD100003", "exact"),
        "Twin": (None, "ambiguous"), "Brandenburger Werkzeug": ("KD100003", "contains"), "Brandenburgar Werkzeuge": ("KD100003", "fuzzy"), "Completely Elsewhere": (None, "new"), "???": (None, "none"),
        "Shanghai": (None, "new"), "Shanghai Longfeng": (None, "review"), "Decided Name": (None, "new"),
    }
    names = rows(spark, [(n,) for n in cases], "name string")
    got = {r.name: r for r in resolve.match_companies(names, "name", master, "name", "code", rows(spark, [("Decided Name",)], "name string")).collect()}
    assert set(got) == set(cases)
    for name, want in cases.items():
        if want:
            assert (got[name].code, got[name].method) == want, (name, got[name])
    assert all((r.score >= 0.9) == (r.method in ("code", "exact", "new", "contains", "fuzzy")) for r in got.values() if r.method != "fuzzy")


def test_blocking_misses_no_acceptable_pair(spark):
    rng = random.Random(5)
    letters = "abcdefghij"
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(8, 14))) for _ in range(120)]
    names += [n[:3] + n[4:] for n in names[:40]] + [n[:5] + "x" + n[5:] for n in names[40:80]]
    from recordloom.functions.similarity import indel_ratio

    want = {(a, b) for a in names for b in names if a < b and indel_ratio(a, b) >= 90}
    df = rows(spark, [(n,) for n in set(names)], "name string")
    got = {(r.a, r.b) for r in resolve.lookalikes(df, "name", least=90.0).collect() if indel_ratio(r.a, r.b) >= 90}
    assert want == got


def test_pick_name(spark):
    df = rows(spark, [("d", "Delta", 3, 9), ("d", "Dlta", 0, 3), ("e", "X", 0, 2), ("e", "Y", 0, 2), ("f", "Solo", 1, 1)], "k string, name string, tied int, seen int")
    got = {r.k: (r.name, r.verdict) for r in resolve.pick_name(df, "k", "name", "tied", "seen").collect()}
    assert got == {"d": ("Delta", "picked"), "e": (None, "conflict"), "f": ("Solo", "picked")}


def test_sensitive_columns_never_come_through(spark):
    cells = rows(spark, [("f", "s", 1, 1, "Name"), ("f", "s", 1, 2, "IBAN"), ("f", "s", 1, 3, "Mood"), ("f", "s", 2, 1, "Li"), ("f", "s", 2, 2, "SECRET"), ("f", "s", 2, 3, "ok")], "file string, sheet string, row int, col int, text string")
    words = headers.synonyms(spark, {"name": ["name"], "iban": ["iban"]})
    found = headers.find_headers(cells, words, 1, ["name"])
    out = headers.pivoted(cells, found, ["name", "iban"]).join(headers.extras(cells, found), ["file", "sheet", "row"], "left")
    assert "SECRET" not in str(out.collect())
    assert out.first().extra == {"Mood": "ok"}


def test_sections_end_before_the_next_header(spark):
    cells = rows(spark, [("f", "s", r, c, t) for r, line in enumerate([("Name", "City"), ("a", "x"), ("Name", "City"), ("b", "y")], 1) for c, t in enumerate(line, 1)], "file string, sheet string, row int, col int, text string")
    found = headers.find_headers(cells, headers.synonyms(spark, {"name": ["name"], "city": ["city"]}), 2, ["name"], first_only=False)
    got = sorted((r.header_row, r.row, r.name) for r in headers.pivoted(cells, found, ["name", "city"]).collect())
    assert got == [(1, 2, "a"), (3, 4, "b")]


def test_stream_keeps_the_newest(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    schema = "k int, stamp timestamp, v string"
    sink = LatestSink(str(target), "k", "stamp", ["v"])
    for n, data in enumerate([[(1, "2026-01-02", "new"), (2, "2026-01-01", "a")], [(1, "2026-01-01", "old"), (3, "2026-01-01", "c")]]):
        rows(spark, data, "k int, stamp string, v string").selectExpr("k", "timestamp(stamp) stamp", "v").coalesce(1).write.parquet(str(source / str(n)))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert {r.k: r.v for r in sink.target(spark).collect()} == {1: "new", 2: "a", 3: "c"}
    plan = {r.k: r.action for r in spark.read.parquet(str(target / "plan/000000000001-run-1")).collect()}
    assert plan == {1: "newer", 3: "create"}
    assert first_of_each(spark.readStream.schema(schema).parquet(str(source)), ["k"], "stamp").isStreaming


def test_sink_bridges_gaps_and_new_checkpoints(spark, tmp_path):
    batch = lambda *data: rows(spark, list(data), "k int, stamp int, v string")
    held = lambda sink: {r.k: r.v for r in sink.target(spark).collect()}
    sink = LatestSink(str(tmp_path / "t"), "k", "stamp", ["v"])
    with pytest.raises(FileNotFoundError):
        sink(batch((1, 1, "a")), 5)
    sink(batch((1, 1, "a")), 0)
    sink(batch((2, 1, "b")), 2)
    assert held(sink) == {1: "a", 2: "b"}
    sink(batch((3, 1, "again")), 2)
    assert held(sink) == {1: "a", 2: "b"}
    later = LatestSink(str(tmp_path / "t"), "k", "stamp", ["v"], run="second", keep=2)
    later(batch((1, 2, "new"), (2, 0, "old")), 0)
    assert held(later) == {1: "new", 2: "b"}
    assert [v for v, _, _ in later.versions(spark)] == [1, 2]
