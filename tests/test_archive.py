"""Stored indexes of an archive: what they find and that they stay where they lie."""

import datetime as dt

import pytest

from recordloom.sources import archive

PERSON = "struct<name: string, email: string>"
SCHEMA = f"message_id string, date timestamp, subject string, files array<string>, sender {PERSON}, recipients array<{PERSON}>, copies array<{PERSON}>, body string"
AT = dt.datetime(2026, 5, 18)
MAILS = [
    ("1", AT, "a", ["in/1", "all"], ("Jane Doe", "Jane@Delta.com"), [("", "b@x.com")], None, "x"),
    ("2", AT, None, ["all"], ("Doe, Jane", "IMCEAEX-legacy"), None, [("B", "b@x.com")], "x"),
    ("3", AT, "c", ["in/3"], ("Li Wei", "imceaex-li"), [("Wei Li", "li@a.com"), ("li wei", "li@b.com")], [], ""),
    ("4", None, "", None, None, [], [], None),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    archive.store(spark.createDataFrame(MAILS, SCHEMA), "small_archive", str(tmp_path_factory.mktemp("archive") / "t"), buckets=4, slots=3)
    return "small_archive"


def test_senders_by_name(spark):
    got = {r.message_id: r.from_address for r in archive.with_senders(spark.createDataFrame([m[:5] + tuple(p or [] for p in m[5:7]) + m[7:] for m in MAILS], SCHEMA)).collect()}
    assert got == {"1": "jane@delta.com", "2": "jane@delta.com", "3": "imceaex-li", "4": None}


def test_find(spark, stored):
    rows = [(1, "1", None), (2, "no", "in/3"), (3, None, "all"), (4, "no", "gone"), (5, None, None), (5, None, None), (6, "2", "in/3")]
    got = archive.find(stored, spark.createDataFrame(rows, "mail int, message_id string, key string"), "message_id", "key")
    assert got.columns == ["mail", "message_id", "key", "found", "how"]
    assert sorted((r.mail, r.found or "", r.how) for r in got.collect()) == [
        (1, "1", "id"), (2, "3", "source"), (3, "", "ambiguous"), (4, "", "none"), (5, "", "none"), (5, "", "none"), (6, "2", "id"),
    ]


def test_look_up(spark, stored):
    asked = spark.createDataFrame([("jane@delta.com",), ("b@x.com",), (None,), ("",)], "slot string")
    names = lambda index: sorted((r.slot, r.mail.message_id) for r in archive.look_up(stored, index, asked, "slot").collect())
    assert names("sender") == [("jane@delta.com", "1"), ("jane@delta.com", "2")]
    assert names("participant") == [("b@x.com", "1"), ("b@x.com", "2"), ("jane@delta.com", "1"), ("jane@delta.com", "2")]


@pytest.mark.parametrize("partitions", [2, 4, 16])
@pytest.mark.parametrize("index", archive.INDEXES)
def test_index_is_not_moved(spark, stored, index, partitions):
    """Neither with fewer nor with more shuffle partitions than buckets, without a broadcast, is there an exchange above the index."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        asked = spark.range(1000).selectExpr("cast(id as string) k")
        plan = archive.look_up(stored, index, asked, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "Bucketed: true" in plan
    above = plan[: plan.index("FileScan")].splitlines()
    assert plan.count("Exchange ") == 1
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = depth(plan[plan.index("FileScan") - 200 : plan.index("FileScan")].splitlines()[-1])
    over = []
    for line in reversed(above[:-1]):
        if depth(line) < scan:
            scan = depth(line)
            over.append(line)
    assert over and not any("Exchange" in line for line in over)


def test_empty_archive(spark, tmp_path):
    archive.store(spark.createDataFrame([], SCHEMA), "empty_archive", str(tmp_path / "t"), buckets=2)
    got = archive.find("empty_archive", spark.createDataFrame([("1", "all")], "a string, b string"), "a", "b").collect()
    assert [(r.found, r.how) for r in got] == [(None, "none")]
