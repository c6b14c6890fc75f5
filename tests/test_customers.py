"""Cells of customers, owners, topics and phones."""

import pytest
from pyspark.sql import functions as F

from recordloom.functions import customers, dates, status
from recordloom.operators import accounts, lookups, mail


def each(spark, function, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in rows.select("k", function(F.col("v")).alias("x")).orderBy("k").collect()]


def test_split_customer(spark):
    cases = {
        None: ("", "", True), " / ": ("", "", True), "苏州某某有限公司\n苏州市人民路 1 号": ("苏州某某有限公司", "苏州市人民路 1 号", True), "文达新\nwendaxin": ("文达新 wendaxin", "", True),
        "某某\n苏州某某有限公司": ("某某 苏州某某有限公司", "", True), "Delta Co., Ltd. No. 5 East Road": ("Delta Co., Ltd.", "No. 5 East Road", True), "Delta Co., Ltd. Co.,Ltd.": ("Delta Co., Ltd.", "", True),
        "Delta Works, No. 5 East": ("Delta Works", "No. 5 East", False), "Delta": ("Delta", "", True), "x" * 41: ("x" * 41, "", False), "long name " * 5: (("long name " * 5).strip(), "", True),
    }
    for (text, want), got in zip(cases.items(), each(spark, customers.split_customer, cases), strict=True):
        assert (got.name, got.address, got.sure) == want, text


def test_row_kinds(spark):
    cases = {"Attend the Dalian exhibition": "exhibition", "Attend a course": "internal", "Training": "internal", "On the way to the customer": "internal", "Institute of Technology": "", "Get to the 德尔塔 by car": "", None: ""}
    assert each(spark, customers.row_kind, cases) == list(cases.values())


def test_owners(spark):
    people = ["Anna Berg", "Anna Wolf", "Carl Stein"]
    cases = {"anna berg": "Anna Berg", "Carl": "Carl Stein", "Anna": "", "by Carl Stein": "Carl Stein", "Anna Berg, Carl Stein": "", "": "", None: ""}
    assert each(spark, lambda c: customers.owner_of(c, people), cases) == list(cases.values())
    files = {"/a/Visits_Carl_2026.xlsx": "Carl Stein", "/a/Anna_CW3.xlsx": "", "Anna-Wolf.xlsx": "Anna Wolf", "x.xlsx": ""}
    assert each(spark, lambda c: customers.owner_in_file_name(c, people), files) == list(files.values())


def test_topics_and_roles(spark):
    topics = {"Visited to Delta and lunch": "Delta", "Meeting with Delta, Co Ltd (new)": "Delta, Co Ltd", "拜访 德尔塔，合同": "德尔塔", "Lunch": "", None: ""}
    assert each(spark, customers.topic_company, topics) == list(topics.values())
    roles = {"director of Delta": "Delta", "Technical Manager Delta Technology Co., Ltd": "Delta Technology Co., Ltd", "manager Delta": "", None: ""}
    assert each(spark, customers.role_company, roles) == list(roles.values())


def test_account_numbers(spark):
    cases = {
        "13812345678 / 13912345678": (["+8613812345678", "+8613912345678"], []), "010-82241866/65": (["+861082241866"], ["010-82241866/65"]), "0512-62391111-806": (["+8651262391111"], ["0512-62391111-806"]),
        "400-123-4567": (["+864001234567"], []), "62391111": ([], ["62391111"]), "13812345678 Li": (["+8613812345678"], ["13812345678 Li"]), "call later": ([], ["call later"]), None: ([], []),
    }
    for (text, want), got in zip(cases.items(), each(spark, customers.account_numbers, cases), strict=True):
        assert (got.numbers, got.texts) == want, text


def test_todo_words(spark):
    cases = {"未完成": "open", "已完成了": "done", "Pending": "open", "待处理": "open", "wip": "wip", "On hold": "waiting", "blocked": "waiting", "planned": "open", "erledigt": "done", "offen": "open", "Abgebrochen": "cancelled", "done by Li": "done"}
    got = each(spark, status.todo_state, cases)
    assert [r.state for r in got] == list(cases.values()) and all(r.known for r in got)


@pytest.mark.parametrize(("day", "monday", "want"), [("2024-01-27", "2026-02-23", "2026-02-27"), ("2024-01-01", "2026-02-23", "2026-03-01"), ("2026-02-24", "2026-02-23", "2026-02-24"), ("2024-01-15", "2026-02-23", "2024-01-15")])
def test_mistyped_month(spark, day, monday, want):
    row = spark.range(1).select(F.lit(day).cast("date").alias("d"), F.lit(monday).cast("date").alias("m"))
    assert str(row.select(dates.mistyped_month(F.col("d"), F.col("m"))).first()[0]) == want


def test_same_value(spark):
    cases = [
        ("place", "江苏 Jiangsu", "Jiangsu", True), ("place", "广东省", "江苏省", False), ("place", "苏州", "Suzhou", True), ("person", "Wang Yao", "Yao Wang", True), ("person", "Richard", "Richard Yu", True),
        ("person", "Richard", None, False), ("order", "2021", "2021-05", True), ("product", "Motion", "Rotomotion", True), ("text", "A-b", "a b", True), ("text", "a", "b", False),
    ]
    for kind, a, b, want in cases:
        assert spark.range(1).select(accounts.same_value(kind, F.lit(a), F.lit(b))).first()[0] is want, (kind, a, b)


def test_people_of_an_account(spark):
    rows = [("A", 1, "Li Wei", "010-82241866/65", None, "li@a.com"), ("A", 2, "li wei", None, "13812345678", "LI@a.com, ask"), ("A", 3, None, "62391111", None, None), ("B", 1, "Li Wei", "x@b.com", None, None)]
    table = spark.createDataFrame(rows, "acc string, row int, name string, phone string, mobile string, email string")
    got = {(r.acc, r.person): r for r in accounts.people(table, "acc", "row", "name", "phone", "mobile", "email").collect()}
    one = got["A", "liwei"]
    assert (one.name, one.phone, one.phones, one.emails) == ("Li Wei", "010-82241866/65 / 13812345678", ["+861082241866", "+8613812345678"], ["li@a.com"])
    assert got["A", None].other == ["phone 62391111"] and got["B", "liwei"].emails == ["x@b.com"]


def test_counters_of_quoted_mail(spark):
    quoted = "array<struct<sender:string,keys:array<string>,domains:int>>"
    names = "outbound own automated keys domains filed_key filed topic supplier product inquiry deal bill our_po order_ref service price quoted".split()
    base = dict.fromkeys(names) | {"keys": ["x"], "domains": 1, "quoted": []}
    rows = [base | {"inquiry": True, "quoted": [("q", ["c"], 2), ("far", ["d"], 5)]}, base | {"outbound": True, "own": True, "deal": True, "filed": True, "filed_key": "x"}, base | {"domains": 9}]
    kinds = {"keys": "array<string>", "domains": "int", "filed_key": "string", "topic": "string", "quoted": quoted}
    table = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {kinds.get(n, 'boolean')}" for n in names))
    got = {r.key: r for r in mail.all_counters(table).collect()}
    assert set(got) == {"x", "q", "c", "far"}
    assert (got["x"].mass, got["x"]["in"], got["x"].in_inquiry, got["x"].out_business, got["x"].filed, got["x"].deal) == (1, 1, 1, 1, 1, 1)
    assert (got["q"].quoted, got["q"].quoted_inquiry, got["c"].quoted, got["c"].quoted_inquiry, got["far"].quoted) == (1, 1, 1, 0, 1)


def test_reset_running_matches_a_loop(spark):
    rows = [(g, k, (k * 37 + g * 11) % 900) for g in range(3) for k in range(40)] + [(None, 1, 5)]
    got = {(r.g, r.k): r.part for r in lookups.reset_running(spark.createDataFrame(rows, "g int, k int, n int"), "g", "k", "n", 2000).collect()}
    want = {}
    for g in (0, 1, 2, None):
        part = filled = 0
        for _, k, n in sorted(r for r in rows if r[0] == g):
            part, filled = (part + 1, n) if filled and filled + n > 2000 else (part, filled + n)
            want[g, k] = part
    assert got == want
