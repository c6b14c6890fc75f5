"""Change plans in stages, family by family: a second run over the plan's own result plans nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.operators import staged_plans as sp

COMPANIES = "id string, name string, fields map<string,string>"
CONTACTS = "id string, company string, name string, phones array<string>, emails array<string>"
RECORDS = "id string, kind string, company string, contact string, fields map<string,string>, stamp string"
VISITS = "visit_id string, customer string, city string, potential string, person string, phone string, email string, day date, purpose string, step string, due date, cutoff date"
DAY = dt.date(2026, 5, 4)


def state(spark, companies=(), contacts=(), records=()):
    return sp.State(spark.createDataFrame(list(companies), COMPANIES), spark.createDataFrame(list(contacts), CONTACTS), spark.createDataFrame(list(records), RECORDS))


def visits(spark):
    rows = [
        ("v1", "Kestrel Ltd.", "Wuxi", "A", "Ann Berg", "+491", "ann@k.com", DAY, "talk", "send offer", DAY, DAY + dt.timedelta(5)),
        ("v2", "KESTREL LTD", None, None, "Berg Ann", "+492", None, DAY + dt.timedelta(1), "more", None, None, None),
        ("v3", "Osprey", "Suzhou", None, None, None, None, DAY, None, None, None, None),
        ("v4", "Osprey", "Suzhou", None, "Bo Li", "+495", None, DAY, None, "call", DAY + dt.timedelta(9), DAY + dt.timedelta(5)),
    ]
    return sp.visits(spark.createDataFrame(rows, VISITS))


def shown(plan):
    return {(r.kind, r.action, r.ref, r.company, r.contact, tuple(sorted((r.fields or {}).items())), tuple(r.phones), tuple(r.emails)) for r in plan.collect()}


def test_visits_against_a_target(spark):
    held = state(
        spark, [("C1", "kestrel, ltd", {"city": "Hefei"}), ("C9", "Else", {})], [("P1", "C1", "Someone", ["+492"], []), ("P2", "C9", "Bo Li", ["+495"], [])],
        [("v1", "note", "C1", "P1", {"day": "2026-05-04", "purpose": "talk"}, "2026-05-04"), ("v3", "note", None, None, {"day": "2026-05-04"}, "2027-01-01")],
    )
    plan = sp.plan(visits(spark), held)
    got = shown(plan)
    osprey = next(r[2] for r in got if r[:2] == ("company", "create"))
    bo = next(r[2] for r in got if r[:2] == ("contact", "create"))
    assert osprey.startswith("new:company:") and bo.startswith("new:contact:")
    # Ann is known by the number of her second row; both rows mean one person.
    assert got == {
        ("company", "patch", "C1", None, None, (("potential", "A"),), (), ()), ("company", "conflict", "C1", None, None, (("city", "Wuxi"),), (), ()), ("company", "create", osprey, None, None, (("city", "Suzhou"), ("name", "Osprey")), (), ()),
        ("contact", "extend", "P1", "C1", None, (), ("+491",), ("ann@k.com",)), ("contact", "create", bo, osprey, None, (("name", "Bo Li"),), ("+495",), ()),
        ("note", "same", "v1", "C1", "P1", (("day", "2026-05-04"), ("purpose", "talk")), (), ()), ("note", "create", "v2", "C1", "P1", (("day", "2026-05-05"), ("purpose", "more")), (), ()),
        ("note", "newer", "v3", osprey, None, (("day", "2026-05-04"),), (), ()), ("note", "create", "v4", osprey, bo, (("day", "2026-05-04"),), (), ()),
        ("task", "create", "v1#step", "C1", "P1", (("due", "2026-05-04"), ("state", "done"), ("text", "send offer")), (), ()), ("task", "create", "v4#step", osprey, bo, (("due", "2026-05-13"), ("state", "open"), ("text", "call")), (), ()),
    }


FAMILIES = {
    "visits": visits,
    "accounts": lambda spark: sp.accounts(spark.createDataFrame([("CR1", "甲公司", "Alpha", "Wuxi", None, None, "Ann Berg", "+491", None, ["x", "y"]), ("CR1", "甲公司", None, None, "Hefei", None, "Berg Ann", None, "a@b.c", ["x"]), (None, None, "Beta", None, None, None, None, None, None, []), (None, None, None, "z", None, None, None, None, None, [])], "code string, cn string, en string, province string, city string, industry string, contact string, phone string, email string, notes array<string>")),
    "receivables": lambda spark: sp.receivables(spark.createDataFrame([("Alpha", "CNY", 5, 1, "2026-05-01"), ("ALPHA", "CNY", 7, 2, "2026-06-01"), ("Beta", "EUR", 1, 1, "2026-06-01"), ("Gamma", "CNY", 1, 1, None)], "customer string, currency string, open_amount long, overdue long, as_of string")),
    "quotes": lambda spark: sp.quotes(spark.createDataFrame([("Q1", "Alpha", 100, "open", "2026-05-01", "nice"), ("Q2", "alpha", None, None, None, None)], "quote_no string, company string, total long, state string, quoted string, remark string")),
    "todos": lambda spark: sp.todos(spark.createDataFrame([("1", "Alpha", "old", "2026-05-01", "open", "2026-04-01"), ("1", "Alpha", "new", "2026-05-01", "done", "2026-04-02"), ("2", None, "nobody's", None, "open", None)], "todo_id string, customer string, text string, due string, state string, stamp string")),
}


@pytest.mark.parametrize("family", sorted(FAMILIES))
def test_a_second_run_plans_nothing(spark, family):
    wanted = FAMILIES[family](spark)
    first = sp.plan(wanted, state(spark)).cache()
    made = {(r.kind, r.action) for r in first.collect()}
    assert made <= {(k, "create") for k in ("company", "contact", "note", "task", "deal")} | {("task", "orphan")} and ("company", "create") in made
    after = sp.applied(first, state(spark))
    again = sp.plan(wanted, after).collect()
    assert {r.action for r in again} <= {"same", "orphan"} and len(again) == first.count()
    assert after.companies.count() == sum(r.kind == "company" for r in again)
    ids = after.companies.select(F.col("id").alias("stand_in"), F.concat(F.lit("T"), F.monotonically_increasing_id()).alias("id"))
    named = sp.with_ids(after.records, ids, ["company"])
    assert named.where("company like 'new:%'").count() == 0 and named.columns == after.records.columns


def test_newer_balances_replace(spark):
    first = FAMILIES["receivables"](spark)
    held = state(spark, [("C1", "Alpha", {"open_amount": "1", "as_of": "2025-01-01", "city": "Wuxi"})])
    plan = sp.plan(first, held)
    assert [(r.action, r.ref, r.fields) for r in plan.collect()] == [("patch", "C1", {"as_of": "2026-06-01", "open_amount": "7", "overdue": "2"})]
    (c,) = sp.applied(plan, held).companies.collect()
    assert c.fields == {"open_amount": "7", "as_of": "2026-06-01", "overdue": "2", "city": "Wuxi"}


def test_todos_without_a_company_and_nothing_read(spark):
    plan = sp.plan(FAMILIES["todos"](spark), state(spark)).collect()
    assert {(r.ref, r.action) for r in plan if r.stage == 3} == {("todo:1", "create"), ("todo:2", "orphan")}
    assert [r.fields["text"] for r in plan if r.ref == "todo:1"] == ["new"]
    empty = sp.visits(spark.createDataFrame([], VISITS))
    assert sp.plan(empty, state(spark, [("C1", "Alpha", {})])).count() == 0
    assert {(r.stage, r.kind, r.action, r.n) for r in sp.counts(sp.plan(visits(spark), state(spark))).collect()} == {(1, "company", "create", 2), (2, "contact", "create", 2), (3, "note", "create", 4), (3, "task", "create", 2)}


def test_visits_are_folded_once_and_records_of_nobody_meet_nobody(spark):
    held = state(spark, [("C1", "Kestrel", {})], [("P1", "C1", "Someone", ["+492"], [])], [("v3", "note", None, None, {"day": "2026-05-04"}, "2020-01-01")])
    plan = sp.plan(visits(spark), held)
    text = plan._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]
    assert "nfkc" not in text and "to_json" not in text
    # Records without a person are read apart from those that are joined with people.
    assert "isnull(contact_key" in text and "isnotnull(contact_key" in text
    assert {(r.ref, r.action, r.contact) for r in plan.where("stage = 3").collect() if r.contact is None} == {("v3", "update", None)}
