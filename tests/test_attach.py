"""Attaching records and checking what facts rest on."""

import datetime as dt

from pyspark.sql import functions as F

from recordloom.operators import attach, evidence


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_by_label_and_domain(spark):
    parties = spark.createDataFrame([("Suzhou Delta-Works Co.,Ltd",), ("Iota GmbH",), (None,)], "party string")
    labels = spark.createDataFrame([("deltaworks",), ("iota",), ("io",), ("gmbhx",)], "label string")
    assert pairs(attach.by_label(parties, "party", labels, "label")) == {("Suzhou Delta-Works Co.,Ltd", "deltaworks"), ("Iota GmbH", "iota")}
    rows = spark.createDataFrame([(1, "mail.eu.delta.com"), (2, "notdelta.com"), (3, None)], "k int, domain string")
    known = spark.createDataFrame([("delta.com",), ("eu.delta.com",)], "d string")
    assert pairs(attach.by_domain(rows, "k", "domain", known, "d")) == {(1, "eu.delta.com")}


def test_prioritised_leaves_ambiguous_names_out(spark):
    rows = spark.createDataFrame([(1, "A", "x"), (2, None, "y"), (3, "Z", "z")], "k int, code string, name string")
    table = spark.createDataFrame([("A", "q", 10), ("B", "y", 20), ("C", "z", 30), ("D", "z", 31)], "c string, n string, target int")
    assert pairs(attach.prioritised(rows, "k", [("code", table, "c"), ("name", table, "n")], "target")) == {(1, 10, 0), (2, 20, 1), (3, None, None)}


def test_by_mobile_ignores_switchboards(spark):
    held = spark.createDataFrame([("C", "a", ["+8613800000001", "+861062345678"]), ("C", "b", ["+8613800000002"])], "company string, contact string, phones array<string>")
    wanted = spark.createDataFrame([("C", "p", ["+861062345678"]), ("C", "q", ["+8613800000002"]), ("D", "r", ["+8613800000002"])], "company string, person string, phones array<string>")
    assert pairs(attach.by_mobile(wanted, held, "company", "person", "phones", "contact")) == {("C", "q", "b")}


def test_real_addresses(spark):
    seen = spark.createDataFrame([("Wei Zhang", "w.zhang@delta.com"), ("Zhang Wei", "W.Zhang@delta.com"), ("zhang, wei", "imceaex-_o=x@delta.com"), ("Nobody", "imceaex-y@delta.com")], "name string, email string")
    got = {(r.email, r.resolved) for r in attach.real_addresses(seen, "name", "email").collect()}
    assert ("imceaex-_o=x@delta.com", "w.zhang@delta.com") in got and ("imceaex-y@delta.com", None) in got


def test_company_in_text(spark):
    names = spark.createDataFrame([("Delta Works Ltd", "K1"), ("Iota Tools", "K2"), ("苏州德尔塔有限公司", "K3")], "name string, code string")
    rows = spark.createDataFrame([(1, "call Delta Works on friday"), (2, "Delta Works and Iota Tools meet"), (3, "no name here"), (4, None), (5, "拜访苏州德尔塔有限公司")], "k int, text string")
    got = {r.k: (r.code, r.state) for r in attach.company_in_text(rows, "k", "text", names, "name", "code").collect()}
    assert got == {1: ("K1", "unique"), 2: (None, "ambiguous"), 3: (None, "none"), 4: (None, "none"), 5: ("K3", "unique")}


def test_short_names(spark):
    rows = spark.createDataFrame(
        [(1, "Heng Intelligent Equipment", "Suzhou", "Li"), (2, "Heng Intelligent Tools", "Wuxi", "Wu"), (3, "Heng Int.", "Suzhou", None), (4, "HENG", "Wuxi", "Xu"), (5, "Heng Co.", None, "Wu"),
         (6, "Heng", "Beijing", None), (7, "Heng", None, None), (8, "Solo", None, None), (9, "恒瑞自动化", None, None), (10, None, None, None)],
        "k int, name string, city string, person string",
    )
    got = {r.k: (r.company, r.why) for r in attach.short_names(rows, "k", "name", "city", "person").collect()}
    assert got[1] == ("heng:intelligent:equipment", "written out") and got[3] == ("heng:intelligent:equipment", "same city") and got[4][0] == "heng:intelligent:tools"
    assert got[5] == ("heng:intelligent:tools", "same contact") and got[6] == ("heng@beijing", "separate: none in this city") and got[7][1] == "separate: ambiguous"
    assert got[8][1] == "no full name starts this way" and got[9] == ("恒瑞自动化", "written out") and len(got) == 10


def test_run_together_and_search(spark):
    people = spark.createDataFrame([("C", "Wei Zhang"), ("C", "zhangwei"), ("D", "zhangwei")], "company string, name string")
    assert pairs(attach.run_together(people, "company", "name")) == {("C", "zhangwei", "Wei Zhang")}
    companies = spark.createDataFrame([("7", "Delta Works Ltd"), ("8", "Dalta Works"), ("9", "Iota")], "code string, name string")
    got = [r.code for r in attach.search(companies, "delta works", "code", "name").collect()]
    assert got == ["7", "8"] and [r.code for r in attach.search(companies, "09", "code", "name").collect()] == ["9"]


def test_quotes_checked(spark):
    messages = spark.createDataFrame([("m1", "We  ship\nON Friday."), ("m2", None)], "mid string, body string")
    facts = spark.createDataFrame([(1, "m1", "ship on friday"), (2, "m1", "on Monday"), (3, "m9", "x"), (4, "m1", " "), (5, "m2", "x"), (6, "m1", "y" * 401)], "f int, mid string, q string")
    got = {r.f: r.problem for r in evidence.quotes_checked(facts, messages, "mid", "q", "body").collect()}
    assert got == {1: None, 2: "quote not found", 3: "no such message", 4: "empty quote", 5: "quote not found", 6: "over-long quote"}


def test_weeks_questions_and_deals(spark):
    days = spark.createDataFrame([("Li", dt.date(2027, 1, 1), "visit Delta"), ("Li", dt.date(2026, 12, 31), "Delta"), ("Li", dt.date(2026, 12, 31), "Iota"), ("Li", None, "lost")], "owner string, day date, plan string")
    (w,) = evidence.weeks(days, "owner", "day", "plan").collect()
    assert (w.year, w.week, w.days, w.plan) == (2026, 53, [dt.date(2026, 12, 31), dt.date(2027, 1, 1)], "Delta\nIota\nvisit Delta")
    names = spark.createDataFrame([("d", "Delta"), ("d", "DELTA"), ("i", "Iota")], "k string, name string")
    cands = spark.createDataFrame([("d", f"c{n}", float(n)) for n in range(5)], "k string, candidate string, score double")
    got = {r.k: (r.rows, r.candidates) for r in evidence.questions(names, "k", "name", cands, "score").collect()}
    assert got == {"d": (2, ["c4", "c3", "c2"]), "i": (1, [])}
    docs = spark.createDataFrame([("D1", 2, 50, dt.date(2026, 3, 1), "s2", "m2"), ("D1", 1, None, None, "s1", "m1"), ("D1", 3, 60, None, "s2", "m3")], "deal string, at int, total int, delivery date, sha256 string, message_id string")
    (d,) = evidence.deals(docs, "deal", "at").collect()
    assert (d.total, d.delivery, d.documents, d.messages) == (50, dt.date(2026, 3, 1), ["s1", "s2"], ["m1", "m2", "m3"])


def test_small_ones(spark):
    tasks = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "k int, at int")
    quotes = spark.createDataFrame([(1, 11), (2, 10)], "k int, at int")
    assert pairs(evidence.done_later(tasks, quotes, "k", "at").select("k", "done")) == {(1, True), (2, False), (3, False)}
    answers = spark.createDataFrame([("b", "a")], "k string, same_as string")
    assert pairs(evidence.same_as(spark.createDataFrame([("b", 1), ("c", 2)], "k string, v int"), "k", answers).select("k", "v")) == {("a", 1), ("c", 2)}
    text = spark.createDataFrame([("ORDER CONFIRMATION\nNo: OC1\nTotal: 5,00",), ("else",)], "t string")
    kinds = {"confirmation": ("ORDER CONFIRMATION", {"number": r"No:\s*(\S+)", "buyer": r"Buyer:\s*(\S+)"}), "invoice": ("INVOICE", {"number": r"No:\s*(\S+)"})}
    got = text.select(evidence.document_fields(F.col("t"), kinds).alias("d")).select("d.*").collect()
    assert [(r.kind, r.fields) for r in got] == [("confirmation", {"number": "OC1", "buyer": None}), (None, None)]
    rows = spark.range(100).withColumn("s", F.col("id") % 3)
    assert evidence.stratified(rows, ["s"], "id", 4).count() == 12
    assert pairs(evidence.failed_checks(rows, {"small": F.col("id") < 90, "any": F.lit(True)})) == {("small", 10), ("any", 0)}
    assert pairs(evidence.provenance(spark.createDataFrame([("k", "q1", 1), ("k", "q2", 2), ("k", "q3", 3), ("k", "q4", 4)], "k string, q string, o int"), "k", "q", "o")) == {("k", "“q1”\n“q2”\n“q3”")}
