"""Chains of saved pages: order, what breaks them, and companies of two sources."""

from recordloom.sources import paged


def chain(spark, rows):
    return spark.createDataFrame([(s, c, f, [f"{c}{k}" for k in range(2)]) for s, c, f in rows], "src string, cursor string, following string, items array<string>")


def test_chains(spark):
    rows = [("a", None, "x"), ("a", "x", "y"), ("a", "y", None), ("a", "y", None), ("a", "z", None), ("b", None, "p"), ("b", "p", "q"), ("c", "m", None), ("d", None, "u"), ("d", "u", "v"), ("d", "v", "u"), ("e", None, None)]
    rows += [("f", None if k == 0 else f"k{k}", f"k{k + 1}" if k < 200 else None) for k in range(201)]
    pages = chain(spark, rows)
    order, findings = paged.chained(pages, "cursor", "following", "src")
    got = {(r.source, r.cursor): r.nth for r in order.collect()}
    want = {("a", ""): 0, ("a", "x"): 1, ("a", "y"): 2, ("b", ""): 0, ("b", "p"): 1, ("d", ""): 0, ("d", "u"): 1, ("d", "v"): 2, ("e", ""): 0}
    assert got == want | {("f", "" if k == 0 else f"k{k}"): k for k in range(201)}
    assert {tuple(r) for r in findings.collect()} == {
        ("a", "y", "repeated"), ("a", "z", "unreached"), ("b", "q", "missing"), ("c", "m", "unreached"), ("c", None, "no first page"), ("d", "v", "loop"),
    }
    items = [tuple(r) for r in paged.records(pages.where("src = 'a'"), "cursor", "following", "items").orderBy("nth", "at").collect()]
    assert items == [("", n, at, f"{c}{at}") for n, c in enumerate(("None", "x", "y")) for at in range(2)]
    assert paged.records(pages.limit(0), "cursor", "following", "items").count() == 0


def test_companies_of_two_sources(spark):
    schema = "code string, cn string, en string, short string, rank int"
    target = spark.createDataFrame([("CR1", "Alpha", None, None, 1), ("cr1", "Alpha 2", "A", None, 2), (None, "Beta", None, None, 3)], schema)
    files = spark.createDataFrame([("00CR1", "Other", "B", "S", 1), (None, "ALPHA", "C", "T", 2), (None, "beta", "Beta Ltd", None, 3), (None, "Gamma", None, None, 4), (None, None, None, None, 5)], schema)
    got = {(r.code, r.cn, r.en, r.short, r.origin) for r in paged.companies(target, files).collect()}
    assert got == {("CR1", "Alpha", "A", "S", "target"), (None, "Beta", "Beta Ltd", None, "target"), (None, "Gamma", None, None, "files")}
