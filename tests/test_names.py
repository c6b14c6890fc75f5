"""Names in two languages, people's names, and texts put together."""

from pyspark.sql import functions as F

from recordloom.functions import names
from recordloom.operators import evidence

CELLS = [
    ("苏州德尔塔有限公司(Delta Suzhou Co., Ltd.)\nAddr:苏州市工业园区1号", ("苏州德尔塔有限公司", "Delta Suzhou Co., Ltd.", "苏州市工业园区1号")),
    ("德尔塔机械\n地址：重庆市2号", ("德尔塔机械", None, "重庆市2号")),
    ("德尔塔有限公司\n(Delta Tools Co., Ltd.)\nAddress: 3 Long Road", ("德尔塔有限公司", "Delta Tools Co., Ltd.", "3 Long Road")),
    ("德尔塔有限公司\nDelta Tools GmbH", ("德尔塔有限公司", "Delta Tools GmbH", None)),
    ("德尔塔有限公司 DELTA TOOLS", ("德尔塔有限公司", "DELTA TOOLS", None)),
    ("Delta Tools Co., Ltd.德尔塔", ("Delta Tools Co., Ltd.", "德尔塔", None)),
    ("Delta Tools Co., Ltd.\n德尔塔工具", ("Delta Tools Co., Ltd.", "德尔塔工具", None)),
    ("Delta Tools", None), ("德尔塔", None), ("德尔塔\nCR00123", None), ("", None), (None, None),
]


def test_bilingual_cells(spark):
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CELLS)], "k int, t string")
    got = {r.k: r.n and tuple(r.n) for r in rows.select("k", names.bilingual_cell(F.col("t")).alias("n")).collect()}
    assert got == {k: want for k, (_, want) in enumerate(CELLS)}


def test_person_names(spark):
    table = [("Zhang, Wei (Sales)", "x@d.com", "Wei Zhang"), ("'Li Na'", "x@d.com", "Li Na"), (None, "anna.berg@d.com", "Anna Berg"), ("anna@d.com", "cn.sales@d.com", None), ("", "info@d.com", None), ("张伟", "z@d.com", "张伟"), (None, None, None)]
    rows = spark.createDataFrame(table, "n string, a string, want string")
    assert [r.got for r in rows.select(names.person_name(F.col("n"), F.col("a")).alias("got")).collect()] == [w for _, _, w in table]


def test_bodies_and_case_texts(spark):
    rows = spark.createDataFrame([("c", 2, "M2", None, 5), ("c", 1, "M1", "hello", None)], "case string, at int, alias string, top string, n int")
    assert [r.b for r in rows.orderBy("at").select(evidence.body(F.col("alias"), first_words=F.col("top"), count=F.col("n")).alias("b")).collect()] == ["M1\nfirst words: hello", "M2\ncount: 5"]
    (r,) = evidence.case_texts(rows, "case", "at", "alias", "top").collect()
    assert r.text == "## M1\nhello\n\n## M2\n(no new text)"
