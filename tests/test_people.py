"""Surnames by longest prefix, and names out of headers and signatures."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators import people

WRITTEN = [
    ("Mr. Zhangwei", "zhang", "wei", "zhang", True, "run together"), ("Huang Li", None, None, "huang", True, "two surnames"), ("linna", "lin", "na", "lin", True, "run together"), ("LI", "li", None, "li", False, "alone"),
    ("Wei Wang", "wang", "wei", "weiwang", True, "last"), ("Wang, Xiao Ming", "wang", "xiao ming", "wang", True, "first"), ("Li Li", "li", "li", "li", True, "first"), ("Berg", None, None, "berg", False, "unknown surname"),
    ("Anna Berg", None, None, "annaberg", True, "unknown surname"), ("Mr.", None, None, "", False, "no name"), (None, None, None, "", False, "no name"), ("", None, None, "", False, "no name"), ("Ma Co., Ltd.", "ma", None, "ma", False, "alone"),
    ("mrszhang", None, None, "mrszhang", False, "unknown surname"), ("Chen" + "x" * 3000, "chen", "x" * 3000, "chen", True, "run together"),
]


def known(spark, values=people.LATIN_SURNAMES):
    return spark.createDataFrame([(v,) for v in values], "surname string")


def test_surnames(spark):
    rows = spark.createDataFrame([(k, w[0], "clash") for k, w in enumerate(WRITTEN)] * 2, "k int, name string, given_ string")
    got = people.surnames(rows, "name", known(spark), "surname").collect()
    assert len(got) == 2 * len(WRITTEN)
    assert {r.k: (r.surname, r.given, r.surname_key, r.spelled_out, r.verdict) for r in got} == {k: w[1:] for k, w in enumerate(WRITTEN)}
    assert {r.verdict for r in people.surnames(rows, "name", known(spark, []), "surname").collect()} == {"unknown surname", "no name"}
    assert people.surnames(rows.limit(0), "name", known(spark), "surname").count() == 0


def test_longest_prefix_agrees_with_brute_force(spark):
    texts = [a + b for a in ("", "li", "lin", "欧", "欧阳", "x") for b in ("", "a", "阳", "na")] + [None]
    values = ["li", "lin", "欧", "欧阳", "lina", "zz", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.p for r in people.longest_prefix(rows, "t", spark.createDataFrame([(v,) for v in values], "p string"), "p").collect()}
    want = {t: max((v for v in values if v and t.startswith(v)), key=len, default=None) for t in texts if t}
    assert got == {t: v for t, v in want.items() if v}


HEADERS = [
    ("Rao, Raj", "r@x.com", "Raj Rao", None), ("陈小明/Xiaoming Chen", "c@x.com", "Xiaoming Chen", "陈小明"), ("Xiaoli Wang (王小丽)", "w@x.com", "Xiaoli Wang", "王小丽"), ("Wang Zonghao 王宗浩", "z@x.com", "Wang Zonghao", "王宗浩"),
    ("Wang Zonghao 某宗浩", "z@x.com", None, None), ("jane.doe", "jane.doe@x.com", None, None), ("王小姐", "w@x.com", None, None), ("欧阳娜", "o@x.com", None, "欧阳娜"), ("Sales Team", "s@x.com", None, None),
    ("WANG Ming (AB/CD EF)", "m@x.com", "WANG Ming", None), ("jane doe", "j@x.com", "Jane Doe", None), ("'Li Na'", "l@x.com", "Li Na", None), ("王", "l@x.com", None, None), ("x y z 12", "l@x.com", None, None), ("", "l@x.com", None, None), (None, "l@x.com", None, None),
]
HAN = ["王", "陈", "欧", "欧阳", "李", "赵"]


def test_header_names(spark):
    rows = spark.createDataFrame([(k, d, a) for k, (d, a, *_) in enumerate(HEADERS)], "k int, d string, a string")
    got = people.settled(rows.withColumn("s", people.header_shapes(F.col("d"), F.lit("")).alias("s")), "s", ["k"], known(spark, HAN), "surname")
    assert {r.k: (r.latin, r.han) for r in got.collect()} == {k: tuple(h[2:]) for k, h in enumerate(HEADERS) if h[2] or h[3]}


@pytest.mark.parametrize(("text", "latin", "han"), [
    ("Hello\nBest regards,\nMary 王芳\nTel", "Mary", "王芳"), ("x\nthanks\nPaul Zhao/赵波 (GM)", "Paul Zhao", "赵波"), ("x\nRegards\nMary\n王芳", "Mary", "王芳"), ("Regards\nNGUYEN VAN AN", "NGUYEN VAN AN", None),
    ("Regards\nYTP\nMary Wang", None, None), ("Regards\nAcme Sales Team", None, None), ("谢谢\n李明", None, "李明"), ("", None, None), (None, None, None), ("Regards", None, None), ("Regards\nDear Mary", None, None),
])
def test_signatures(spark, text, latin, han):
    rows = spark.createDataFrame([(1, text)], "k int, t string").withColumn("s", people.signature_shapes(F.col("t")))
    got = people.settled(rows, "s", ["k"], known(spark, HAN), "surname").collect()
    assert [(r.latin, r.han) for r in got] == ([(latin, han)] if latin or han else [])


def test_names_of_senders(spark):
    mail = [
        ("a@x.com", "An Nguyen", "hi\nRegards\nNGUYEN VAN AN"), ("a@x.com", "An Nguyen", None),
        ("b@x.com", "Jane Doe", None), ("b@x.com", "Doe Jane", None),
        ("c@x.com", None, "Regards\nMary"), ("c@x.com", "c", "Regards\nMary"),
        ("sales@x.com", None, "Regards\nMary"), ("sales@x.com", None, "Regards\nMary"),
        ("d@x.com", None, "Regards\nMary"), ("jane.doe@x.com", "jane.doe@x.com", None), ("cn.sales@x.com", None, None),
        ("e@x.com", None, "Regards\nOur Colleague"), ("f@x.com", "王芳", "x"), (None, "Nobody Here", "x"), ("g@x.com", None, "Regards\nPaul Zhao 赵波"),
    ]
    rows = spark.createDataFrame([(k, *m, "x") for k, m in enumerate(mail)], "k int, sender string, shown string, body string, name string")
    got = people.names_of_senders(rows, "k", "sender", "shown", "body", "k", known(spark, HAN), colleagues=spark.createDataFrame([("Colleague Our",)], "who string"))
    assert {r.address: (r.name, r.native, r.source, r.review) for r in got.collect()} == {
        "a@x.com": ("NGUYEN VAN AN", None, "signature", None), "b@x.com": ("Jane Doe", None, "header", "header names tie"), "c@x.com": ("Mary", None, "signature", None),
        "sales@x.com": ("sales@x.com", None, "mailbox", "no name"), "d@x.com": ("d@x.com", None, "mailbox", "no name"), "jane.doe@x.com": ("Jane Doe", None, "address", None),
        "cn.sales@x.com": ("cn.sales@x.com", None, "mailbox", "no name"), "e@x.com": ("e@x.com", None, "mailbox", "no name"), "f@x.com": ("王芳", None, "header", None), "g@x.com": ("Paul Zhao", "赵波", "signature", None),
    }
    assert people.names_of_senders(rows.limit(0), "k", "sender", "shown", "body", "k", known(spark, HAN)).count() == 0
