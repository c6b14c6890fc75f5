"""Filled regions of sheets, layouts by their labels, records and review of customer lists."""

import random

import pytest

from recordloom.operators import account_sheets, lookups

CELLS = "file string, sheet string, row int, col int, text string"


def flood(cells):
    """Regions by flood fill, what lies in another's box added to it."""
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            part.add((r, c))
            for x in [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if x in left:
                    left.remove(x)
                    todo.append(x)
        out.append(part)
    box = lambda p: (min(r for r, _ in p), max(r for r, _ in p), min(c for _, c in p), max(c for _, c in p))
    boxes = [box(p) for p in out]
    inside = lambda a, b: a != b and b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] and a[3] <= b[3]
    found = {}
    for part, b in zip(out, boxes, strict=True):
        around = [o for o in boxes if inside(b, o)]
        home = max(around, key=lambda o: ((o[1] - o[0] + 1) * (o[3] - o[2] + 1), -o[0], -o[2])) if around else b
        found |= {x: f"{home[0]}:{home[2]}" for x in part}
    return found


@pytest.mark.parametrize("seed", range(3))
def test_regions_agree_with_flood_fill(spark, seed):
    rng = random.Random(seed)
    sheets = {f"s{k}": {(r, c) for r in range(1, 14) for c in range(1, 14) if rng.random() < (0.15, 0.3, 0.5)[seed]} for k in range(4)}
    rows = [("f", s, r, c, "x") for s, cells in sheets.items() for r, c in cells] + [("f", "s0", 30, 1, " "), ("f", "s0", 31, 1, None)]
    got = {(r.sheet, r.row, r.col): r.block for r in account_sheets.regions(spark.createDataFrame(rows, CELLS)).collect()}
    assert got == {(s, r, c): home for s, cells in sheets.items() for (r, c), home in flood(cells).items()}


def sheet(file, name, lines, top=1, left=1):
    return [(file, name, top + r, left + c, x) for r, line in enumerate(lines) for c, x in enumerate(line) if x is not None]


def test_layouts_and_review(spark):
    cells = (
        sheet("a", "erp", [["客户编码", "客户名称", "助记码", "所属行业"], ["00CR991038", "甲公司", "Alpha Tools.", "机械行业"], [None, "乙公司", None, "x"], ["CR991039", None, None, "x"], ["CR991040", "丁公司", None, "DO NOT USE"]], 2)
        + sheet("a", "list", [["客户 Customer", "Company English", "Existing customer", "Active status"], ["丙", "Gamma", "Y", "n"], ["戊", "Delta", "maybe", "Pls Ann fill in"], ["己", "Eps", "N", "soon"]])
        + sheet("a", "list", [["Customer name", "Location", "Application"], ["Zeta", "江苏省Wuxi", "milling"]], 1, 8)
        + sheet("b", "odd", [[str(k) for k in range(6)] for _ in range(3)])
        + sheet("b", "fair", [["竞品 Competitors"], ["厂家名称", "English name", "已建立联系"], ["辛", "Theta", None]])
        + sheet("b", "none", [["厂家名称", "English name", "电话"], ["辛", "Theta", "1"]])
        + sheet("b", "small", [["hello"]])
    )
    got = account_sheets.read(spark.createDataFrame(cells, CELLS))
    rows = {(r.file, r.sheet, r.row, r.layout): r for r in got.records.collect()}
    assert set(rows) == {("a", "erp", 3, "erp"), ("a", "erp", 6, "erp"), ("a", "list", 2, "supporting"), ("a", "list", 3, "supporting"), ("a", "list", 4, "supporting"), ("a", "list", 2, "registration"), ("b", "fair", 3, "competitors")}
    assert rows["a", "erp", 3, "erp"].code == "CR991038" and rows["a", "erp", 3, "erp"].en == "Alpha Tools." and rows["a", "erp", 6, "erp"].notes == ["marked: do not use"]
    assert [rows["a", "list", k, "supporting"].existing for k in (2, 3, 4)] == [True, None, False] and rows["a", "list", 4, "supporting"].notes == ["order placed: soon"]
    lead = rows["a", "list", 2, "registration"]
    assert (lead.kind, lead.en, lead.cn, lead.city, lead.application) == ("lead", "Zeta", None, "江苏省 Wuxi", "milling")
    assert rows["b", "fair", 3, "competitors"].kind == "competitor" and rows["b", "fair", 3, "competitors"].notes == ["Competitors. 已建立联系"]
    assert {(r.file, r.sheet, r.row, r.field, r.value, r.reason) for r in got.review.collect()} == {
        ("a", "erp", 4, "code", None, "no_code"), ("a", "erp", 5, "cn", "CR991039", "no_name"), ("a", "erp", 6, "industry", "丁公司", "do_not_use"), ("a", "list", 3, "active", "Pls Ann fill in", "instruction_not_data"),
        ("b", "odd", 1, None, None, "unrecognised"), ("b", "none", 1, "section", None, "unrecognised_section"),
    }
    kinds = {r.file: (r.kind, r.layouts) for r in account_sheets.file_kinds(spark.createDataFrame(cells + [("c", "s", 1, 1, "x")], CELLS)).collect()}
    assert kinds == {"a": ("accounts", "erp, registration, supporting"), "b": ("accounts", "sections"), "c": ("unrecognised", "")} or kinds["c"] == ("unrecognised", None)
    split = account_sheets.leads_and_accounts(got.records, spark.createDataFrame([("Nobody",)], "name string"))
    assert {r.key: r.what for r in split.collect()}["name:zeta"] == "lead"
    split = account_sheets.leads_and_accounts(got.records, spark.createDataFrame([("zeta",)], "name string"))
    assert {r.key: r.what for r in split.collect()}["name:zeta"] == "account"


def test_no_cells(spark):
    got = account_sheets.read(spark.createDataFrame([], CELLS))
    assert got.records.count() == 0 and got.review.count() == 0


def test_roots_with_long_chains_and_cycles(spark):
    rows = [(k, k - 1 if k else None) for k in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1000), (2000, 2000), (2001, 9999)]
    got = {r.k: (r.root, r.depth) for r in lookups.roots(spark.createDataFrame(rows, "k long, up long"), "k", "up").collect()}
    assert got == {k: (0, k) for k in range(300)} | {k: (k, 0) for k in (1000, 1001, 1002, 1003, 2000, 2001)}
