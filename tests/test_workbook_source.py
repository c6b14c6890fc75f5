"""The workbook data source: partitions, conditions, long sheets, merged areas, faults; and workbooks written and read back."""

import io
import tracemalloc
import zipfile

import pytest

from recordloom.sources import sinks, workbook
from test_sources import NS

REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(path, sheets, merges=""):
    """A workbook of sheets given as the XML of their rows."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="{n}" r:id="r{k}"/>' for k, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets)))}</Relationships>")
        for k, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData>{merges}</worksheet>")


def row(n, *values):
    return f'<row r="{n}">{"".join(f"<c><v>{v}</v></c>" for v in values)}</row>'


def merged(*refs):
    return f"<mergeCells>{''.join(f'<mergeCell ref="{r}"/>' for r in refs)}</mergeCells>"


@pytest.fixture
def load(spark):
    workbook.register(spark)
    return lambda path, **options: spark.read.format("workbook").options(**options).load(str(path))


def test_long_and_wide_sheets_are_whole(load, tmp_path):
    book(tmp_path / "long.xlsx", {"a": "".join(row(n, n) for n in range(1, 25_001)) + '<row r="30000"><c r="XFD30000"><v>1</v></c></row>'})
    got = load(tmp_path)
    assert got.where("error is null").count() == 25_001
    assert got.where("row = 30000").first().col == 16_384


def test_partitions(load, tmp_path):
    for k in range(3):
        book(tmp_path / f"{k}.xlsx", {"a": row(1, 1), "b": row(1, 2)})
    (tmp_path / "~$0.xlsx").write_bytes(b"lock")
    (tmp_path / "note.txt").write_bytes(b"no book")
    assert load(tmp_path, splitBytes=1).rdd.getNumPartitions() == 6
    assert load(tmp_path).rdd.getNumPartitions() == 1
    assert load(tmp_path, partitionBytes=1).rdd.getNumPartitions() == 3
    assert load(tmp_path / "1.xlsx", splitBytes=1).count() == 2
    whole = sorted(map(str, load(tmp_path).collect()))
    assert whole == sorted(map(str, load(tmp_path, splitBytes=1).collect())) and len(whole) == 6


def test_conditions_reach_the_reader(load, tmp_path):
    """A sheet with broken XML far down has no error for those who read its head, nor for those who read the other sheet."""
    book(tmp_path / "a.xlsx", {"broken": row(1, 1, 2) + row(2, 3, 4) + row(3, 5) * 9_000 + "<row", "good": row(1, 7)})
    both = load(tmp_path, splitBytes=1)
    assert [r.error.split(":")[0] for r in both.where("error is not null").collect()] == ["ParseError"]
    assert [(r.sheet, r.row, r.col, r.number) for r in both.where("sheet = 'broken' and row <= 2 and col = 2").collect()] == [("broken", 1, 2, 2.0), ("broken", 2, 2, 4.0)]
    assert both.where("sheet in ('good', 'gone')").rdd.getNumPartitions() == 1
    assert [r.number for r in both.where("sheet = 'good'").collect()] == [7.0]
    assert both.where("row > 2 and row < 3").count() == 0
    assert both.where("sheet = 'gone'").count() == 0


def test_columns_asked_for(spark, load, tmp_path):
    book(tmp_path / "a.xlsx", {"a": row(1, 7)})
    got = spark.read.format("workbook").schema("number double, sheet string").load(str(tmp_path))
    assert [tuple(r) for r in got.collect()] == [(7.0, "a")]


def test_faults_are_rows(load, tmp_path):
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    (tmp_path / "empty.xlsx").write_bytes(b"")
    book(tmp_path / "good.xlsx", {"a": row(1, 7), "string": '<row r="1"><c t="s"><v>5</v></c></row>', "b": row(1, 8)})
    for split in (1, 1 << 20):
        got = load(tmp_path, splitBytes=split).collect()
        assert sorted((r.file.rsplit("/", 1)[-1], r.sheet, r.error.split(":")[0]) for r in got if r.error) == [
            ("bad.xlsx", None, "BadZipFile"), ("empty.xlsx", None, "BadZipFile"), ("good.xlsx", "string", "IndexError")
        ]
        assert sorted(r.number for r in got if not r.error) == [7.0, 8.0]


def test_empty_folder(load, tmp_path):
    assert load(tmp_path).count() == 0


def tops(rows, *refs):
    out = io.BytesIO()
    book(out, {"a": rows}, merged(*refs))
    return {(r[3], r[4]): (r[8], r[9]) for r in workbook.cells_of("f", out) if r[8]}


def test_merged_areas():
    assert tops(row(2, 5), "A1:B3") == {(r, c): (1, 1) for r in (1, 2, 3) for c in (1, 2)}
    assert tops("", "B2:B3", "D9:E9") == {(2, 2): (2, 2), (3, 2): (2, 2), (9, 4): (9, 4), (9, 5): (9, 4)}
    assert tops(row(1, 1) + row(5, 1, 2, 3), "A2:A4", "C4:C6", "B5") == {(2, 1): (2, 1), (3, 1): (2, 1), (4, 1): (2, 1), (4, 3): (4, 3), (5, 3): (4, 3), (6, 3): (4, 3), (5, 2): (5, 2)}
    # Whole columns and rows end where the sheet's cells end.
    ends = '<row r="3"><c r="A3"><v>1</v></c><c r="D3"><v>1</v></c></row>'
    assert tops(ends, "B1:B1048576") == {(r, 2): (1, 2) for r in (1, 2, 3)}
    assert tops(ends, "A2:XFD2") == {(2, c): (2, 1) for c in (1, 2, 3, 4)}


def test_memory_is_that_of_a_row():
    out = io.BytesIO()
    book(out, {"a": "".join(row(n, *range(20)) for n in range(1, 20_001))})
    tracemalloc.start()
    n = sum(1 for _ in workbook.cells_of("f", out))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400_000 and peak < 4 << 20


def test_strings():
    out = io.BytesIO()
    book(out, {"a": '<row r="1"><c t="inlineStr"><is><r><t>a_x000D_</t></r><r><t>b</t></r><rPh><t>no</t></rPh></is></c><c r="D1" t="b"><v>1</v></c><c t="e"><v>#N/A</v></c></row>'})
    assert [(r[4], r[5]) for r in workbook.cells_of("f", out)] == [(1, "a\rb"), (4, "true"), (5, "#N/A")]


def test_written_and_read_back(spark, load, tmp_path):
    odd = "a\x00 <&>\"' _x0041_ \r\n\t 客户 " + "x" * 40_000
    cells = [
        ("a.xlsx", "S & \"T\"", 1, 1, odd, None, None, None, None), ("a.xlsx", "S & \"T\"", 2, 2, "", None, None, None, None), ("a.xlsx", "S & \"T\"", 4, 28, "2026-05-18", 46160.0, None, None, None),
        ("a.xlsx", "T", 1, 1, "top", None, None, 1, 1), ("a.xlsx", "T", 1, 2, None, None, None, 1, 1), ("a.xlsx", "T", 2, 1, None, None, None, 1, 1), ("a.xlsx", "T", 2, 2, None, None, None, 1, 1),
        ("a.xlsx", "T", 3, 1, "2.5", 2.5, "=A1<3", None, None), ("b.xlsx", "T", 1, 1, "b", None, None, None, None), (None, "T", 1, 1, "nowhere", None, None, None, None),
    ]
    schema = "file string, sheet string, row int, col int, text string, number double, formula string, merge_row int, merge_col int"
    path = str(tmp_path / "out")
    for _ in range(2):  # a second run writes the same
        written = {tuple(r) for r in sinks.workbooks(spark.createDataFrame(cells, schema), path).collect()}
        assert written == {("a.xlsx", 8), ("b.xlsx", 1)}
        back = load(path).collect()
        assert not [r for r in back if r.error]
        got = sorted(((r.file.rsplit("/", 1)[-1], *[r[n] for n in schema.split()[2::2]]) for r in back), key=str)
        assert got == sorted(cells[:-1], key=str)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.xlsx", "b.xlsx"]
    assert sinks.workbooks(spark.createDataFrame([], schema), path).count() == 0
