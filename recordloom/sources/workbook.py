"""``format("workbook")``: Excel workbooks as a long table of cells.

Sheets are streamed from the OOXML parts with the standard library (shared
strings, dates by number format, merged areas, formulas, fills), so a task holds
a workbook's shared strings and one row of cells, however long a sheet is.  A
file or sheet that cannot be read gives one row with its ``error``, never an exception.

``register`` makes the data source known: large files are one partition a sheet,
small ones share a partition, and conditions on ``file``, ``sheet``, ``row`` and
``col`` reach the reader.  ``cells`` reads through Spark's ``binaryFile`` instead, a
file at a time, for stores that only Spark can open.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from fnmatch import fnmatch
from itertools import islice

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA = "file string, sheet string, state string, row int, col int, text string, number double, formula string, merge_row int, merge_col int, fill string, error string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
KINDS = [pa.string()] * 3 + [pa.int32()] * 2 + [pa.string(), pa.float64(), pa.string()] + [pa.int32()] * 2 + [pa.string()] * 2
#: The last row and column that the format has.
LAST_ROW, LAST_COL = 1_048_576, 16_384

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Built-in number formats that show a date.
_DATE_FORMATS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 27, 28, 29, 30, 31, 36, 45, 46, 47, 50, 51, 52, 53, 54, 57, 58])


def _place(ref: str) -> tuple[int, int]:
    letters, digits = re.match(r"([A-Z]+)(\d+)", ref).groups()
    col = 0
    for c in letters:
        col = col * 26 + ord(c) - 64
    return int(digits), col


def _styles(book: zipfile.ZipFile) -> tuple[list[bool], list[str | None]]:
    """For each cell format whether it shows a date, and its fill colour."""
    if "xl/styles.xml" not in book.namelist():
        return [], []
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iterfind(".//m:numFmts/m:numFmt", _NS)}
    dated = lambda k: k in _DATE_FORMATS or bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(k, "")), re.I))
    colours = [(f.find("m:patternFill/m:fgColor", _NS)) for f in root.iterfind("m:fills/m:fill", _NS)]
    fills = [None if c is None else c.get("rgb") or (f"theme{c.get('theme')}" if c.get("theme") else None) for c in colours]
    formats = root.findall("m:cellXfs/m:xf", _NS)
    return [dated(int(x.get("numFmtId", 0))) for x in formats], [fills[k] if (k := int(x.get("fillId", 0))) < len(fills) else None for x in formats]


def _stamp(number: float) -> str:
    at = dt.datetime(1899, 12, 30) + dt.timedelta(days=number)
    return at.date().isoformat() if at.time() == dt.time() else at.isoformat(sep=" ", timespec="seconds")


_M = f"{{{_NS['m']}}}"
_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")
_MERGED = re.compile(rb"""<(?:\w+:)?mergeCell\s+ref=["']([A-Z0-9:]+)["']""")


def _text(item: ET.Element) -> str:
    """A string with its runs, without phonetic hints; ``_x000D_`` and the like are characters."""
    raw = "".join(t.text or "" for t in [*item.iterfind("m:t", _NS), *item.iterfind("m:r/m:t", _NS)])
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), raw) if "_x" in raw else raw


def _each(part, tag: str) -> Iterator[ET.Element]:
    """Elements ``tag`` of an XML stream, each forgotten once the next one is asked for."""
    parents: list[ET.Element] = []
    for event, node in ET.iterparse(part, ("start", "end")):
        if event == "start":
            parents.append(node)
            continue
        parents.pop()
        if node.tag == _M + tag:
            yield node
            if parents:
                parents[-1].clear()


class Book:
    """One workbook: its sheets, and the cells of a sheet as a stream."""

    def __init__(self, file) -> None:
        try:
            self.zip = zipfile.ZipFile(file)
        except ValueError as e:  # a file of some stores that is too short to look for the directory in
            raise zipfile.BadZipFile(str(e)) from e
        links = {r.get("Id"): r.get("Target").lstrip("/") for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        sheets = ET.fromstring(self.zip.read("xl/workbook.xml")).iterfind("m:sheets/m:sheet", _NS)
        part = lambda target: target if target.startswith("xl/") else f"xl/{target}"
        self.sheets = [(s.get("name"), s.get("state", "visible"), part(links[s.get(_REL)])) for s in sheets]
        self._strings: list[str] | None = None
        self._formats = _styles(self.zip)

    def strings(self) -> list[str]:
        if self._strings is None:
            self._strings = []
            if "xl/sharedStrings.xml" in self.zip.namelist():
                with self.zip.open("xl/sharedStrings.xml") as f:
                    self._strings = [_text(s) for s in _each(f, "si")]
        return self._strings

    def _areas(self, part: str) -> list[tuple[int, int, int, int]]:
        """Merged areas by first row; one that goes to the format's last row or column ends where the sheet's cells end."""
        refs, tail = set(), b""
        with self.zip.open(part) as f:
            # They stand behind the cells, so the stream is searched as bytes and not parsed.
            while chunk := f.read(1 << 20):
                refs.update(_MERGED.findall(tail + chunk))
                tail = (tail + chunk)[-200:]
        corners = [(ref.decode().split(":") * 2)[:2] for ref in refs]
        areas = [(*_place(a), *_place(b)) for a, b in corners]
        if any(r2 >= LAST_ROW or c2 >= LAST_COL for _, _, r2, c2 in areas):
            rows, cols = self._used(part)
            areas = [(r, c, max(r, rows) if r2 >= LAST_ROW else r2, max(c, cols) if c2 >= LAST_COL else c2) for r, c, r2, c2 in areas]
        return sorted(areas)

    def _used(self, part: str) -> tuple[int, int]:
        """The last row and the last column with a cell."""
        rows = cols = 1
        with self.zip.open(part) as f:
            for row in _each(f, "row"):
                for cell in row.iterfind("m:c[@r]", _NS):
                    r, c = _place(cell.get("r"))
                    rows, cols = max(rows, r), max(cols, c)
        return rows, cols

    def cells(self, part: str, first: int = 1, last: int = LAST_ROW) -> Iterator[tuple]:
        """``row, col, text, number, formula, merge_row, merge_col, fill`` by row from ``first`` to ``last``; reading stops there."""
        waiting, active = self._areas(part)[::-1], []
        at = 0

        def row_tops(row: int) -> dict[int, tuple[int, int]]:
            nonlocal active
            while waiting and waiting[-1][0] <= row:
                active.append(waiting.pop())
            active = [a for a in active if a[2] >= row]
            return {c: a[:2] for a in active for c in range(a[1], a[3] + 1)}

        def merged_rows(until: int) -> Iterator[tuple]:
            """Rows without cells of their own, where merged areas lie."""
            nonlocal at
            while at < until and (waiting or active):
                # Nothing is active: on to the next area.
                at = at + 1 if active else max(at + 1, waiting[-1][0])
                if at > until:
                    at = until
                    break
                for c, top in sorted(row_tops(at).items()):
                    if at >= first:
                        yield (at, c, None, None, None, *top, None)

        with self.zip.open(part) as f:
            for row in _each(f, "row"):
                n = int(row.get("r") or at + 1)
                if n > last:
                    break
                yield from merged_rows(n - 1)
                at = max(at, n)
                if n >= first:
                    yield from self._row(row, n, row_tops(n))
        yield from merged_rows(last)

    def _row(self, row: ET.Element, n: int, tops: dict[int, tuple[int, int]]) -> Iterator[tuple]:
        dated, fills = self._formats
        c, seen = 0, set()
        for cell in row.iterfind("m:c", _NS):
            c = _place(cell.get("r"))[1] if cell.get("r") else c + 1
            kind, style = cell.get("t", "n"), int(cell.get("s", 0))
            raw, formula = cell.findtext("m:v", None, _NS), cell.findtext("m:f", None, _NS)
            text = number = None
            if kind == "s" and raw is not None:
                text = self.strings()[int(raw)]
            elif kind == "inlineStr":
                text = "".join(_text(t) for t in cell.iterfind("m:is", _NS))
            elif kind == "b":
                text = "true" if raw == "1" else "false"
            elif kind in ("str", "e", "d"):
                text = raw
            elif raw is not None:
                number = float(raw)
                text = _stamp(number) if style < len(dated) and dated[style] and 0 < number < 2_958_466 else raw
            fill, top = fills[style] if style < len(fills) else None, tops.get(c)
            if text is None and formula is None and fill is None and top is None:
                continue
            seen.add(c)
            yield (n, c, text, number, f"={formula}" if formula else None, *(top or (None, None)), fill)
        for c in sorted(tops.keys() - seen):
            yield (n, c, None, None, None, *tops[c], None)


def cells_of(name: str, file, only: str | None = None, first: int = 1, last: int = LAST_ROW) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` for one open file, or for its sheet ``only``."""
    nothing = (None,) * 8
    failed = lambda e: f"{type(e).__name__}: {e}"[:300]
    try:
        book = Book(file)
    except Exception as e:  # noqa: BLE001  one bad file never stops the others
        yield (name, None, None, *nothing, failed(e))
        return
    for title, state, part in book.sheets:
        if only is None or title == only:
            try:
                for cell in book.cells(part, first, last):
                    yield (name, title, state, *cell, None)
            except Exception as e:  # noqa: BLE001  nor does one bad sheet
                yield (name, title, state, *nothing, failed(e))


def _batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Ten thousand rows at a time, with the columns asked for."""
    places = [NAMES.index(n) for n in names]
    while lot := list(islice(rows, 10_000)):
        columns = list(zip(*lot, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[k], KINDS[k]) for k in places], names)


def cells(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """All cells (``SCHEMA``) of the workbooks below ``path``; lock files are left out, equal files are read once, under their least path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    files = files.where(~F.element_at(F.split("path", "/"), -1).startswith("~$")).select("path", "content")
    once = files.withColumn("sha", F.sha2("content", 256)).groupBy("sha").agg(F.min_by(F.struct("path", "content"), "path").alias("f")).select("f.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _batches(cells_of(batch.column(0)[k].as_py(), io.BytesIO(batch.column(1)[k].as_py())), NAMES)

    return once.mapInArrow(run, SCHEMA)


class Part(ds.InputPartition):
    """Files to read whole, or one sheet of one file."""

    def __init__(self, files: list[tuple[str, str | None]]) -> None:
        super().__init__(files)
        self.files = files


class WorkbookReader(ds.DataSourceReader):
    def __init__(self, names: list[str], options: dict[str, str]) -> None:
        self.names, self.path, self.pattern = names, options["path"], options.get("pathGlobFilter", "*.xlsx")
        self.split, self.pack = int(options.get("splitBytes", 4 << 20)), int(options.get("partitionBytes", 32 << 20))
        self.first, self.last = 1, LAST_ROW
        self.kept: dict[str, set] = {}

    def pushFilters(self, filters: list[ds.Filter]) -> list[ds.Filter]:
        """Equalities choose files, sheets and columns, bounds of ``row`` where reading starts and ends; Spark applies every condition again."""
        for f in filters:
            name, value = ".".join(getattr(f, "attribute", ())), getattr(f, "value", None)
            if isinstance(f, (ds.EqualTo, ds.In)) and name in ("file", "sheet", "col"):
                values = set(value) if isinstance(f, ds.In) else {value}
                self.kept[name] = self.kept.get(name, values) & values
            elif name == "row" and value is not None:
                if isinstance(f, (ds.EqualTo, ds.LessThan, ds.LessThanOrEqual)):
                    self.last = min(self.last, value - isinstance(f, ds.LessThan))
                if isinstance(f, (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual)):
                    self.first = max(self.first, value + isinstance(f, ds.GreaterThan))
        return filters

    def _wanted(self, name: str, value) -> bool:
        return name not in self.kept or value in self.kept[name]

    def partitions(self) -> list[Part]:
        """Files of ``splitBytes`` and more by sheet, smaller ones together up to ``partitionBytes``; only the former are opened here."""
        store, root = _store(self.path)
        found = store.get_file_info(root)
        listed = [found] if found.is_file else store.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in listed if f.is_file and fnmatch(f.base_name, self.pattern) and not f.base_name.startswith("~$"))
        parts, lot, held = [], [], 0
        for path, size in (f for f in files if self._wanted("file", f[0])):
            if size >= self.split:
                parts += [Part([(path, sheet)]) for sheet in _sheets(store, path) if sheet is None or self._wanted("sheet", sheet)]
                continue
            if lot and held + size > self.pack:
                parts, lot, held = [*parts, Part(lot)], [], 0
            lot.append((path, None))
            held += size
        return [*parts, Part(lot)] if lot else parts or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        for path, sheet in partition.files:
            try:
                file = store.open_input_file(path)
            except OSError as e:
                yield from _batches(iter([(path, *(None,) * 10, f"{type(e).__name__}: {e}"[:300])]), self.names)
                continue
            with file:
                rows = cells_of(path, file, sheet, self.first, self.last)
                yield from _batches((r for r in rows if self._wanted("sheet", r[1]) and self._wanted("col", r[4])), self.names)


def _store(path: str):
    """The file system of a path or URI, as pyarrow knows it, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(path)


def _sheets(store, path: str) -> list[str | None]:
    """The sheets of a file; ``None``, the whole file, if it cannot be opened (reading it will say why)."""
    try:
        with store.open_input_file(path) as file:
            return [title for title, _, _ in Book(file).sheets]
    except Exception:  # noqa: BLE001
        return [None]


class WorkbookSource(ds.DataSource):
    """``spark.read.format("workbook").load(path)``: cells as in ``SCHEMA``, or those columns of it that a given schema names.

    Options: ``pathGlobFilter``, ``splitBytes``, ``partitionBytes``.  Paths and URIs are opened by pyarrow, on the driver and in
    the tasks.  Equal files are all read.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(schema.fieldNames(), self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("workbook")`` known to the session, with conditions handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)
