"""Results to files: small reports sorted, large tables as they lie."""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from itertools import groupby
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored


def report_csv(rows: DataFrame, path: str, order: Sequence[Column | str]) -> None:
    """A report in one sorted file; nested columns as JSON.  For results a person reads, which are small."""
    nested = {f.name: F.to_json(f.name) for f in rows.schema if f.dataType.typeName() in ("array", "map", "struct")}
    rows.withColumns(nested).orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def records_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append_missing(rows: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    """Append the rows whose key the target lacks, each key once; what was written.  A second run writes nothing."""
    spark = rows.sparkSession
    once = rows.dropDuplicates(list(key))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        held = spark.read.schema(rows.schema).parquet(path)
        once = once.join(held.select(*key), list(key), "left_anti")
    fresh = stored(once, "fresh")
    fresh.write.mode("append").parquet(path)
    return fresh


def field_plan(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """``name, action, target``: reuse a field of the same type, add a suffix where the type differs, else create."""
    both = wanted.select("name", "type").join(existing.select("name", F.col("type").alias("held_type")), "name", "left")
    action = F.when(F.col("held_type").isNull(), "create").when(F.col("held_type") == F.col("type"), "reuse").otherwise("suffix")
    return both.select("name", action.alias("action"), F.when(action == "suffix", F.concat("name", F.lit("_"), "type")).otherwise(F.col("name")).alias("target"))


_CELL = ("file", "sheet", "row", "col", "text", "number", "formula", "merge_row", "merge_col")
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_BOOK_LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"
#: What XML cannot hold, and what would be read as such a mark.
_UNFIT = re.compile("[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def _letters(col: int) -> str:
    out = ""
    while col:
        col, k = divmod(col - 1, 26)
        out = chr(65 + k) + out
    return out


def _write_book(cells: Iterator[dict], out) -> int:
    """One workbook from cells in order of sheet, row and column, written as they come; the number of cells."""
    n, titles = 0, []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for title, of_sheet in groupby(cells, lambda c: c["sheet"]):
            titles.append(title)
            areas: dict[tuple[int, int], list[int]] = {}
            with book.open(f"xl/worksheets/sheet{len(titles)}.xml", "w") as part:
                put = lambda s: part.write(s.encode())  # noqa: B023, E731
                put(f'<worksheet xmlns="{_MAIN}"><sheetData>')
                for row, of_row in groupby(of_sheet, lambda c: c["row"]):
                    put(f'<row r="{row}">')
                    for c in of_row:
                        n += 1
                        at, formula = f'r="{_letters(c["col"])}{row}"', f"<f>{escape(c['formula'].removeprefix('='))}</f>" if c["formula"] else ""
                        if c["number"] is not None:
                            dated = ' s="1"' if c["text"] and re.match(r"\d{4}-\d\d-\d\d", c["text"]) else ""
                            put(f"<c {at}{dated}>{formula}<v>{c['number']!r}</v></c>")
                        elif c["text"] is not None:
                            text = escape(_UNFIT.sub(lambda m: f"_x{ord(m[0]):04X}_", c["text"]))
                            put(f'<c {at} t="inlineStr">{formula}<is><t xml:space="preserve">{text}</t></is></c>')
                        else:
                            put(f"<c {at}>{formula}</c>")
                        if c["merge_row"] is not None:
                            end = areas.setdefault((c["merge_row"], c["merge_col"]), [row, c["col"]])
                            end[:] = max(end[0], row), max(end[1], c["col"])
                    put("</row>")
                put("</sheetData>")
                merged = "".join(f'<mergeCell ref="{_letters(c)}{r}:{_letters(d)}{q}"/>' for (r, c), (q, d) in areas.items())
                put(f"<mergeCells>{merged}</mergeCells></worksheet>" if merged else "</worksheet>")
        ids = range(1, len(titles) + 1)
        sheets = "".join(f'<sheet name={quoteattr(t)} sheetId="{k}" r:id="rId{k}"/>' for k, t in zip(ids, titles, strict=True))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in ids)
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_BOOK_LINKS}">{links}<Relationship Id="style" Type="{_LINKS}/styles" Target="styles.xml"/></Relationships>')
        fonts = "<fonts><font/></fonts><fills><fill/></fills><borders><border/></borders><cellStyleXfs><xf/></cellStyleXfs>"
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}">{fonts}<cellXfs><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{_BOOK_LINKS}"><Relationship Id="book" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_KIND}.worksheet+xml"/>' for k in ids)
        plain = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        main = f'<Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_KIND}.styles+xml"/>'
        book.writestr("[Content_Types].xml", f'<Types xmlns="{_TYPES}">{plain}{main}{parts}</Types>')
    return n


def workbooks(cells: DataFrame, path: str) -> DataFrame:
    """Write one workbook below ``path`` for each ``file`` of ``cells`` (columns as ``sources.workbook`` gives them); ``file, cells``, written once that is read.

    A workbook is written by one task as its rows come, so its size is the format's
    limit, not the task's memory.  It gets its name when it is whole, and a task
    that runs again writes the same.  A number whose text is a date is shown as one; sheets
    stand in order of their names; cells without a file or sheet have no place and are left out.
    """
    held = cells.select(*_CELL).where("file is not null and sheet is not null").repartition("file").sortWithinPartitions("file", "sheet", "row", "col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        rows = (row for batch in batches for row in batch.to_pylist())
        for file, of_file in groupby(rows, lambda r: r["file"]):
            half = f"{root}/_{file}.{uuid.uuid4().hex}"
            with store.open_output_stream(half) as out:
                n = _write_book(of_file, out)
            store.move(half, f"{root}/{file}")
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([n], pa.int64())], ["file", "cells"])

    return held.mapInArrow(run, "file string, cells long")
