"""Workbooks and mailboxes made here, read back."""

import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from recordloom.sources import mbox, workbook
from recordloom.sources.shared import few_rows

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def make_book(path, rows, merges=(), state="visible"):
    """A minimal workbook: ``rows`` of (ref, kind, value, formula)."""
    strings = [v for _, k, v, _ in rows if k == "s"]
    cells: dict[int, list[str]] = {}
    for ref, kind, value, formula in rows:
        body = f"<f>{formula}</f>" if formula else ""
        shown = strings.index(value) if kind == "s" else value
        style = ' s="1"' if kind == "d" else ""
        cells.setdefault(int("".join(c for c in ref if c.isdigit())), []).append(f'<c r="{ref}"{style} t="{"n" if kind == "d" else kind}">{body}<v>{shown}</v></c>')
    data = "".join(f'<row r="{r}">{"".join(c)}</row>' for r, c in sorted(cells.items()))
    merged = "".join(f'<mergeCell ref="{m}"/>' for m in merges)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="CW21" state="{state}" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{''.join(f'<si><t>{s}</t></si>' for s in strings)}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><fills><fill/></fills><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{data}</sheetData><mergeCells>{merged}</mergeCells></worksheet>")


def test_workbook(spark, tmp_path):
    make_book(tmp_path / "a.xlsx", [("A1", "s", "Date", None), ("B1", "s", "Customer", None), ("A2", "d", 46160, None), ("B2", "s", "Delta", None), ("C2", "n", 2.5, "A2+1")], ["A2:A3"])
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    (tmp_path / "copy.xlsx").write_bytes((tmp_path / "a.xlsx").read_bytes())
    rows = {(r.file.rsplit("/", 1)[-1], r.row, r.col): r for r in workbook.cells(spark, str(tmp_path)).collect()}
    assert {f for f, *_ in rows} == {"a.xlsx", "bad.xlsx"}
    assert rows["a.xlsx", 2, 1].text == "2026-05-18"
    assert (rows["a.xlsx", 3, 1].merge_row, rows["a.xlsx", 3, 1].text) == (2, None)
    assert (rows["a.xlsx", 2, 3].number, rows["a.xlsx", 2, 3].formula) == (2.5, "=A2+1")
    assert rows["bad.xlsx", None, None].error.startswith("BadZipFile")


MAIL = """From - Mon May 18 10:00:00 2026
Message-ID: <{id}@x>
Date: Mon, 18 May 2026 1{n}:00:00 +0200
From: "Doe, Jane" <Jane@Delta.com>
To: a@b.com, B <b@c.org>
Subject: {subject}
{more}
{body}

"""


def test_mailbox(spark, tmp_path):
    inbox, junk = tmp_path / "Inbox", tmp_path / "Junk"
    first = MAIL.format(id="1", n=0, subject="=?utf-8?q?Angebot_=C3=84?=", more="", body="Hello")
    second = MAIL.format(id="2", n=1, subject="Re: Angebot Ä", more="In-Reply-To: <1@x>", body="Thanks")
    third = MAIL.format(id="3", n=2, subject="Re: Angebot Ä", more="", body="Later")
    inbox.write_text(first + second + third)
    junk.write_text(MAIL.format(id="4", n=3, subject="win", more="", body="x"))
    (tmp_path / "Inbox.msf").write_text("index")
    mails = mbox.messages(spark, str(tmp_path)).cache()
    got = {r.message_id: r for r in mails.collect()}
    assert set(got) == {"1@x", "2@x", "3@x"}
    assert got["1@x"].subject == "Angebot Ä"
    assert got["1@x"].sender.email == "jane@delta.com"
    assert [p.email for p in got["1@x"].recipients] == ["a@b.com", "b@c.org"]
    assert got["2@x"].body.strip() == "Thanks"
    roots = {r.message_id: r.root for r in mbox.threads(mails.withColumn("subject", F.regexp_replace("subject", "^Angebot", "Angebot"))).collect()}
    assert roots == {"1@x": "1@x", "2@x": "1@x", "3@x": "1@x"}


def test_mailbox_keeps_bytes_and_lines_that_begin_with_from(spark, tmp_path):
    """8-bit bodies, "From " inside a body, and splits so small that messages go on in the next ones."""
    head = "From - Mon May 18 1{n}:00:00 2026\nMessage-ID: <{n}@x>\nDate: Mon, 18 May 2026 1{n}:00:00 +0200\nFrom: a@b.com\nSubject: s{n}\n{more}\n"
    bodies = [f"Dear all,\nFrom the office in {k} we write\nFrom 2026 on it is so\n" + "line of text\n" * (40 * k) + f"end {k}" for k in range(6)]
    raw = b"".join((head.format(n=k, more="") + body + "\n\n").encode() for k, body in enumerate(bodies))
    raw += head.format(n=6, more="Content-Type: text/plain; charset=gb2312\nContent-Transfer-Encoding: 8bit\n").encode() + "报价单已确认".encode("gb18030") + b"\n\n"
    raw += head.format(n=7, more="").encode() + "没有字符集".encode("gb18030") + b"\n"
    (tmp_path / "box").mkdir()
    (tmp_path / "box" / "Inbox").write_bytes(raw)
    (tmp_path / "box" / "notes").write_bytes(b"no mailbox\nFrom - Mon May 18 10:00:00 2026\nMessage-ID: <no@x>\n\nnot a mail\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.message_id: r.body.strip() for r in mbox.messages(spark, str(tmp_path / "box")).collect()}
            assert got == {f"{k}@x": body for k, body in enumerate([*bodies, "报价单已确认", "没有字符集"])}, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_messages_leave_a_task_in_small_batches():
    """A task makes rows of a few messages at a time, however large Spark's batches are."""
    raw = b" Mon May 18 10:00:00 2026\nMessage-ID: <a@x>\n\nText\n"
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 1000), pa.array([0] * 1000, pa.int64()), pa.array([raw.replace(b" Mon", b"- Mon")] * 1000, pa.binary())], ["file", "block", "raw"])
    out = list(mbox._fragments(iter([batch])))
    assert sum(b.num_rows for b in out) == 1000 and max(b.num_rows for b in out) <= 64
    assert [b.num_rows for b in few_rows([batch.slice(0, 0), batch.slice(0, 130)])] == [64, 64, 2]
