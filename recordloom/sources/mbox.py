"""Mail archives as a table of messages, and the thread each belongs to."""

from __future__ import annotations

import datetime as dt
import email
import email.policy
import hashlib
import re
from collections.abc import Iterator
from email.header import decode_header
from email.utils import getaddresses, parsedate_to_datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_subject
from ..operators.lookups import roots
from .shared import few_rows

_PERSON = "struct<name: string, email: string>"
SCHEMA = (
    f"file string, message_id string, date timestamp, sender {_PERSON}, recipients array<{_PERSON}>, copies array<{_PERSON}>, subject string, "
    "in_reply_to string, refs array<string>, body string, attachments array<struct<filename: string, content_type: string, size: long, sha256: string>>, bulk boolean, error string"
)
#: Folders that hold nothing to keep.
SKIPPED = "(?i)(deleted|junk|trash|spam|gelöscht|papierkorb)"


def decoded(value: str | None) -> str:
    """A header's text whatever its encoding."""
    out = []
    for part, charset in decode_header(value or ""):
        if isinstance(part, str):
            out.append(part)
            continue
        for name in (charset, "utf-8", "gb18030", "latin-1"):
            try:
                out.append(part.decode(name or "ascii"))
                break
            except (LookupError, UnicodeDecodeError):
                continue
    return re.sub(r"\s+", " ", "".join(out)).strip()


def _people(values: list[str]) -> list[dict]:
    return [{"name": decoded(n), "email": a.lower().strip()} for n, a in getaddresses(values) if "@" in a]


def _ids(value: str | None) -> list[str]:
    return re.findall(r"<([^<>\s]+)>", value or "")


def message_row(file: str, raw: bytes) -> tuple:
    """One message as a row of ``SCHEMA``."""
    try:
        msg = email.message_from_bytes(raw, policy=email.policy.compat32)
        bodies, html, attachments = [], [], []
        for part in msg.walk():
            if part.is_multipart():
                continue
            data = part.get_payload(decode=True) or b""
            name = decoded(part.get_filename())
            if name or part.get_content_disposition() == "attachment":
                attachments.append({"filename": name, "content_type": part.get_content_type(), "size": len(data), "sha256": hashlib.sha256(data).hexdigest()})
                continue
            for charset in (part.get_content_charset(), "utf-8", "gb18030", "latin-1"):
                try:
                    text = data.decode(charset or "ascii")
                    break
                except (LookupError, UnicodeDecodeError):
                    continue
            (bodies if part.get_content_type() == "text/plain" else html if part.get_content_type() == "text/html" else []).append(text)
        try:
            at = parsedate_to_datetime(msg.get("Date", ""))
            at = at.astimezone(dt.timezone.utc) if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
        except (TypeError, ValueError):
            at = None
        own = _ids(msg.get("Message-ID"))
        key = own[0] if own else hashlib.sha1(raw).hexdigest()
        sender = (_people([msg.get("From", "")]) or [None])[0]
        bulk = bool(msg.get("List-Unsubscribe") or msg.get("List-Id") or (msg.get("Precedence", "").lower() in ("bulk", "list", "junk")) or msg.get("Auto-Submitted", "no").lower() != "no")
        body = "\n".join(bodies) if bodies else "\n".join(html)
        return (file, key, at, sender, _people(msg.get_all("To", [])), _people(msg.get_all("Cc", [])), decoded(msg.get("Subject")), (_ids(msg.get("In-Reply-To")) or [None])[0], _ids(msg.get("References")), body, attachments, bulk, None)
    except Exception as e:  # noqa: BLE001  one bad message never stops the others
        return (file, hashlib.sha1(raw).hexdigest(), None, None, [], [], None, None, [], None, [], None, f"{type(e).__name__}: {e}"[:300])


#: A separator names a weekday, a time and a year; any other line that begins with "From " is part of a message.
_SEPARATOR = re.compile(rb"(?=[^\n]*\b(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\b)(?=[^\n]*\d:\d\d)(?=[^\n]*\b\d{4}\b)[^\n]*(?:\n|$)", re.I)
_PARTS = "file string, block long, n long, kind string, last boolean, raw binary"


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies between lines that begin with "From ", put together again where such a line is no separator.

    ``kind``: a ``message``; a ``rest`` that belongs to the last message of the
    split before; ``foreign``, the start of a file that is no mailbox.
    """
    held: tuple | None = None
    pieces: list[bytes] = []
    n = 0

    def row(last: bool) -> list[tuple]:
        return [(held[0], held[1], n, held[2], last, b"\nFrom ".join(pieces))] if held else []

    for batch in few_rows(batches):
        out: list[tuple] = []
        for k in range(batch.num_rows):
            file, block, raw = batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py() or b""
            same = held is not None and held[:2] == (file, block)
            if not same and block == 0:
                kind = "message" if raw.startswith(b"From ") and _SEPARATOR.match(raw[5:]) else "foreign"
                raw = raw[5:] if kind == "message" else raw
            else:
                kind = "message" if _SEPARATOR.match(raw) else "rest"
            if same and kind == "rest":
                pieces.append(raw)
                continue
            out += row(not same)
            held, pieces, n = (file, block, kind), [raw], n + 1 if same else 0
        yield _batch(out)
    yield _batch(row(True))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in _PARTS.split(", ")])


def raw_messages(spark: SparkSession, path: str) -> DataFrame:
    """``file, raw``: the bytes of every message below ``path``, without its separator line.

    Spark splits files at the bytes ``\\nFrom ``, so a large mailbox is read by
    many tasks; nothing is decoded on the way.  What follows such a line that is no
    separator stays with its message, also when that began in the split before.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\nFrom ").text(path)
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:", "").alias("file")
    parts = lines.select(file, F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("raw"))
    parts = parts.where(~F.col("file").rlike(SKIPPED) & ~F.col("file").rlike("\\.(?:msf|json|dat)$")).mapInArrow(_fragments, _PARTS)
    # One row for each file that is no mailbox; Spark lists every file on the driver anyway.
    foreign = F.broadcast(parts.where("kind = 'foreign'").select("file").distinct())
    parts = parts.join(foreign, "file", "left_anti")
    whole = parts.where("kind = 'message'")
    # Only the last message of a split can go on in the next one, so no other is shuffled.
    ends = whole.where("last").select("file", "block", "n", "raw")
    rests = parts.where("kind = 'rest'").select("file", F.col("block").alias("at"), F.col("raw").alias("more"))
    owner = rests.join(ends.select("file", "block"), "file").where("block < at").groupBy("file", "at").agg(F.max("block").alias("block"))
    tails = rests.join(owner, ["file", "at"]).groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("at", "more"))).alias("tails"))
    joined = ends.join(tails, ["file", "block"], "left").select("file", "raw", F.coalesce(F.transform("tails", lambda t: t["more"]), F.array().cast("array<binary>")).alias("tails"))
    joined = joined.select("file", F.aggregate("tails", F.col("raw"), lambda a, b: F.concat(a, F.lit(b"\nFrom "), b)).alias("raw"))
    return whole.where("not last").select("file", "raw").unionByName(joined)


def readings(spark: SparkSession, path: str) -> DataFrame:
    """Every message of every mailbox file below ``path``: files that begin with a separator and lie in no skipped folder.

    Texts are decoded by their own charset, else as UTF-8, gb18030 or Latin-1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            rows = [message_row(f, r.partition(b"\n")[2].replace(b"\n>From ", b"\nFrom ")) for f, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 13
            person = pa.struct([("name", pa.string()), ("email", pa.string())])
            attached = pa.struct([("filename", pa.string()), ("content_type", pa.string()), ("size", pa.int64()), ("sha256", pa.string())])
            kinds = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), person, pa.list_(person), pa.list_(person), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.list_(attached), pa.bool_(), pa.string()]
            names = ["file", "message_id", "date", "sender", "recipients", "copies", "subject", "in_reply_to", "refs", "body", "attachments", "bulk", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return raw_messages(spark, path).mapInArrow(run, SCHEMA)


def messages(spark: SparkSession, path: str) -> DataFrame:
    """The same, but a message that lies in several folders comes once, from the deepest, with all its ``files``."""
    read = readings(spark, path)
    depth = F.size(F.split("file", "/"))
    rest = [c for c in read.columns if c not in ("message_id", "file")]
    best = read.groupBy("message_id").agg(F.max_by(F.struct("file", *rest), F.struct(depth, "file")).alias("m"), F.array_sort(F.collect_set("file")).alias("files"))
    return best.select("message_id", "m.*", "files")


def threads(mails: DataFrame) -> DataFrame:
    """``message_id, root, depth``: by the first known reference, else what it replies to, else the first mail of the same plain subject."""
    parent = F.coalesce(F.get("refs", F.size("refs") - 1), "in_reply_to")
    subject = F.lower(plain_subject(F.col("subject")))
    rows = mails.select("message_id", "date", parent.alias("parent"), subject.alias("plain"), (F.lower(F.trim("subject")) != subject).alias("is_reply"))
    first = rows.where("plain <> ''").groupBy("plain").agg(F.min_by("message_id", F.struct("date", "message_id")).alias("first_mail"))
    rows = rows.join(first, "plain", "left")
    rows = rows.withColumn("parent", F.coalesce("parent", F.when(F.col("is_reply") & (F.col("first_mail") != F.col("message_id")), F.col("first_mail"))))
    return roots(rows.select("message_id", "parent"), "message_id", "parent")


def attachments(mails: DataFrame) -> DataFrame:
    """One row per content, from the earliest mail that has it, with all mails that have it."""
    each = mails.select("message_id", "date", F.explode("attachments").alias("a")).select("message_id", "date", "a.*")
    return each.groupBy("sha256").agg(F.min_by(F.struct("filename", "content_type", "size", "message_id"), F.struct("date", "message_id")).alias("f"), F.array_sort(F.collect_set("message_id")).alias("messages")).select("sha256", "f.*", "messages")
