"""A second decoder of mail, with code of its own, and what the two readings do not agree on.

``sources.mbox`` leans on Python's ``email``; this one works on bytes: it unfolds
headers, cuts bodies at their boundaries, undoes transfer encodings and decodes charsets by itself.
An error in one of them is unlikely to be in the other, so what both
read the same can be trusted, and what they do not is a row.
"""

from __future__ import annotations

import binascii
import datetime as dt
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mbox import SKIPPED, raw_messages
from .shared import few_rows

_PERSON = "struct<name: string, email: string>"
SCHEMA = (
    f"file string, message_id string, date timestamp, sender {_PERSON}, recipients array<{_PERSON}>, copies array<{_PERSON}>, subject string, "
    "body string, attachments array<struct<filename: string, content_type: string, size: long, sha256: string>>, error string"
)
#: Names under which mail programs label text that is GB 18030.
GB = {"gb2312", "gbk", "x-gbk", "gb_2312-80", "cp936", "hz-gb-2312"}
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_ZONES = {"ut": 0, "utc": 0, "gmt": 0, "z": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420}
_WORD = re.compile(r"=\?([^?*\s]+)(?:\*[^?]*)?\?([bq])\?([^?]*)\?=", re.I)
_PARAMETER = re.compile(r';\s*([\w-]+)(?:\*(\d+))?(\*)?\s*=\s*("(?:[^"\\]|\\.)*"|[^;\s]*)')
_DATE = re.compile(r"(\d{1,2})\s+([a-z]{3})[a-z]*\s+(\d{4})\s+(\d{1,2}):(\d\d)(?::(\d\d))?\s*([+-]\d{4}|[a-z]{1,3}\b)?", re.I)
#: A sender line as JVM code finds it, apart from the one that cuts the messages.
START = r"(?i)^From (?=.*\b(mon|tue|wed|thu|fri|sat|sun)[a-z]*\b)(?=.*\d:\d\d)(?=.*\b\d{4}\b)"


def text_of(data: bytes, charset: str | None) -> str:
    """``data`` by its label, else as UTF-8, GB 18030 or Latin-1."""
    label = (charset or "utf-8").lower().strip()
    for name in ("gb18030" if label in GB else label, "utf-8", "gb18030"):
        try:
            return data.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return data.decode("latin-1")


def untransferred(data: bytes, encoding: str) -> bytes:
    """The content of a part as it was before it was made fit to be sent."""
    kind = encoding.strip().lower()
    if kind == "base64":
        digits = re.sub(rb"[^A-Za-z0-9+/]", b"", data.split(b"=")[0])
        return binascii.a2b_base64(digits[: len(digits) - (len(digits) % 4 == 1)] + b"=" * (-len(digits) % 4))
    return binascii.a2b_qp(data) if kind == "quoted-printable" else data


def spoken(value: str) -> str:
    """A header's text; encoded words that follow each other in one charset are decoded together, since they may cut a character."""
    out, held, charset, end = [], b"", "", 0
    for word in _WORD.finditer(value):
        gap, name = value[end : word.start()], word[1].lower()
        together = end > 0 and not gap.strip()
        if held and not (together and name == charset):
            out.append(text_of(held, charset))
            held = b""
        if not together:
            out.append(gap)
        data = word[3].encode("latin-1", "replace")
        held += untransferred(data, "base64") if word[2] in "bB" else binascii.a2b_qp(data, header=True)
        charset, end = name, word.end()
    if held:
        out.append(text_of(held, charset))
    return " ".join("".join([*out, value[end:]]).split())


def headers_and_body(raw: bytes) -> tuple[dict[str, list[str]], bytes]:
    """The unfolded headers by their lower-case names, and what follows the first empty line."""
    cut = re.search(rb"\r?\n\r?\n|\A\r?\n", raw)
    top, body = (raw[: cut.start()], raw[cut.end() :]) if cut else (raw, b"")
    out: dict[str, list[str]] = {}
    for line in re.split(rb"\r?\n(?![ \t])", top):
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(text_of(name, None).strip().lower(), []).append(re.sub(r"\r?\n", "", text_of(value, None)).strip())
    return out, body


def parameters(value: str) -> dict[str, str]:
    """The parameters of a header; parts of one (``name*0``, ``name*1*``) are joined, percent signs undone."""
    pieces: dict[str, list[tuple[int, bool, str]]] = {}
    for name, nth, coded, text in _PARAMETER.findall(value):
        text = re.sub(r"\\(.)", r"\1", text[1:-1]) if text[:1] == '"' else text
        pieces.setdefault(name.lower(), []).append((int(nth or 0), bool(coded), text))
    out = {}
    for name, found in pieces.items():
        found.sort(key=lambda p: p[0])
        if not any(coded for _, coded, _ in found):
            out[name] = "".join(text for _, _, text in found)
            continue
        charset, mark, first = found[0][2].partition("'")
        found[0] = (0, found[0][1], first.partition("'")[2] if mark else found[0][2])
        data = b"".join(unquote_to_bytes(text) if coded else text.encode("utf-8") for _, coded, text in found)
        out[name] = text_of(data, charset if mark else None)
    return out


def leaves(headers: dict[str, list[str]], body: bytes) -> Iterator[tuple[str, dict[str, list[str]], bytes]]:
    """``type, headers, content`` of every part that holds no parts, in order; a part without an end goes to the end of what holds it."""
    todo = [(headers, body, "text/plain")]
    while todo:
        head, data, default = todo.pop()
        kind = head.get("content-type", [""])[0]
        name = kind.partition(";")[0].strip().lower()
        name = name if name.count("/") == 1 else "text/plain" if kind else default
        boundary = parameters(kind).get("boundary")
        if name == "message/rfc822":
            todo.append((*headers_and_body(data), "text/plain"))
        elif name.startswith("multipart/") and boundary:
            mark = re.compile(rb"(?:\A|\r?\n)--" + re.escape(boundary.encode()) + rb"(--)?[ \t]*(?:\r?\n|\Z)")
            inner, at = [], None
            pos = 0
            while found := mark.search(data, pos):
                if at is not None:
                    inner.append(data[at : found.start()])
                at, pos = (None if found[1] else found.end()), max(found.end() - 1, found.start() + 1)
                if found[1]:
                    break
            if at is not None:
                inner.append(data[at:])
            below = "message/rfc822" if name == "multipart/digest" else "text/plain"
            todo += [(*headers_and_body(p), below) for p in reversed(inner)]
        elif not name.startswith("multipart/"):
            yield name, head, data


def people(values: list[str]) -> list[dict[str, str]]:
    """Names and addresses of a header: cut at commas and semicolons that stand in no quotes, angles or brackets."""
    out = []
    for value in values:
        for piece in re.findall(r'(?:"(?:[^"\\]|\\.)*"|<[^<>]*>|\([^()]*\)|[^,;"<(]|["<(])+', value):
            note = re.findall(r"\(([^()]*)\)", piece)
            plain = re.sub(r"\([^()]*\)", " ", piece)
            angle = re.search(r"<([^<>]*)>", plain)
            address = (angle[1] if angle else plain).strip().lower()
            name = plain[: angle.start()].strip() if angle else " ".join(note)
            name = re.sub(r"\\(.)", r"\1", name[1:-1]) if len(name) > 1 and name[0] == name[-1] == '"' else name
            if "@" in address:
                out.append({"name": spoken(name), "email": address})
    return out


def moment(value: str) -> dt.datetime | None:
    """A date header in UTC; without a zone it counts as UTC."""
    found = _DATE.search(value)
    if not found or found[2].lower() not in _MONTHS:
        return None
    zone = found[7] or "Z"
    minutes = (-1 if zone[0] == "-" else 1) * (int(zone[1:3]) * 60 + int(zone[3:])) if zone[0] in "+-" else _ZONES.get(zone.lower(), 0)
    try:
        at = dt.datetime(int(found[3]), _MONTHS.index(found[2].lower()) + 1, int(found[1]), int(found[4]), int(found[5]), int(found[6] or 0), tzinfo=dt.timezone.utc)
        return at - dt.timedelta(minutes=minutes)
    except (ValueError, OverflowError):
        return None


def message_row(file: str, raw: bytes) -> tuple:
    """One message as a row of ``SCHEMA``."""
    try:
        headers, body = headers_and_body(raw)
        texts: dict[str, list[str]] = {"text/plain": [], "text/html": []}
        attached = []
        for kind, head, data in leaves(headers, body):
            content = untransferred(data, head.get("content-transfer-encoding", [""])[0])
            placed = head.get("content-disposition", [""])[0]
            options = parameters(head.get("content-type", [""])[0])
            name = spoken(parameters(placed).get("filename") or options.get("name") or "")
            if name or placed.partition(";")[0].strip().lower() == "attachment":
                attached.append({"filename": name, "content_type": kind, "size": len(content), "sha256": hashlib.sha256(content).hexdigest()})
            elif kind in texts:
                texts[kind].append(text_of(content, options.get("charset")))
        one = lambda name: (headers.get(name) or [""])[0]
        own = re.search(r"<([^<>\s]+)>", one("message-id"))
        sender = (people([one("from")]) or [None])[0]
        body_text = "\n".join(texts["text/plain"] or texts["text/html"])
        key = own[1] if own else hashlib.sha1(raw).hexdigest()
        return (file, key, moment(one("date")), sender, people(headers.get("to", [])), people(headers.get("cc", [])), spoken(one("subject")), body_text, attached, None)
    except Exception as e:  # noqa: BLE001  one bad message never stops the others
        return (file, hashlib.sha1(raw).hexdigest(), None, None, [], [], None, None, [], f"{type(e).__name__}: {e}"[:300])


def readings(spark: SparkSession, path: str) -> DataFrame:
    """Every message below ``path`` as this decoder reads it; one that lies in several folders comes from each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        person = pa.struct([("name", pa.string()), ("email", pa.string())])
        attached = pa.struct([("filename", pa.string()), ("content_type", pa.string()), ("size", pa.int64()), ("sha256", pa.string())])
        kinds = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), person, pa.list_(person), pa.list_(person), pa.string(), pa.string(), pa.list_(attached), pa.string()]
        names = ["file", "message_id", "date", "sender", "recipients", "copies", "subject", "body", "attachments", "error"]
        for batch in few_rows(batches):
            rows = [message_row(f, r.partition(b"\n")[2].replace(b"\n>From ", b"\nFrom ")) for f, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return raw_messages(spark, path).mapInArrow(run, SCHEMA)


def facts(mails: DataFrame) -> DataFrame:
    """``file, message_id, field, value``: what a reading says of each message, a row for each address and attachment.

    Texts are compared with their white space made one; a body is its SHA-256, so
    the rows stay small.  What is not there gives no row.
    """
    plain = lambda c: F.trim(F.regexp_replace(c, r"[\s\u00a0]+", " "))
    fact = lambda field, value: F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"))
    person = lambda p: F.concat_ws(" ", F.nullif(plain(p["name"]), F.lit("")), F.concat(F.lit("<"), p["email"], F.lit(">")))
    none = F.array().cast("array<struct<field: string, value: string>>")
    each = lambda field, column, value: F.coalesce(F.transform(column, lambda p: fact(field, value(p))), none)
    held = F.concat(
        F.array(fact("message", F.lit("")), fact("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")), fact("subject", F.nullif(plain(F.col("subject")), F.lit("")))),
        F.array(fact("sender", person(F.col("sender"))), fact("body", F.sha2(plain(F.col("body")), 256)), fact("error", F.col("error"))),
        each("recipient", "recipients", person),
        each("copy", "copies", person),
        each("attachment", "attachments", lambda a: F.concat_ws(" ", a["sha256"], F.nullif(plain(a["filename"]), F.lit("")))),
    )
    return mails.select("file", "message_id", F.inline(held)).where("value is not null and not (field = 'sender' and value = '')")


def disagreements(first: DataFrame, second: DataFrame) -> DataFrame:
    """``file, message_id, field, value, first, second``: what two readings do not say equally often.

    Both are tables as ``mbox.readings`` and :func:`readings` give them.  Facts are counted as multisets, in the
    tasks before the shuffle: an address that one reading has twice is a row, and so
    is a message that only one has.  Tables that agree give no row.
    """
    one, two = facts(first).withColumns({"f": F.lit(1), "s": F.lit(0)}), facts(second).withColumns({"f": F.lit(0), "s": F.lit(1)})
    counted = one.unionByName(two).groupBy("file", "message_id", "field", "value").agg(F.sum("f").alias("first"), F.sum("s").alias("second"))
    return counted.where("first <> second")


def files(spark: SparkSession, path: str, first: DataFrame) -> DataFrame:
    """``file, field, first, second``: files whose lines hold another number of starts than ``first`` has messages (``messages``), or neither (``no_mailbox``).

    Lines are counted by Spark's own reader, apart from the splits that ``first``
    was read in.  Files without a byte and those of skipped folders have no row.
    """
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:", "").alias("file")
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path).select(file, F.col("value").rlike(START).cast("long").alias("start"))
    lines = lines.where(~F.col("file").rlike(SKIPPED) & ~F.col("file").rlike("\\.(?:msf|json|dat)$"))
    starts = lines.groupBy("file").agg(F.sum("start").alias("second"))
    both = starts.join(first.groupBy("file").agg(F.count("*").alias("first")), "file", "full").select("file", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("first", "second")))
    field = F.when(F.col("first") != F.col("second"), "messages").when(F.col("first") == 0, "no_mailbox")
    return both.select("file", field.alias("field"), "first", "second").where("field is not null")
