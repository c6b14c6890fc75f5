"""Queries on mail that two decoders read: what both say, and what only one says."""

from __future__ import annotations

import base64
import binascii
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import mbox, second_reading
from ..sources.shared import new_path
from .registry import query

_TOP = "From - Mon May 18 10:00:00 2026\nDate: Mon, 18 May 2026 12:00:00 +0200\n"


def _sent(text: str, kind: int) -> str:
    """A text as mail programs send it: as UTF-8, as GB 18030 under the name of its elder, in quoted printable, and with a copy attached."""
    lines = lambda data: base64.encodebytes(data).decode()
    if kind == 0:
        return f"Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n{text}\n"
    if kind == 1:
        return f"Content-Type: text/plain;\n charset=\"gb2312\"\nContent-Transfer-Encoding: base64\n\n{lines(text.encode('gb18030'))}\n"
    if kind == 2:
        latin = all(ord(c) < 256 for c in text)
        coded = binascii.b2a_qp(text.encode("latin-1" if latin else "utf-8")).decode("ascii")
        return f"Content-Type: text/plain; charset={'iso-8859-1' if latin else 'utf-8'}\nContent-Transfer-Encoding: quoted-printable\n\n{coded}\n"
    inner = f"Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n{lines(text.encode())}"
    name = quote("附件 1.txt")
    copy = f"Content-Type: application/octet-stream\nContent-Disposition: attachment;\n filename*=utf-8''{name}\nContent-Transfer-Encoding: base64\n\n{lines(text.encode())}"
    return f'Content-Type: multipart/mixed; boundary="=_b 1"\n\nNo part.\n--=_b 1\n{inner}\n--=_b 1\n{copy}\n--=_b 1--\n'


def sent(text: Column, kind: Column) -> Column:
    """The part of a mail that holds ``text``."""

    def run(texts: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([_sent(t or "", k) for t, k in zip(texts, kinds, strict=True)], dtype=object)

    return F.pandas_udf(run, "string")(text, kind)


def _word(text, charset="utf-8"):
    """An encoded word of a header."""
    return F.concat(F.lit(f"=?{charset}?B?"), F.base64(F.encode(text, "utf-8")), F.lit("?="))


@query("""select doc_id, (doc_id % 4)::int as kind, 'Paper 单 ' || doc_id as subject, md5(trim(regexp_replace(coalesce("text", ''), '\\s+', ' ', 'g'))) as body,
  case when doc_id % 4 = 3 then sha256(coalesce("text", '')) end as attachment, 0::bigint as findings from documents""")
def mail_read_twice(t):
    """Documents sent as mail in four ways, as the second decoder reads them, with the number of facts that the first reads otherwise."""
    docs = t("documents")
    head = F.concat(F.lit(f"{_TOP}Message-ID: <"), F.col("doc_id").cast("string"), F.lit("@x>\nSubject: "), _word(F.concat(F.lit("Paper 单 "), F.col("doc_id").cast("string"))), F.lit("\n"))
    path = new_path(docs.sparkSession, "mailboxes")
    part = F.replace(sent(F.col("text"), (F.col("doc_id") % 4).cast("int")), F.lit("\nFrom "), F.lit("\n>From "))
    docs.select(F.concat(head, part, F.lit("\n"))).write.text(path)
    second = second_reading.readings(docs.sparkSession, path)
    found = second_reading.disagreements(mbox.readings(docs.sparkSession, path), second).groupBy("message_id").agg(F.count("*").alias("findings"))
    got = second.join(found, "message_id", "left").withColumn("doc_id", F.substring_index("message_id", "@", 1).cast("bigint"))
    body = F.md5(F.trim(F.regexp_replace("body", r"\s+", " ")))
    return got.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("kind"), "subject", body.alias("body"), F.get("attachments", 0)["sha256"].alias("attachment"), F.coalesce("findings", F.lit(0)).cast("long").alias("findings"))


@query("""with c as (select c_custkey as k, c_name as n, c_name || ' <c' || c_custkey || '@x.com>' as sender, '单 <t' || c_custkey || '@y.com>' as one, '<plain@z.com>' as two from customer),
  f as (select k, unnest([{'field': 'message', 'value': ''}, {'field': 'date', 'value': '2026-05-18T10:00:00'}, {'field': 'subject', 'value': n}, {'field': 'sender', 'value': sender},
    {'field': 'body', 'value': sha256(n)}, {'field': 'recipient', 'value': one}, {'field': 'recipient', 'value': two}], recursive := true), 0::bigint as first, 1::bigint as second from c where k % 11 = 0)
  select k as c_custkey, field, value, first, second from f
  union all select k, 'subject', n, 0, 1 from c where k % 5 = 0 and k % 11 <> 0 union all select k, 'subject', upper(n), 1, 0 from c where k % 5 = 0 and k % 11 <> 0
  union all select k, 'recipient', one, 2, 1 from c where k % 7 = 0 and k % 11 <> 0""")
def mail_disagreements(t):
    """Customers' mails of which the first reading lost some, spelled some subjects otherwise and counted some recipients twice."""
    c = t("customer")
    key = F.col("c_custkey").cast("string")
    text = F.concat(
        F.lit(f"{_TOP}Message-ID: <"), key, F.lit('@x>\nFrom: "'), F.col("c_name"), F.lit('" <C'), key, F.lit("@x.com>\nTo: "), _word(F.lit("单")), F.lit(" <t"), key, F.lit("@y.com>,\n plain@z.com\nSubject: "), F.col("c_name"),
        F.lit("\nContent-Type: text/html\n\n"), F.col("c_name"), F.lit("\n"),
    )
    path = new_path(c.sparkSession, "mailboxes")
    c.select(text).write.text(path)
    first, number = mbox.readings(c.sparkSession, path), F.substring_index("message_id", "@", 1).cast("bigint")
    first = first.where(number % 11 != 0).withColumn("subject", F.when(number % 5 == 0, F.upper("subject")).otherwise(F.col("subject")))
    first = first.withColumn("recipients", F.when(number % 7 == 0, F.concat("recipients", F.slice("recipients", 1, 1))).otherwise(F.col("recipients")))
    found = second_reading.disagreements(first, second_reading.readings(c.sparkSession, path))
    return found.select(number.alias("c_custkey"), "field", "value", "first", "second")
