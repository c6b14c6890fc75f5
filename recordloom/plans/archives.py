"""Queries on the stored indexes of an archive."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import archive
from ..sources.shared import new_path
from .registry import query


def order_archive(t, indexes=archive.INDEXES) -> str:
    """Orders as mails from their clerks to their customers, stored; the name of the archive.

    Each customer has one of a hundred clerks. Every fifth order has a legacy address for its sender; clerks whose number ends in seven write from two addresses.
    """
    key, text = F.col("o_orderkey"), lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    clerk = F.lpad((F.col("o_custkey") % 100).cast("string"), 3, "0")
    box = F.translate(F.concat(F.lit("clerk"), clerk), "0123456789", "abcdefghij")
    sent = F.when(key % 5 == 0, text("IMCEAEX-", box)).when(clerk.endswith("7") & (key % 2 == 0), text(box, "@alt.x.com")).otherwise(text(box, "@x.com"))
    to = text("c", F.col("o_custkey").cast("string"), "@y.com")
    mails = t("orders").select(
        text("o", key.cast("string")).alias("message_id"), F.col("o_orderdate").cast("timestamp").alias("date"), F.col("o_orderpriority").alias("subject"),
        F.array(F.when(key % 3 == 0, text("box/o", key.cast("string"))).otherwise(text("box/", F.col("o_custkey").cast("string")))).alias("files"),
        F.struct(F.concat(F.lit("Office "), box).alias("name"), sent.alias("email")).alias("sender"), F.array(F.struct(F.lit("").alias("name"), to.alias("email"))).alias("recipients"),
        F.expr("cast(array() as array<struct<name: string, email: string>>)").alias("copies"),
    )
    archived = f"archive_{uuid.uuid4().hex}"
    archive.store(mails, archived, new_path(mails.sparkSession, "indexes"), buckets=16, indexes=indexes)
    return archived


@query("""with m as (select 'o' || o_orderkey as id, case when o_orderkey % 3 = 0 then 'box/o' || o_orderkey else 'box/' || o_custkey end as src from orders),
  s as (select src, count(*) as n, min(id) as id from m group by src),
  w as (select l_orderkey, l_linenumber, case when l_linenumber % 4 in (0, 3) then 'o' || l_orderkey when l_linenumber % 4 = 1 then 'x' || l_orderkey end as id,
    case when l_linenumber % 4 = 1 then 'box/o' || l_orderkey when l_linenumber % 4 < 3 then 'box/' || l_suppkey end as src from lineitem)
select l_orderkey, l_linenumber, coalesce(m.id, case when s.n = 1 then s.id end) as found,
  case when m.id is not null then 'id' when s.n = 1 then 'source' when s.n > 1 then 'ambiguous' else 'none' end as how
from w left join m on w.id = m.id left join s on w.src = s.src""")
def cited_mails(t):
    """Lines of orders as citations of mails, by a right or wrong id or by the file alone."""
    k, key = F.col("l_linenumber") % 4, F.col("l_orderkey").cast("string")
    cited = F.when(k.isin(0, 3), F.concat(F.lit("o"), key)).when(k == 1, F.concat(F.lit("x"), key))
    source = F.when(k == 1, F.concat(F.lit("box/o"), key)).when(k < 3, F.concat(F.lit("box/"), F.col("l_suppkey").cast("string")))
    wanted = t("lineitem").select("l_orderkey", "l_linenumber", cited.alias("id"), source.alias("file"))
    return archive.find(order_archive(t, ("id", "source")), wanted, "id", "file").drop("id", "file")


@query("""with o as (select *, translate('clerk' || lpad((o_custkey % 100)::varchar, 3, '0'), '0123456789', 'abcdefghij') as box from orders),
  m as (select o_orderkey, o_custkey, box, o_orderkey % 5 = 0 as legacy, case when o_orderkey % 5 = 0 then 'imceaex-' || box when o_custkey % 10 = 7 and o_orderkey % 2 = 0 then box || '@alt.x.com' else box || '@x.com' end as email from o),
  a as (select box, min(email) as email from m where not legacy group by box having count(distinct email) = 1),
  f as (select o_orderkey, o_custkey, m.email as written, case when legacy then coalesce(a.email, m.email) else m.email end as sender from m left join a on a.box = m.box),
  p as (select distinct o_orderkey, unnest([written, sender, 'c' || o_custkey || '@y.com']) as address from f)
select p.address, (select count(*) from f where f.sender = p.address)::bigint as sent, count(*)::bigint as part from p group by p.address""")
def mails_of_addresses(t):
    """Every address of the archive with the mails it sent, legacy senders by their names, and those it had part in."""
    name = order_archive(t)
    spark = t("orders").sparkSession
    everyone = spark.table(f"{name}_by_participant").select(F.col("key").alias("address")).distinct()
    counts = [archive.look_up(name, index, everyone, "address").groupBy("address").agg(F.count("*").alias(n)) for index, n in (("sender", "sent"), ("participant", "part"))]
    return counts[1].join(counts[0], "address", "left").select("address", F.coalesce("sent", F.lit(0)).alias("sent"), "part")
