"""A mail archive's indexes by id, source, sender and participant, stored once and looked up where they lie.

Each index is a table in buckets of ``key`` and ``slot``; a join with it moves
only what is looked for.  ``slot`` deals the mails of one key over several
buckets, so that a sender of a third of all mail is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import person_key
from ..operators.mail import sole_addresses
from .shared import stored

INDEXES = ("id", "source", "sender", "participant")


def with_senders(mails: DataFrame) -> DataFrame:
    """``mails`` and ``from_address``: the sender's; a legacy address (or none) is read through the one address that the archive has for the name.

    A name with several addresses settles nothing, the legacy address stays.
    """
    people = mails.select(F.explode(F.concat(F.array("sender"), "recipients", "copies")).alias("p")).select("p.name", "p.email").where("email is not null")
    email = F.lower("sender.email")
    legacy = F.coalesce(email.startswith("imceaex") | (email == ""), F.lit(True))
    known = sole_addresses(people, "name", "email").select(F.col("person").alias("person__"), F.col("email").alias("sole__"))
    # Only legacy senders meet the names; other rows have no key and would all go to one task.
    named = mails.where(legacy).withColumn("person__", person_key(F.col("sender.name"))).join(known, "person__", "left")
    named = named.withColumn("from_address", F.coalesce("sole__", email)).drop("person__", "sole__")
    return mails.where(~legacy).withColumn("from_address", email).unionByName(named)


def store(mails: DataFrame, name: str, path: str, buckets: int = 64, slots: int = 8, indexes: Sequence[str] = INDEXES) -> None:
    """Write ``indexes`` of ``mails`` (as ``mbox.messages`` gives them) below ``path`` as tables ``{name}_by_{index}``.

    Rows are ``key, slot, message_id, date, subject``; empty and missing keys
    have none.  An empty archive gives empty tables.
    """
    persons = F.concat(F.transform(F.concat(F.array("sender"), "recipients", "copies"), lambda p: F.lower(p["email"])), F.array("from_address"))
    # Senders and participants cost a pass over all names of the archive, so only archives that are asked for them have it.
    persons_asked = {"sender", "participant"} & set(indexes)
    filled = mails.withColumns({c: F.coalesce(c, F.expr("array()").cast(mails.schema[c].dataType)) for c in ("recipients", "copies", "files")})
    slim = with_senders(filled).select("message_id", "date", "subject", "files", "from_address", F.array_distinct(F.array_compact(persons)).alias("persons")) if persons_asked else filled.select("message_id", "date", "subject", "files")
    slim = stored(slim, "archive")
    keys = {"id": F.col("message_id"), "source": F.explode(F.array_distinct("files")), "sender": F.col("from_address"), "participant": F.explode("persons")}
    spark = mails.sparkSession
    for index in indexes:
        dealt = 1 if index == "id" else slots
        rows = slim.select(keys[index].alias("key"), F.pmod(F.xxhash64("message_id"), F.lit(dealt)).cast("int").alias("slot"), "message_id", "date", "subject").where("key <> ''")
        table = f"{name}_by_{index}"
        # Dealt as the buckets are, so that every bucket is one file.
        rows.repartition(buckets, "key", "slot").write.format("parquet").bucketBy(buckets, "key", "slot").sortBy("key", "slot").option("path", f"{path}/{index}").mode("overwrite").saveAsTable(table)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('slots' = '{dealt}')")


def look_up(name: str, index: str, wanted: DataFrame, key: str, into: str = "mail") -> DataFrame:
    """Each row of ``wanted`` beside each mail under its ``key``, as a struct ``into``; rows without a mail are left out.

    A wanted row is repeated for every slot, so give each key once where keys are many.
    """
    spark = wanted.sparkSession
    table = f"{name}_by_{index}"
    slots = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('slots')").first()["value"])
    held = spark.table(table).select(F.col("key").alias("key__"), F.col("slot").alias("slot__"), F.struct("message_id", "date", "subject").alias("mail__"))
    asked = wanted.withColumn("at__", F.explode(F.array(*[F.lit(k) for k in range(slots)])))
    found = asked.join(held, (asked[key] == held["key__"]) & (asked["at__"] == held["slot__"]))
    return found.select(*[asked[c] for c in wanted.columns], F.col("mail__").alias(into))


def find(name: str, wanted: DataFrame, message_id: str, source: str) -> DataFrame:
    """``wanted`` with ``found`` and ``how``: the mail of that ``id``, else the only one of that ``source``; several are ``ambiguous``, none is ``none``."""
    ids = look_up(name, "id", wanted.select(F.col(message_id).alias("id__")).distinct(), "id__").select("id__", F.lit(True).alias("known__")).distinct()
    mails = look_up(name, "source", wanted.select(F.col(source).alias("source__")).distinct(), "source__")
    sources = mails.groupBy("source__").agg(F.min("mail.message_id").alias("one__"), (F.min("mail.message_id") == F.max("mail.message_id")).alias("sole__"))
    # Rows without a key, or that the id has settled, stay out of the joins: as nulls they would all meet in one task.
    named = wanted.where(F.col(message_id).isNotNull()).join(ids, F.col(message_id) == F.col("id__"), "left")
    unnamed = wanted.where(F.col(message_id).isNull())
    known = named.where("known__").select(*wanted.columns, F.col(message_id).alias("found"), F.lit("id").alias("how"))
    rest = named.where("known__ is null").select(*wanted.columns).unionByName(unnamed)
    filed = rest.where(F.col(source).isNotNull()).join(sources, F.col(source) == F.col("source__"), "left")
    how = F.when(F.col("sole__"), "source").when(F.col("one__").isNotNull(), "ambiguous").otherwise("none")
    filed = filed.select(*wanted.columns, F.when(F.col("sole__"), F.col("one__")).alias("found"), how.alias("how"))
    nowhere = rest.where(F.col(source).isNull()).select(*wanted.columns, F.lit(None).cast("string").alias("found"), F.lit("none").alias("how"))
    return known.unionByName(filed).unionByName(nowhere)
