"""What a run writes to the target, family by family: companies, people, overviews, approvals, and its report.

Nothing here writes.  Each function turns what was read and what the target holds
into rows that say what to do, so a second run over its own result plans nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import person_key

STAGES = ("", "prospect", "customer")


def lifecycle(stage: Column, barred: Column) -> Column:
    """An aggregate: the furthest of ``STAGES`` that an account's rows name; none where a row says that it must not be used."""
    rank = F.max(F.array_position(F.array(*map(F.lit, STAGES)), F.coalesce(stage, F.lit(""))))
    named = F.get(F.array(*map(F.lit, STAGES)), (F.greatest(rank, F.lit(1)) - 1).cast("int"))
    return F.when(F.coalesce(F.bool_or(barred), F.lit(False)), F.lit("")).otherwise(named)


def enriched(held: DataFrame, wanted: DataFrame, key: str, first: str, last: str, fields: Sequence[str]) -> DataFrame:
    """``key, first, last, fields`` of the companies that change.

    Fields come from whichever side was visited last (on a tie the new one), a blank never replaces a value; the earlier first visit stays.
    """
    new = wanted.select(key, F.struct(first, last, *fields).alias("w"))
    both = held.select(key, F.struct(first, last, *fields).alias("h")).join(new, key)
    later = F.coalesce(F.col(f"w.{last}") >= F.col(f"h.{last}"), F.col(f"h.{last}").isNull())
    value = lambda f: F.when(later, F.coalesce(f"w.{f}", f"h.{f}")).otherwise(F.coalesce(f"h.{f}", f"w.{f}"))
    out = both.select(key, "h", F.struct(F.least(f"h.{first}", f"w.{first}").alias(first), F.greatest(f"h.{last}", f"w.{last}").alias(last), *[value(f).alias(f) for f in fields]).alias("n"))
    return out.where(~F.col("n").eqNullSafe(F.col("h"))).select(key, "n.*")


def people_to_write(people: DataFrame, key: str, name: str, emails: str, held: DataFrame, contact: str) -> DataFrame:
    """``key, action, contact, emails``: who is made anew, and who is a contact already.

    ``held``: ``contact``, ``name`` and ``emails`` of the target.  An address that the
    target has under the same person's name makes that contact the person; one under
    another name stays with its holder, and the person is made without it.
    """
    owners = held.select(F.col(contact).alias("contact"), person_key(F.col(name)).alias("holder"), F.explode(F.transform(emails, F.lower)).alias("email"))
    owners = owners.groupBy("email").agg(F.min(F.struct("contact", "holder")).alias("o"))
    spread = people.select(key, person_key(F.col(name)).alias("person"), F.posexplode_outer(F.transform(emails, F.lower)).alias("pos", "email"))
    seen = spread.join(owners, "email", "left").withColumn("own", F.col("o.holder") == F.col("person"))
    free = F.when(F.col("o").isNull() & F.col("email").isNotNull(), F.struct("pos", "email"))
    out = seen.groupBy(key).agg(F.min_by("o.contact", F.when(F.col("own"), F.col("pos"))).alias("contact"), F.array_sort(F.collect_set(free)).alias("free"))
    action = F.when(F.col("contact").isNull(), "create").otherwise("reuse")
    return out.select(key, action.alias("action"), "contact", F.transform("free", lambda e: e["email"]).alias("emails"))


def approval_state(answers: DataFrame, deal: str, stamp: str, answer: str) -> DataFrame:
    """``deal, state``: the last answer given about each deal; anything but yes or no waits."""
    last = answers.groupBy(deal).agg(F.max_by(answer, F.struct(stamp, answer)).alias("last"))
    return last.select(deal, F.when(F.col("last") == "approve", "approved").when(F.col("last") == "reject", "rejected").otherwise("pending").alias("state"))


def merged_contacts(rows: DataFrame, key: Sequence[str], order: Column, fields: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """One contact for each key: the richest row first, blanks filled from the others in ``order``, lists joined whatever their case, and ``differing``: fields of which more than one value was seen."""
    known = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    place = F.struct((-known).alias("richness"), order.alias("order"))
    values = [F.min_by(f, F.when(F.col(f).isNotNull(), place)).alias(f) for f in fields]
    joined = [F.array_sort(F.array_distinct(F.transform(F.flatten(F.collect_list(c)), F.lower))).alias(c) for c in lists]
    several = [F.when(F.count_distinct(F.lower(F.trim(F.col(f).cast("string")))) > 1, F.lit(f)) for f in fields]
    return rows.groupBy(*key).agg(*values, *joined, F.array_compact(F.array(*several)).alias("differing"), F.count("*").alias("members"))


def overviews(orders: DataFrame, account: str, number: str, year: Column, amount: str, exported: str, held: DataFrame) -> DataFrame:
    """``account, body, action``: one note for each account with its orders by year, against the note that the target holds.

    ``held``: ``account, body, counted`` (the order numbers it covers) and ``exported``.  A
    held note from a later export, or one that knows orders which this run lacks, stays.
    """
    per = orders.groupBy(account, year.alias("year")).agg(F.count("*").alias("n"), F.sum(F.col(amount).cast("decimal(18,2)")).alias("total"))
    lines = per.groupBy(account).agg(F.array_sort(F.collect_list(F.struct("year", F.concat_ws(" ", F.concat(F.col("year").cast("string"), F.lit(":")), F.col("n").cast("string"), F.lit("orders,"), F.col("total").cast("string")).alias("line")))).alias("l"))
    seen = orders.groupBy(account).agg(F.array_sort(F.collect_set(number)).alias("numbers"), F.max(exported).alias("stamp"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    have = held.select(account, F.struct(F.col("body"), F.col("counted"), F.col("exported")).alias("h"))
    both = lines.join(seen, account).join(have, account, "left").withColumn("text", body)
    newer = (F.col("h.exported") > F.col("stamp")) | (F.size(F.array_except("h.counted", "numbers")) > 0)
    action = F.when(F.col("h").isNull(), "create").when(F.col("h.body") == F.col("text"), "same").when(newer, "newer").otherwise("update")
    return both.select(account, F.col("text").alias("body"), action.alias("action"))


def report(plan: DataFrame, family: str, action: str, error: str) -> DataFrame:
    """``family, written, present, skipped, failed, status``: one row for each family of a plan's rows."""
    failed = F.col(error).isNotNull()
    counts = plan.groupBy(family).agg(
        F.count_if(~failed & F.col(action).isin("create", "update")).alias("written"), F.count_if(~failed & F.col(action).isin("same", "reuse")).alias("present"),
        F.count_if(~failed & (F.col(action) == "newer")).alias("skipped"), F.count_if(failed).alias("failed"),
    )
    status = F.when((F.col("failed") > 0) & (F.col("written") == 0), "failed").when(F.col("failed") > 0, "partial").when(F.col("written") > 0, "done").otherwise("nothing_new")
    return counts.withColumn("status", status)
