"""Two forms of visit sheets beside the weekly one: a fixed layout, and trip reports with a table of items.

Cells come as in ``sources.workbook`` (``file, sheet, row, col, text`` and, for the fixed
layout, ``fill``).  A sheet that lacks what its form needs is a review row, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import customers, dates
from ..functions.text import cell_text, label_key
from . import blocks, headers
from .headers import SHEET

WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
FILLS = {"00B050": "green", "92D050": "green", "FFFF00": "yellow"}
#: Columns of the fixed layout, from the first.
FIXED = ("date_raw", "city", "customer", "potential", "kind", "contact", "phone", "office_phone", "email", "purpose")
EVENTS = r"(?i)\b(?:exhibition|expo|fair|show|trip)\b|展会|展览"
ITEMS = {"id": ["id"], "typ": ["typ"], "date": ["date"], "from_person": ["from"], "topic": ["general topic"], "details": ["details"], "due": ["wv"], "who": ["wer"], "state": ["status"]}


def _tidy(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", cell_text(F.col("text"))).where("text is not null")


def _highlight(fill: Column) -> Column:
    out = F.lit(None).cast("string")
    for colour, name in FILLS.items():
        out = F.when(F.upper(F.right(fill, F.lit(6))) == colour, name).otherwise(out)
    return out


def fixed_layout(cells: DataFrame, year: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(visits, weeks, review)`` of sheets with ``Date`` in column A and the week in the sheet's name.

    A filled cell in column A starts a visit; notes stand in column K, their
    deadlines in L, and a fill marks a note.  Above the header lie the plan of each weekday and a
    summary.  ``year`` is made from ``file``.
    """
    tidy = _tidy(cells)
    week = F.regexp_extract("sheet", r"(?i)(?:cw|kw|week)\s*0*(\d{1,2})", 1).try_cast("int")
    heads = tidy.where((F.col("col") == 1) & (F.col("row") < 20) & (F.lower("text") == "date")).groupBy(*SHEET).agg(F.min("row").alias("header_row"))
    sheets = cells.select(*SHEET).distinct().join(heads, list(SHEET), "left").withColumn("week", week).withColumn("year", year)
    reason = F.when(F.col("header_row").isNull(), "no date header").when(F.col("week").isNull(), "no week in the sheet's name")
    review = sheets.select(*SHEET, reason.alias("reason")).where("reason is not null")
    good = sheets.where("header_row is not null and week is not null")
    owner = tidy.where("row = 1 and col = 2").select(*SHEET, F.col("text").alias("owner"))
    inside = tidy.join(good, list(SHEET))
    body = inside.where("row > header_row and col <= 12").groupBy(*SHEET, "row", "year", "week").agg(
        *[F.max(F.when(F.col("col") == k, F.col("text"))).alias(name) for k, name in enumerate(FIXED, 1)],
        F.max(F.when(F.col("col") == 11, F.struct("text", _highlight(F.col("fill")).alias("highlight")))).alias("note"),
        F.max(F.when(F.col("col") == 12, F.col("text"))).alias("deadline"),
    )
    numbered = blocks.block_numbers(body, SHEET, [F.col("row")], F.col("date_raw").isNotNull()).where("block > 0")
    note = F.when(F.col("note").isNotNull(), F.struct("row", F.col("note.text").alias("text"), F.col("note.highlight").alias("highlight"), "deadline"))
    # A visit's rows are those of its block; the first one holds its fields.
    visits = numbered.groupBy(*SHEET, "block", "year", "week").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), *[F.min_by(name, "row").alias(name) for name in FIXED], F.array_sort(F.collect_list(note)).alias("notes"),
    )
    day = F.coalesce(dates.visit_date(F.col("date_raw"), F.col("year")), dates.general_date(F.col("date_raw"), dates.week_monday(F.col("year"), F.col("week")), F.col("year"))["day"])
    visits = visits.withColumn("day", day).join(owner, list(SHEET), "left")
    visits = blocks.ordinals(visits, [*SHEET, F.coalesce(F.col("day").cast("string"), "date_raw")], [F.col("first_row")], "order_in_day").drop("block")
    above = inside.where("row < header_row")
    offset = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.lower(F.substring("text", 1, 3)))
    plans = above.where("col = 2").select(*SHEET, "row", F.col("text").alias("plan"))
    days = above.where("col = 1").withColumn("at", offset).where("at > 0").join(plans, [*SHEET, "row"], "left")
    planned = F.struct(F.date_add(dates.week_monday(F.col("year"), F.col("week")), (F.col("at") - 1).cast("int")).alias("day"), F.coalesce("plan", F.lit("")).alias("plan"))
    days = days.groupBy(*SHEET).agg(F.array_sort(F.collect_list(planned)).alias("days"))
    lines = blocks.ordered_list(above.where("col = 10 and row > 1"), SHEET, F.col("row"), "text", "summary")
    empty = lambda name, of: F.coalesce(name, F.array().cast(of.schema[name].dataType)).alias(name)
    weeks = good.join(owner, list(SHEET), "left").join(days, list(SHEET), "left").join(lines, list(SHEET), "left")
    weeks = weeks.select(*SHEET, "owner", "year", "week", dates.week_monday(F.col("year"), F.col("week")).alias("monday"), empty("days", days), empty("summary", lines))
    return visits, weeks, review


def participants(cells: DataFrame, most: int = 20) -> DataFrame:
    """``file, sheet, people``: name, role and company of the rows from the label ``Participants`` on, up to the first row without a name."""
    at = cells.where(label_key(F.col("text")) == "participants").groupBy(*SHEET).agg(F.min(F.struct("row", "col")).alias("at"))
    right = cells.join(at, list(SHEET)).where((F.col("row") >= F.col("at.row")) & (F.col("row") <= F.col("at.row") + most) & (F.col("col") > F.col("at.col")))
    rows = right.groupBy(*SHEET, "row", F.col("at.row").alias("top")).agg(F.slice(F.array_sort(F.collect_list(F.struct("col", "text"))), 1, 2).alias("c"))
    # The list goes on while rows follow one another.
    unbroken = blocks.ordinals(rows, SHEET, [F.col("row")], "nth").where("row = top + nth")
    role = F.coalesce(F.get("c", 1)["text"], F.lit(""))
    person = F.struct("row", F.get("c", 0)["text"].alias("name"), role.alias("role"), customers.role_company(role).alias("company"))
    return unbroken.groupBy(*SHEET).agg(F.array_sort(F.collect_list(person)).alias("people"))


def _same_company(a: Column, b: Column) -> Column:
    key = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]", "")
    return (F.length(key(a)) >= 3) & (F.length(key(b)) >= 3) & (key(a).contains(key(b)) | key(b).contains(key(a)))


def trip_reports(cells: DataFrame, year: Column, people: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(visits, review)`` of trip reports: a form with a customer or an event, and one visit for each item of its table.

    The company stands in the item's topic, else in the form.  The contact is the
    first participant of that company, or the first of all if no participant names a
    company.  Rows below an item that start none belong to it.
    """
    tidy = _tidy(cells)
    form = headers.beside(tidy, "customer name").withColumnRenamed("value", "form_customer")
    words = headers.synonyms(cells.sparkSession, {f: [f"={w}" if w in ("id",) else w for w in ws] for f, ws in ITEMS.items()})
    found = headers.find_headers(tidy, words, 2, ["id", "topic"], most_rows=40)
    rows = headers.pivoted(tidy, found, list(ITEMS)).join(form, list(SHEET))
    rows = blocks.block_numbers(rows, SHEET, [F.col("row")], F.coalesce("topic", "date").isNotNull()).where("block > 0")
    listed = F.array_sort(F.collect_list(F.when(F.col("details").isNotNull(), F.struct("row", "details"))))
    head = [F.min_by(f, "row").alias(f) for f in ITEMS if f not in ("details", "state")]
    items = rows.groupBy(*SHEET, "block", "form_customer").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), *head, F.array_join(F.transform(listed, lambda d: d["details"]), "\n").alias("details"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("state").isNotNull(), F.struct("row", "state")))), lambda s: s["state"]), "\n").alias("state"),
    )
    items = items.join(participants(tidy), list(SHEET), "left").withColumn("year", year)
    named = F.regexp_extract("sheet", r"^\s*(\d{1,2})\.(\d{1,2})", 1), F.regexp_extract("sheet", r"^\s*(\d{1,2})\.(\d{1,2})", 2)
    of_sheet = dates.make_day(F.col("year"), named[0].try_cast("int"), named[1].try_cast("int"))
    read = dates.general_date(F.col("date"), F.make_date("year", F.lit(7), F.lit(1)), F.col("year"))
    items = items.withColumn("date_flag", read["flag"]).withColumn("day", F.coalesce(read["day"], of_sheet))
    topic_of = customers.topic_company(F.col("topic"))
    items = items.withColumn("customer", F.when(topic_of != "", topic_of).otherwise(F.col("form_customer")))
    event = F.when(F.col("form_customer").rlike(EVENTS), F.col("form_customer"))
    theirs = F.filter("people", lambda p: (p["company"] != "") & _same_company(p["company"], F.col("customer")))
    nobody_says = ~F.exists("people", lambda p: p["company"] != "")
    contact = F.coalesce(F.get(theirs, 0)["name"], F.when(nobody_says, F.get("people", 0)["name"]))
    spelled = lambda c: F.regexp_replace(c, r"[._\-]+", " ")
    owner = F.coalesce(F.nullif(customers.owner_of(spelled(F.col("from_person")), people), F.lit("")), F.nullif(customers.owner_of(spelled(F.col("who")), people), F.lit("")))
    due = F.coalesce(dates.decimal_due(F.col("due"), F.col("day")), dates.general_date(F.col("due"), F.col("day"))["day"], dates.deadline(F.col("due"), F.col("day")))
    task = F.when(F.col("due").isNotNull(), F.struct(F.concat(F.coalesce(F.nullif("topic", F.lit("")), "details"), F.lit(" (Wer: "), F.coalesce("who", F.lit("")), F.lit(")")).alias("text"), F.lit("green").alias("highlight"), due.alias("due")))
    said = F.when(F.col("details") != "", F.struct(F.col("details").alias("text"), F.lit(None).cast("string").alias("highlight"), F.lit(None).cast("date").alias("due")))
    out = items.select(
        *SHEET, "first_row", "last_row", "day", "customer", event.alias("event"), contact.alias("contact"), owner.alias("owner"), F.col("topic").alias("purpose"),
        F.array_compact(F.array(said, task)).alias("notes"), "people", "state", "typ", customers.row_kind(F.col("customer")).alias("kind"), "date_flag",
    )
    out = blocks.ordinals(out, [*SHEET, "day"], [F.col("first_row")], "order_in_day")
    why = F.array_compact(F.array(
        F.when(F.col("customer").isNull(), "no_customer"), F.when(F.col("day").isNull(), "no_date"), F.when(F.col("owner").isNull(), "no_owner"),
        F.when(F.col("date_flag").isin("ambiguous", "range"), F.concat("date_flag", F.lit("_date"))), F.when((F.size("people") > 0) & F.col("contact").isNull(), "participants"),
    ))
    return out, out.select(*SHEET, F.col("first_row").alias("row"), F.explode(why).alias("reason"))
