"""Change plans in stages: companies, then their people, then notes, tasks and deals that refer to both.

Records that are still to be made have a stable stand-in for their id, drawn from
what makes them one record, so that later stages can refer to them and a second
reading of the same files refers to the same.  Nothing here writes: :func:`plan`
says what to do, :func:`applied` is the target after it, and a plan against that
target has nothing left to do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_key, person_key
from ..sources.shared import stored

PLAN = "stage int, kind string, action string, ref string, company string, contact string, fields map<string,string>, phones array<string>, emails array<string>, stamp string"


@dataclass(frozen=True)
class State:
    """What the target holds: ``companies`` (``id, name, fields``), ``contacts`` (``id, company, name, phones, emails``), ``records`` (``id, kind, company, contact, fields, stamp``)."""

    companies: DataFrame
    contacts: DataFrame
    records: DataFrame


@dataclass(frozen=True)
class Wanted:
    """What was read.

    ``companies``: ``key, names`` (the first is the one to show), ``fields``.
    ``contacts``: ``key, company_key, name, phones, emails``.  ``records``: ``id``
    (of its source, the same whenever the file is read), ``kind, company_key,
    contact_key, fields, stamp``.  ``replace``: company fields that a new value
    replaces; others are only filled where they are blank.
    """

    companies: DataFrame
    contacts: DataFrame
    records: DataFrame
    replace: Sequence[str] = ()


def stand_in(kind: str, *parts: Column) -> Column:
    """An id for a record that the target does not have yet."""
    return F.concat(F.lit(f"new:{kind}:"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 24))


def _entries(fields: Column) -> Column:
    """What can be compared: maps cannot."""
    return F.sort_array(F.map_entries(F.map_filter(fields, lambda _, v: v.isNotNull())))


def company_refs(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """``key, ref, name, is_new``: the company of the target that has one of the names, the first name before the others; else a stand-in for the first name."""
    named = wanted.select("key", F.posexplode("names").alias("at", "name")).withColumn("fold", fold_key(F.col("name"))).where("fold <> ''")
    known = held.select(F.col("id"), fold_key(F.col("name")).alias("fold")).groupBy("fold").agg(F.min("id").alias("id"))
    met = named.join(known, "fold", "left").groupBy("key").agg(F.min_by("id", F.when(F.col("id").isNotNull(), F.col("at"))).alias("id"), F.min_by("name", "at").alias("name"), F.min_by("fold", "at").alias("fold"))
    return met.select("key", F.coalesce("id", stand_in("company", F.col("fold"))).alias("ref"), "name", F.col("id").isNull().alias("is_new"))


def contact_refs(wanted: DataFrame, companies: DataFrame, held: DataFrame) -> DataFrame:
    """``key, ref, company, name, phones, emails, is_new``: the person of that name at the company, else the one with one of the numbers; else a stand-in.  People of companies that are not wanted are left out."""
    rows = wanted.join(companies.select(F.col("key").alias("company_key"), F.col("ref").alias("company")), "company_key").withColumn("person", person_key(F.col("name")))
    here = held.select("id", "company", person_key(F.col("name")).alias("person"), "phones")
    by_name = here.groupBy("company", "person").agg(F.min("id").alias("by_name"))
    by_phone = here.select("company", "id", F.explode("phones").alias("phone")).groupBy("company", "phone").agg(F.min("id").alias("by_phone"))
    called = rows.select("key", "company", F.posexplode("phones").alias("at", "phone")).join(by_phone, ["company", "phone"]).groupBy("key").agg(F.min_by("by_phone", "at").alias("by_phone"))
    found = rows.join(by_name, ["company", "person"], "left").join(called, "key", "left").withColumn("id", F.coalesce("by_name", "by_phone"))
    return found.select("key", F.coalesce("id", stand_in("contact", F.col("company"), F.col("person"))).alias("ref"), "company", "name", "phones", "emails", F.col("id").isNull().alias("is_new"))


def plan(wanted: Wanted, held: State) -> DataFrame:
    """Rows of :data:`PLAN`.

    Stage 1, companies: ``create``, ``patch`` (blank fields, and those to be
    replaced), ``conflict`` (a value that differs, left as it is), ``same``.  Stage
    2, contacts: ``create``, ``extend`` (numbers and addresses not held yet),
    ``same``.  Stage 3, records: ``create``, ``update``, ``newer`` (the target has a
    later stamp), ``same``, ``orphan`` (its company is not among the wanted).
    Several keys that mean one record are one row; their values are taken together,
    of two values of a field the least.  What the companies and people are is written
    once, since each later stage refers to it.
    """
    none = F.lit(None).cast("string")
    empty, no_fields = F.array().cast("array<string>"), F.create_map().cast("map<string,string>")
    row = lambda df, stage, kind, action, ref, company=none, contact=none, fields=no_fields, phones=empty, emails=empty, stamp=none: df.select(
        F.lit(stage).alias("stage"), kind.alias("kind"), action.alias("action"), ref.alias("ref"), company.alias("company"), contact.alias("contact"), fields.alias("fields"), phones.alias("phones"), emails.alias("emails"), stamp.alias("stamp")
    )
    refs = stored(company_refs(wanted.companies, held.companies), "company-refs")
    said = wanted.companies.join(refs, "key").select("ref", "is_new", "name", F.explode_outer("fields").alias("field", "value"))
    one = said.groupBy("ref", "is_new", "field").agg(F.min("value").alias("value"), F.min("name").alias("name"))
    has = held.companies.select(F.col("id").alias("ref"), F.explode("fields").alias("field", "have")).where("have is not null")
    both = one.join(has, ["ref", "field"], "left")
    fresh, differs = F.col("value").isNotNull() & F.col("have").isNull(), F.col("value").isNotNull() & F.col("have").isNotNull() & (F.col("value") != F.col("have"))
    replaced = F.col("field").isin(*wanted.replace) if wanted.replace else F.lit(False)
    write = fresh | (differs & replaced)
    listed = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(c, F.struct("field", "value")))))
    merged = both.groupBy("ref", "is_new").agg(F.min("name").alias("name"), listed(write).alias("patch"), listed(differs & ~replaced).alias("clash"))
    state = F.when(F.col("is_new"), "create").when(F.size("patch") > 0, "patch").otherwise("same")
    named = F.when(F.col("is_new"), F.map_concat("patch", F.create_map(F.lit("name"), F.col("name")))).otherwise(F.col("patch"))
    out = row(merged, 1, F.lit("company"), state, F.col("ref"), fields=named)
    out = out.unionByName(row(merged.where("size(clash) > 0 and not is_new"), 1, F.lit("company"), F.lit("conflict"), F.col("ref"), fields=F.col("clash")))

    people = stored(contact_refs(wanted.contacts, refs, held.contacts), "contact-refs")
    each = people.groupBy("ref", "company", "is_new").agg(
        F.min("name").alias("name"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("phones")))).alias("phones"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("emails")))).alias("emails"),
    )
    have = held.contacts.select(F.col("id").alias("ref"), F.col("phones").alias("held_phones"), F.col("emails").alias("held_emails"))
    each = each.join(have, "ref", "left")
    more = lambda c: F.array_except(c, F.coalesce(f"held_{c}", empty))
    changed = (F.size(more("phones")) > 0) | (F.size(more("emails")) > 0)
    what = F.when(F.col("is_new"), "create").when(changed, "extend").otherwise("same")
    out = out.unionByName(row(each, 2, F.lit("contact"), what, F.col("ref"), F.col("company"), fields=F.when(F.col("is_new"), F.create_map(F.lit("name"), F.col("name"))).otherwise(no_fields), phones=more("phones"), emails=more("emails")))

    whose = refs.select(F.col("key").alias("company_key"), F.col("ref").alias("company"))
    who = people.select(F.col("key").alias("contact_key"), F.col("ref").alias("contact"))
    # Fields meet what is held first (and are compared only there); keys and the answer are moved on to the companies and people.  Records of nobody have no key to meet people on.
    old = held.records.select("id", F.struct("company", "contact").alias("h"), F.col("fields").alias("held_fields"), F.col("stamp").alias("held_stamp"))
    notes = wanted.records.join(old, "id", "left")
    alike = F.when(F.col("h").isNotNull(), _entries(F.col("fields")).eqNullSafe(_entries(F.col("held_fields"))))
    notes = notes.select("id", "kind", "company_key", "contact_key", "fields", "stamp", "h", alike.alias("alike"), (F.col("held_stamp") > F.col("stamp")).alias("later"))
    notes = notes.join(whose, "company_key", "left")
    nobody = notes.where("contact_key is null").withColumn("contact", none)
    notes = notes.where("contact_key is not null").join(who, "contact_key", "left").unionByName(nobody)
    same = F.col("alike") & F.struct("company", "contact").eqNullSafe(F.col("h"))
    decided = F.when(F.col("company").isNull(), "orphan").when(F.col("h").isNull(), "create").when(same, "same").when(F.col("later"), "newer").otherwise("update")
    return out.unionByName(row(notes, 3, F.col("kind"), decided, F.col("id"), F.col("company"), F.col("contact"), F.col("fields"), stamp=F.col("stamp")))


def applied(plan_: DataFrame, held: State) -> State:
    """The target after the plan; stand-ins are the ids of what was made.  A target that gives ids of its own puts them in their place with :func:`with_ids`."""
    empty = F.array().cast("array<string>")
    done = plan_.where("action in ('create', 'patch', 'extend', 'update')")
    patches = done.where("kind = 'company' and action = 'patch'").select(F.col("ref").alias("id"), F.col("fields").alias("p"))
    kept = lambda: F.map_filter("fields", lambda k, _: F.col("p").isNull() | ~F.array_contains(F.map_keys("p"), k))
    companies = held.companies.join(patches, "id", "left").select("id", "name", F.when(F.col("p").isNull(), F.col("fields")).otherwise(F.map_concat(kept(), "p")).alias("fields"))
    made = done.where("kind = 'company' and action = 'create'").select(F.col("ref").alias("id"), F.col("fields")["name"].alias("name"), F.map_filter("fields", lambda k, _: k != "name").alias("fields"))
    more = done.where("kind = 'contact' and action = 'extend'").select(F.col("ref").alias("id"), F.col("phones").alias("p"), F.col("emails").alias("e"))
    grown = held.contacts.join(more, "id", "left").select("id", "company", "name", F.concat("phones", F.coalesce("p", empty)).alias("phones"), F.concat("emails", F.coalesce("e", empty)).alias("emails"))
    people = done.where("kind = 'contact' and action = 'create'").select(F.col("ref").alias("id"), "company", F.col("fields")["name"].alias("name"), "phones", "emails")
    notes = done.where("stage = 3").select(F.col("ref").alias("id"), "kind", "company", "contact", "fields", "stamp")
    left = held.records.join(notes.select("id"), "id", "left_anti").select("id", "kind", "company", "contact", "fields", "stamp")
    return State(companies.unionByName(made), grown.unionByName(people), left.unionByName(notes))


def with_ids(rows: DataFrame, given: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with the target's ids (``given``: ``stand_in, id``) in the place of stand-ins."""
    order = rows.columns
    for c in columns:
        rows = rows.join(given.select(F.col("stand_in").alias(c), F.col("id").alias("given__")), c, "left").withColumn(c, F.coalesce("given__", c)).drop("given__")
    return rows.select(*order)


def counts(plan_: DataFrame) -> DataFrame:
    """``stage, kind, action, n``: the preview that a person sees before a commit."""
    return plan_.groupBy("stage", "kind", "action").agg(F.count("*").alias("n"))


# ---- families: what each reads, as wanted records


def _map(**fields: Column) -> Column:
    """Fields by name, without those that are null."""
    return F.map_filter(F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), c.cast("string"))]), lambda _, v: v.isNotNull())


def _none(spark, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


_CONTACTS = "key string, company_key string, name string, phones array<string>, emails array<string>"
_RECORDS = "id string, kind string, company_key string, contact_key string, fields map<string,string>, stamp string"


def visits(rows: DataFrame) -> Wanted:
    """Visits (``visit_id, customer, city, potential, person, phone, email, day, purpose, step, due, cutoff``): companies, people, one note a visit, and a task for each next step, done if due before the cutoff."""
    listed = lambda c: F.array_compact(F.array(c))
    rows = rows.select("visit_id", "customer", "city", "potential", "person", "phone", "email", "day", "purpose", "step", "due", "cutoff", fold_key(F.col("customer")).alias("company_key"))
    rows = rows.withColumn("contact_key", F.when(F.col("person").isNotNull(), F.concat_ws("\x1f", "company_key", person_key(F.col("person")))))
    rows = stored(rows, "visits")  # names are folded once, not by each use
    companies = rows.groupBy(F.col("company_key").alias("key")).agg(F.array(F.min_by("customer", F.struct("day", "visit_id"))).alias("names"), _map(city=F.max_by("city", F.when(F.col("city").isNotNull(), F.col("day"))), potential=F.max_by("potential", F.when(F.col("potential").isNotNull(), F.col("day")))).alias("fields"))
    contacts = rows.where("contact_key is not null").groupBy(F.col("contact_key").alias("key"), "company_key").agg(F.min("person").alias("name"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(listed(F.col("phone")))))).alias("phones"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(listed(F.col("email")))))).alias("emails"))
    record = lambda kind, fields, suffix="": F.struct(F.concat("visit_id", F.lit(suffix)).alias("id"), F.lit(kind).alias("kind"), fields.alias("fields"))
    note = record("note", _map(day=F.col("day"), purpose=F.col("purpose")))
    done = F.when(F.col("due") < F.col("cutoff"), "done").otherwise("open")
    task = F.when(F.col("step").isNotNull(), record("task", _map(text=F.col("step"), due=F.col("due"), state=done), "#step"))
    records = rows.select(F.explode(F.array(note, task)).alias("r"), "company_key", "contact_key", F.col("day").cast("string").alias("stamp")).where("r is not null")
    return Wanted(stored(companies, "companies"), stored(contacts, "contacts"), records.select("r.id", "r.kind", "company_key", "contact_key", "r.fields", "stamp"))


def accounts(rows: DataFrame) -> Wanted:
    """Records of customer lists (``code, cn, en, province, city, industry, contact, phone, email, notes``): companies with the other language's name, people, and a note for each remark."""
    spark = rows.sparkSession
    name = F.coalesce("cn", "en")
    rows = rows.where(name.isNotNull()).withColumn("company_key", F.coalesce(F.concat(F.lit("code:"), "code"), fold_key(name))).withColumn("shown", name)
    fields = {c: F.min(c) for c in ("code", "province", "city", "industry")}
    companies = rows.groupBy(F.col("company_key").alias("key")).agg(F.array_distinct(F.concat(F.array(F.min("shown")), F.array_sort(F.collect_set("en")))).alias("names"), _map(**fields, other_name=F.when(F.min("cn").isNotNull(), F.min("en"))).alias("fields"))
    contacts = rows.where("contact is not null").withColumn("key", F.concat_ws("\x1f", "company_key", person_key(F.col("contact"))))
    one = lambda c: F.array_sort(F.collect_set(c))
    contacts = contacts.groupBy("key", "company_key").agg(F.min("contact").alias("name"), one("phone").alias("phones"), one("email").alias("emails"))
    notes = rows.select("company_key", F.explode("notes").alias("text")).distinct()
    notes = notes.select(F.concat(F.lit("account:"), F.sha2(F.concat_ws("\x1f", "company_key", "text"), 256)).alias("id"), F.lit("note").alias("kind"), "company_key", F.lit(None).cast("string").alias("contact_key"), _map(text=F.col("text")).alias("fields"), F.lit(None).cast("string").alias("stamp"))
    return Wanted(companies, contacts if contacts.columns else _none(spark, _CONTACTS), notes)


def receivables(rows: DataFrame) -> Wanted:
    """Balances (``customer, currency, open_amount, overdue, as_of``): company fields that each newer list replaces; only dated ones in ``CNY``."""
    spark = rows.sparkSession
    usable = rows.where("as_of is not null and currency = 'CNY'").withColumn("key", fold_key(F.col("customer")))
    last = usable.groupBy("key").agg(F.max_by(F.struct("customer", "open_amount", "overdue", "as_of"), "as_of").alias("l"))
    companies = last.select("key", F.array("l.customer").alias("names"), _map(open_amount=F.col("l.open_amount"), overdue=F.col("l.overdue"), as_of=F.col("l.as_of")).alias("fields"))
    return Wanted(companies, _none(spark, _CONTACTS), _none(spark, _RECORDS), ("open_amount", "overdue", "as_of"))


def quotes(rows: DataFrame) -> Wanted:
    """Quotes (``quote_no, company, total, state, quoted, remark``): a deal each, and a note for each remark."""
    spark = rows.sparkSession
    rows = rows.withColumn("company_key", fold_key(F.col("company")))
    companies = rows.groupBy(F.col("company_key").alias("key")).agg(F.array(F.min("company")).alias("names"), F.create_map().cast("map<string,string>").alias("fields"))
    record = lambda part, kind, fields, suffix="": part.select(F.concat(F.lit("quote:"), "quote_no", F.lit(suffix)).alias("id"), F.lit(kind).alias("kind"), "company_key", F.lit(None).cast("string").alias("contact_key"), fields.alias("fields"), F.col("quoted").cast("string").alias("stamp"))
    deals = record(rows, "deal", _map(total=F.col("total"), state=F.col("state")))
    return Wanted(companies, _none(spark, _CONTACTS), deals.unionByName(record(rows.where("remark is not null"), "note", _map(text=F.col("remark")), "#remark")))


def todos(rows: DataFrame) -> Wanted:
    """To-dos (``todo_id, customer, text, due, state, stamp``): a task each, for companies that they name; the newest row of an id counts."""
    spark = rows.sparkSession
    rows = rows.withColumn("company_key", fold_key(F.col("customer")))
    last = rows.groupBy("todo_id").agg(F.max_by(F.struct("company_key", "customer", "text", "due", "state", "stamp"), F.struct("stamp", "text")).alias("l")).select("todo_id", "l.*")
    companies = last.where("company_key <> ''").groupBy(F.col("company_key").alias("key")).agg(F.array(F.min("customer")).alias("names"), F.create_map().cast("map<string,string>").alias("fields"))
    tasks = last.select(F.concat(F.lit("todo:"), "todo_id").alias("id"), F.lit("task").alias("kind"), "company_key", F.lit(None).cast("string").alias("contact_key"), _map(text=F.col("text"), due=F.col("due"), state=F.col("state")).alias("fields"), F.col("stamp").cast("string").alias("stamp"))
    return Wanted(companies, _none(spark, _CONTACTS), tasks)
