"""Records to what they belong to: by domain, number, name or a phrase in a text.

Every lookup is a join on equal keys; a test for "ends with" or "contains" runs
only on pairs that share such a key.  Nothing is guessed: two targets are no target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import emails, similarity
from ..functions.text import CJK, company_key, person_key

#: Words of a company's name that say nothing about which one it is.
FORM_WORDS = ("co", "ltd", "inc", "llc", "gmbh", "corp", "company", "limited", "corporation")


def by_domain(rows: DataFrame, key: str, domain: str, known: DataFrame, name: str) -> DataFrame:
    """``key, name``: the longest known domain that ``domain`` equals or lies below."""
    spread = rows.select(key, F.posexplode(emails.domain_suffixes(F.lower(domain))).alias("pos", name))
    return spread.join(known.select(name).distinct(), name).groupBy(key).agg(F.min_by(name, "pos").alias(name))


def by_label(parties: DataFrame, party: str, labels: DataFrame, label: str, least: int = 4) -> DataFrame:
    """``party, label``: every label of ``least`` characters or more that a party's folded name holds.

    Pairs meet on the label's first ``least`` characters, so no party is held against every label.
    """
    folded = F.regexp_replace(F.lower(party), "[^a-z0-9]", "")
    names = parties.select(party).where(F.col(party).isNotNull()).distinct().withColumn("folded", folded)
    plain = F.regexp_replace(F.lower(label), "[^a-z0-9]", "")
    short = labels.select(label).distinct().withColumn("plain", plain).where(F.length("plain") >= least).withColumn("gram", F.substring("plain", 1, least))
    spread = names.select(party, "folded", F.explode(similarity.grams(F.col("folded"), least)).alias("gram"))
    return spread.join(short, "gram").where(F.col("folded").contains(F.col("plain"))).select(party, label).distinct()


def prioritised(rows: DataFrame, key: str, tries: Sequence[tuple[str, DataFrame, str]], target: str) -> DataFrame:
    """``key, target, nth``: the target of the first try that finds exactly one.

    A try is ``(column of rows, table, its column)``: a code first, then a name, say.
    """
    spread = None
    for k, (column, table, other) in enumerate(tries):
        one = table.where(F.col(other).isNotNull()).groupBy(other).agg(F.count_distinct(target).alias("targets__"), F.min(target).alias(target)).where("targets__ = 1")
        part = rows.select(key, F.col(column).alias(other)).join(one, other).select(key, F.lit(k).alias("nth"), target)
        spread = part if spread is None else spread.unionByName(part)
    best = spread.groupBy(key).agg(F.min(F.struct("nth", target)).alias("m"))
    return rows.select(key).join(best, key, "left").select(key, f"m.{target}", "m.nth")


def by_mobile(wanted: DataFrame, held: DataFrame, company: str, person: str, phones: str, contact: str) -> DataFrame:
    """``company, person, contact``: the contact that the company already holds with one of a person's mobile numbers; landlines are switchboards and never match."""
    mobile = lambda df, who: df.select(company, who, F.posexplode(phones).alias("pos", "phone")).where(F.col("phone").rlike(r"^\+861[3-9]\d{9}$"))
    first = mobile(held, contact).groupBy(company, "phone").agg(F.min(contact).alias(contact))
    return mobile(wanted, person).join(first, [company, "phone"]).groupBy(company, person).agg(F.min_by(contact, "pos").alias(contact))


def real_addresses(seen: DataFrame, name: str, address: str) -> DataFrame:
    """``name, address, resolved``: an address that is none takes the one its name has most often elsewhere; the least of equals, null if there is none."""
    real = F.col(address).rlike("^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{2,}$") & ~F.lower(address).startswith("imceaex-")
    rows = seen.select(name, address).distinct().withColumn("real", F.coalesce(real, F.lit(False))).withColumn("who", F.nullif(person_key(F.col(name)), F.lit("")))
    votes = seen.where(real).select(person_key(F.col(name)).alias("who"), F.lower(address).alias("found")).groupBy("who", "found").agg(F.count("*").alias("n"))
    best = votes.groupBy("who").agg(F.min_by("found", F.struct((-F.col("n")).alias("n"), "found")).alias("found"))
    return rows.join(best, "who", "left").select(name, address, F.when(F.col("real"), F.lower(address)).otherwise(F.col("found")).alias("resolved"))


def phrases(text: Column, letters: int = 4) -> Column:
    """What may name a company in a text: one to four words from a capital or digit on, runs of four CJK characters and the nine before a company's legal form."""
    words = F.filter(F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z0-9][A-Za-z0-9&.'-]*"), F.lit(0)), lambda w: F.regexp_replace(w, "^[.'-]+|[.'-]+$", "")), lambda w: w != "")
    last = F.size(words)
    windows = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.when(i + n - 1 <= last, F.array_join(F.slice(words, i, n), " ")))))
    latin = F.filter(windows, lambda p: p.rlike("^[A-Z0-9]") & (F.length(F.regexp_replace(p, "[^A-Za-z]", "")) >= letters))
    runs = F.regexp_extract_all(text, F.lit(f"[{CJK}]{{4,}}"), F.lit(0))
    ends = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(0), F.lit(8)), lambda k: F.regexp_extract(r, f"^[{CJK}]{{0,}}?(?=公司)", 0).substr(k + 1, F.lit(40)))))
    named = F.transform(F.filter(ends, lambda e: F.length(e) >= 2), lambda e: F.concat(e, F.lit("公司")))
    return F.array_distinct(F.concat(latin, runs, named))


def company_in_text(rows: DataFrame, key: str, text: str, names: DataFrame, name: str, code: str) -> DataFrame:
    """``key, code, state``: the one company that a text names; ``ambiguous`` for several, ``none`` for none.  Distinct phrases are folded once."""
    spread = rows.select(key, F.explode(phrases(F.col(text))).alias("phrase"))
    folded = spread.select("phrase").distinct().withColumn("folded", company_key(F.col("phrase"))).where("folded <> ''")
    known = names.select(company_key(F.col(name)).alias("folded"), code).where("folded <> ''").groupBy("folded").agg(F.count_distinct(code).alias("n"), F.min(code).alias(code)).where("n = 1")
    hits = spread.join(folded.join(known, "folded").select("phrase", code), "phrase").groupBy(key).agg(F.count_distinct(code).alias("hits"), F.min(code).alias("one"))
    state = F.when(F.col("hits").isNull(), "none").when(F.col("hits") == 1, "unique").otherwise("ambiguous")
    return rows.select(key).join(hits, key, "left").select(key, F.when(F.col("hits") == 1, F.col("one")).alias(code), state.alias("state"))


def name_words(name: Column) -> Column:
    """``word, short`` for each word that identifies a company; ``short`` if it was written with a full stop."""
    parts = F.filter(F.split(F.regexp_replace(name, ",", " "), "\\s+"), lambda w: w != "")
    words = F.transform(parts, lambda w: F.struct(F.regexp_replace(F.lower(w), "[^\\p{L}\\p{N}]", "").alias("word"), w.endswith(".").alias("short")))
    return F.filter(words, lambda w: (w["word"] != "") & ~w["word"].isin(*FORM_WORDS))


def short_names(rows: DataFrame, key: str, name: str, city: str, person: str) -> DataFrame:
    """``key, company, why``: every way a row writes a company, to one company.

    A name of two words or more, none abbreviated, or four CJK characters, is its
    own company.  A short one takes a full name that starts with its words if just
    one of those in the row's city knows the row's person, else is the only one in
    that city, else, without a city, the only one.  What is left is a company of
    its own, named by its first word and city.
    """
    at = rows.select(key, F.col(name).alias("name"), F.nullif(F.trim(city), F.lit("")).alias("city"), F.nullif(F.lower(F.trim(person)), F.lit("")).alias("person"), name_words(F.col(name)).alias("w"))
    at = at.withColumn("id", F.array_join(F.transform("w", lambda x: x["word"]), ":")).withColumn("first", F.get("w", 0)["word"])
    full = (F.size("w") >= 2) & ~F.exists("w", lambda x: x["short"]) | ((F.size("w") == 1) & F.col("first").rlike(f"^(?=.*[{CJK}]).{{4,}}$"))
    at = at.withColumn("full", F.coalesce(full, F.lit(False)))
    written = at.where("full and size(w) >= 2")
    homes = written.where("city is not null").groupBy("id", "city").agg(F.count("*").alias("n")).groupBy("id").agg(F.min_by("city", F.struct((-F.col("n")).alias("n"), "city")).alias("home"))
    names = written.groupBy("first", "id").agg(F.first("w").alias("full_w")).join(homes, "id", "left")
    met = written.where("person is not null").select(F.col("id").alias("met_id"), F.col("person").alias("met_person")).distinct()
    short = at.where("not full and size(w) > 0").select(key, "first", "city", "person", "w")
    fits = (F.size("w") <= F.size("full_w")) & F.forall(F.zip_with("w", F.slice("full_w", F.lit(1), F.size("w")), lambda a, b: (a["word"] == b["word"]) | (a["short"] & b["word"].startswith(a["word"]))), lambda x: x)
    pairs = short.join(names, "first").where(fits).join(met, (F.col("id") == F.col("met_id")) & (F.col("person") == F.col("met_person")), "left")
    local = F.col("city").isNull() | F.coalesce(F.col("home") == F.col("city"), F.lit(False))
    found = pairs.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(local).alias("n_city"), F.count_if(local & F.col("met_id").isNotNull()).alias("n_met"),
        F.min("id").alias("any_id"), F.min(F.when(local, F.col("id"))).alias("city_id"), F.min(F.when(local & F.col("met_id").isNotNull(), F.col("id"))).alias("known_id"),
    )
    out = at.select(key, "name", "id", "first", "city", "full").join(found, key, "left")
    own = F.concat_ws("@", F.coalesce("first", F.lower(F.trim("name"))), F.lower(F.coalesce("city", F.lit(""))))
    why = F.when(F.col("full"), "written out").when(F.col("n").isNull(), "no full name starts this way").when(F.col("n_met") == 1, "same contact").when(F.col("city").isNotNull() & (F.col("n_city") == 1), "same city")
    why = why.when(F.col("city").isNull() & (F.col("n") == 1), "only candidate").when(F.col("city").isNotNull() & (F.col("n_city") == 0), "separate: none in this city").otherwise("separate: ambiguous")
    company = F.when(F.col("full"), F.col("id")).when(why == "same contact", F.col("known_id")).when(why == "same city", F.col("city_id")).when(why == "only candidate", F.col("any_id")).otherwise(own)
    return out.select(key, company.alias("company"), why.alias("why"))


def run_together(people: DataFrame, company: str, name: str) -> DataFrame:
    """``company, name, full_name``: ``zhangwei`` is ``wei zhang`` where just one person of the company is called so."""
    words = F.filter(F.split(F.lower(name), "[^\\p{L}]+"), lambda w: w != "")
    rows = people.select(company, name, words.alias("w")).distinct()
    pairs = rows.where("size(w) = 2").select(company, F.col(name).alias("full_name"), F.explode(F.array(F.concat(F.get("w", 0), F.get("w", 1)), F.concat(F.get("w", 1), F.get("w", 0)))).alias("glued"))
    one = pairs.groupBy(company, "glued").agg(F.count_distinct("full_name").alias("n"), F.min("full_name").alias("full_name")).where("n = 1")
    return rows.where("size(w) = 1").withColumn("glued", F.get("w", 0)).join(one, [company, "glued"]).select(company, name, "full_name")


def search(companies: DataFrame, query: str, code: str, name: str, most: int = 8) -> DataFrame:
    """``code, name, score``: the ``most`` companies that look most like what a person typed; a report."""
    typed = F.lit(query)
    rows = companies.select(code, name).withColumn("q", company_key(typed)).withColumn("k", company_key(F.col(name))).where("q <> '' and k <> ''")
    inside = F.when(F.col("k").contains(F.col("q")), 90 + 10 * F.length("q") / F.length("k"))
    exact = F.when(F.lower(F.ltrim(F.col(code).cast("string"), F.lit("0"))) == F.lower(F.ltrim(typed, F.lit("0"))), F.lit(100.0))
    close = F.when(F.length("q") >= 5, similarity.partial_ratio("q", "k"))
    score = F.greatest(exact, inside, F.when(close >= 85, close * 0.85))
    return rows.select(code, name, score.alias("score")).where("score >= 70").orderBy(F.desc("score"), code, name).limit(most)
