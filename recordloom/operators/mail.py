"""People and organisations behind a mail archive, and which of them matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import emails, phones
from ..functions.text import has_cjk, person_key
from .rollups import decision

#: Words that mark a mail as business of one kind or another.
EVIDENCE = {
    "inquiry": "(?i)\\b(?:inquiry|enquiry|rfq|request for quot|anfrage)|询价",
    "order": "(?i)\\b(?:purchase order|order confirmation|bestellung)|订单|合同",
    "bill": "(?i)\\b(?:invoice|payment|rechnung)|发票|付款",
    "service": "(?i)\\b(?:spare part|repair|service report|reklamation)|维修|备件",
    "shipment": "(?i)\\b(?:tracking|shipment|delivery note|lieferschein)|发货|物流",
}
ROLE_WORDS = "(?i)^(?:info|sales|service|office|contact|admin|support|hr|invoice|purchasing|marketing)\\d*$"
LEGAL_FORM = "(?i)\\b(?:co\\.?,?\\s*ltd\\.?|gmbh(?:\\s*&\\s*co\\.?\\s*kg)?|inc\\.?|llc|limited|corporation|s\\.?a\\.?|b\\.?v\\.?)\\s*$|(?:有限责任公司|股份有限公司|有限公司|集团)$"


def folder_class(path: Column) -> Column:
    """``company, kind, sent, topic`` of a folder path such as ``Customers/Delta/Offers``."""
    parts = F.filter(F.split(path, "[/\\\\]"), lambda p: p != "")
    low = F.lower(path)
    kind = F.when(low.rlike("supplier|lieferant|供应商"), "supplier").when(low.rlike("customer|kunde|客户"), "customer").when(low.rlike("dealer|händler|经销"), "dealer")
    at = F.array_position(F.transform(parts, lambda p: F.lower(p).rlike("^(?:customers?|suppliers?|dealers?|kunden|lieferanten|客户|供应商)$")), F.lit(True)).cast("int")
    return F.struct(F.when(at > 0, F.get(parts, at)).alias("company"), kind.alias("kind"), low.rlike("(?:^|/)(?:sent|gesendet|已发送)").alias("sent"), F.when(F.size(parts) > at + 1, F.element_at(parts, -1)).alias("topic"))


def evidence(mails: DataFrame, own_domains: list[str], mass: int = 8) -> DataFrame:
    """``key`` and its counters: one row for each organisation a mail goes to or comes from.

    A mail to ``mass`` outside domains or more counts as mass mail only, and an
    automated one as automated only.  Sums are aggregated on the map side.
    """
    people = F.array_distinct(F.filter(F.concat(F.coalesce(F.transform("recipients", lambda p: p["email"]), F.array().cast("array<string>")), F.coalesce(F.transform("copies", lambda p: p["email"]), F.array().cast("array<string>"))), lambda a: a.isNotNull()))
    outside = F.filter(people, lambda a: ~emails.org_domain(emails.domain_of(a)).isin(*own_domains))
    sent = emails.org_domain(emails.domain_of(F.col("sender.email"))).isin(*own_domains)
    rows = mails.select(
        "message_id", F.concat_ws("\n", "subject", "body").alias("text"), F.coalesce("bulk", F.lit(False)).alias("bulk"), F.coalesce(sent, F.lit(False)).alias("sent"), outside.alias("outside"),
        F.size(F.array_distinct(F.transform(outside, lambda a: emails.org_domain(emails.domain_of(a))))).alias("domains"), F.col("sender.email").alias("sender"),
    )
    keys = F.array_distinct(F.when(F.col("sent"), F.transform("outside", emails.key_of)).otherwise(F.array(emails.key_of(F.col("sender")))))
    each = rows.select("*", F.explode(keys).alias("key")).where("key is not null")
    is_mass, automated = F.col("domains") >= mass, F.col("bulk") | emails.is_role_box(F.coalesce("sender", F.lit("")))
    plain = ~is_mass & ~automated
    counts = [F.count_if(is_mass).alias("mass"), F.count_if(~is_mass & automated).alias("automated"), F.count_if(plain & F.col("sent")).alias("out"), F.count_if(plain & ~F.col("sent")).alias("in")]
    counts += [F.count_if(plain & F.col("text").rlike(pattern)).alias(name) for name, pattern in EVIDENCE.items()]
    return each.groupBy("key").agg(*counts)


def relevance(counters: DataFrame) -> DataFrame:
    """``keep, reason`` for each organisation: the first rule that holds decides."""
    rules = [
        (F.col("order") > 0, "keep: orders"), (F.col("inquiry") > 0, "keep: inquiries"), ((F.col("bill") > 0) & (F.col("out") > 0), "keep: invoices both ways"), (F.col("service") > 0, "keep: service"),
        ((F.col("automated") > 0) & (F.col("out") == 0) & (F.col("in") == 0), "drop: automated only"), ((F.col("mass") > 0) & (F.col("in") == 0), "drop: mass mail only"), ((F.col("out") >= 2) & (F.col("in") >= 2), "keep: correspondence"),
    ]
    out = counters.withColumn("verdict", decision(rules, "drop: no evidence"))
    return out.select(*counters.columns, F.col("verdict").startswith("keep").alias("keep"), F.substring_index("verdict", ": ", -1).alias("reason"))


def people(mails: DataFrame) -> DataFrame:
    """``email`` with its most frequent name, the one in CJK script, counts and first and last day."""
    seen = mails.select("date", F.explode(F.concat(F.array("sender"), F.coalesce("recipients", F.array()), F.coalesce("copies", F.array()))).alias("p"), F.col("sender.email").alias("by"))
    rows = seen.where("p.email is not null").select(F.lower("p.email").alias("email"), F.nullif(F.trim("p.name"), F.lit("")).alias("name"), "date", (F.col("p.email") == F.col("by")).alias("sent"))
    names = rows.where(F.col("name").isNotNull() & (F.lower("name") != F.col("email"))).groupBy("email", "name").agg(F.count("*").alias("n"), F.min("date").alias("first"))
    best = names.groupBy("email").agg(F.min_by("name", F.struct((-F.col("n")).alias("n"), "first", "name")).alias("name"), F.min_by("name", F.when(has_cjk(F.col("name")), F.struct((-F.col("n")).alias("n"), "name"))).alias("native_name"))
    counts = rows.groupBy("email").agg(F.count("*").alias("messages"), F.count_if("sent").alias("sent"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))
    return counts.join(best, "email", "left").withColumn("person_key", person_key(F.col("name"))).withColumn("role_box", F.substring_index("email", "@", 1).rlike(ROLE_WORDS))


def signature(text: Column) -> Column:
    """``phones, company, title`` from the last fifteen lines of a message."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    tail = F.slice(lines, F.greatest(F.size(lines) - 14, F.lit(1)), F.lit(15))
    numbers = F.array_compact(F.transform(F.flatten(F.transform(tail, phones.phone_chunks)), phones.mail_e164))
    company = F.filter(tail, lambda x: x.rlike(LEGAL_FORM) & (F.length(x) <= 80))
    title = F.filter(tail, lambda x: x.rlike("(?i)\\b(?:manager|engineer|director|buyer|purchas\\w*|sales|ceo|leiter\\w*|geschäftsführer)\\b|经理|工程师|总监") & (F.length(x) <= 60))
    return F.struct(F.array_distinct(numbers).alias("phones"), F.get(company, 0).alias("company"), F.get(title, 0).alias("title"))


def without_legal_form(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(name), LEGAL_FORM, ""))


def phone_owner(found: DataFrame, phone: str, person: str, company: str) -> DataFrame:
    """``phone, person``: who keeps a number.  Within one company all do; across companies the most frequent, and nobody on a tie."""
    counts = found.groupBy(phone, person, company).agg(F.count("*").alias("n"))
    totals = counts.groupBy(phone).agg(F.count_distinct(company).alias("companies"), F.max("n").alias("most"))
    leads = counts.join(totals, phone).withColumn("leads", F.col("n") == F.col("most"))
    alone = leads.where("leads").groupBy(phone).agg(F.count_distinct(company).alias("leading"))
    return leads.join(alone, phone).where((F.col("companies") == 1) | (F.col("leads") & (F.col("leading") == 1))).select(phone, person)


def message_company(mails: DataFrame, filed: str, contacts: DataFrame) -> DataFrame:
    """``message_id, company``: the folder's, else the most frequent among its contacts (``message_id, company``), the first name on a tie."""
    votes = contacts.groupBy("message_id", "company").agg(F.count("*").alias("n"))
    best = votes.groupBy("message_id").agg(F.min_by("company", F.struct((-F.col("n")).alias("n"), "company")).alias("voted"))
    return mails.join(best, "message_id", "left").select("message_id", F.coalesce(filed, "voted").alias("company"))


def grounded(facts: DataFrame, tokens: str, corpus: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: facts all of whose tokens occur in the corpus; equality on tokens, no scan for substrings."""
    words = corpus.select(F.explode(F.split(F.lower(text), "[^\\p{L}\\p{N}@.+-]+")).alias("token")).distinct()
    spread = facts.select("fact_id", F.explode(F.transform(tokens, lambda t: F.lower(t))).alias("token"))
    bad = spread.join(words, "token", "left_anti").groupBy("fact_id").agg(F.array_sort(F.collect_set("token")).alias("unknown"))
    return facts.join(bad, "fact_id", "left_anti"), facts.join(bad, "fact_id")


COUNTERS = (
    "filed", "filed_other", "mass", "automated", "out", "out_business", "we_buy", "bill", "in", "in_inquiry", "in_order", "purchase_folder", "logistics_folder",
    "product", "our_product", "service", "deal", "quoted", "quoted_inquiry",
)


def all_counters(mails: DataFrame, mass: int = 8) -> DataFrame:
    """``key`` and the nineteen ``COUNTERS`` of every organisation that mails go to, come from or quote.

    ``mails``: one row for each mail with ``outbound, own`` (sent by the mailbox's owner), ``automated``,
    ``keys`` (its partners), ``domains`` (outside domains on it), ``filed_key`` (the partner whose folder it
    lies in), ``filed`` (in any partner's folder), ``topic, supplier`` (of the folder), the word tests ``product,
    inquiry, deal, bill, our_po, order_ref, service, price``, and ``quoted``, an array of ``sender, keys, domains``.

    Mass mail counts as such and as filed only, automated mail likewise, an incoming
    bill that is about nothing else too.  Quoted senders count in business mail, and
    quoted recipients where the quoted mail went to three outside domains at most.
    """
    c = F.col
    flag = lambda x: F.coalesce(x, F.lit(False))
    mass_mail, automated = c("domains") >= mass, flag(c("automated")) & ~flag(c("outbound"))
    about = flag(c("product")) | flag(c("inquiry"))
    business = about | flag(c("deal"))
    live = ~mass_mail & ~automated
    out, bill = live & flag(c("outbound")), live & ~flag(c("outbound")) & flag(c("bill")) & ~about
    came = live & ~flag(c("outbound")) & ~bill
    said = out | came
    own_folder = F.coalesce(c("key") == c("filed_key"), F.lit(False))
    bought = c("topic").isin("Purchase", "Oder Confirmation") | (flag(c("supplier")) & c("topic").isNull())
    tests = {
        "filed": own_folder, "filed_other": flag(c("filed")) & ~own_folder, "mass": mass_mail, "automated": ~mass_mail & automated,
        "out": out, "out_business": out & business & flag(c("own")), "we_buy": out & flag(c("our_po")), "bill": bill, "in": came, "in_inquiry": came & about,
        "in_order": came & flag(c("order_ref")) & ~flag(c("our_po")),
        "purchase_folder": came & flag(bought) & (flag(c("deal")) | flag(c("our_po")) | flag(c("product")) | flag(c("price"))),
        "logistics_folder": came & flag(c("topic") == "Logistics"), "product": said & about, "our_product": said & flag(c("product")),
        "service": said & flag(c("service")), "deal": said & flag(c("deal")),
    }
    one = lambda test: F.when(flag(test), 1).otherwise(0).cast("long")
    zero = F.lit(0).cast("long")
    direct = mails.withColumn("key", F.explode(F.array_distinct("keys"))).where("key is not null")
    direct = direct.select("key", *[one(t).alias(n) for n, t in tests.items()], zero.alias("quoted"), zero.alias("quoted_inquiry"))
    quoting = mails.where(live & (about | flag(c("filed")))).select("keys", about.alias("about"), F.explode("quoted").alias("q")).where(c("q.domains") < mass)
    named = F.array_distinct(F.concat(F.array("q.sender"), F.when(c("q.domains") <= 3, c("q.keys")).otherwise(F.array().cast("array<string>"))))
    quoted = quoting.select(F.explode(F.array_except(named, c("keys"))).alias("key"), "about", c("q.sender").alias("sender")).where("key is not null")
    quoted = quoted.select("key", *[zero.alias(n) for n in tests], one(F.lit(True)).alias("quoted"), one(c("about") & (c("key") == c("sender"))).alias("quoted_inquiry"))
    return direct.unionByName(quoted).groupBy("key").agg(*[F.sum(n).alias(n) for n in COUNTERS])


def sole_addresses(people: DataFrame, name: str, email: str) -> DataFrame:
    """``person, email``: names that the archive uses with exactly one address, so that a legacy address under the name can be read."""
    real = people.where(F.col(email).contains("@") & ~F.lower(email).startswith("imceaex") & (F.coalesce(F.col(name), F.lit("")) != ""))
    counts = real.groupBy(person_key(F.col(name)).alias("person")).agg(F.count_distinct(F.lower(email)).alias("n"), F.min(F.lower(email)).alias("email"))
    return counts.where("n = 1 and person <> ''").select("person", "email")
