"""Queries: records attached to companies, quotes checked, weeks and strata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attach, evidence
from .registry import query


@query(r"""with h as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) host from pages), k as (select distinct array_to_string(string_split(host, '.')[-2:], '.') d from h where page_id % 3 <> 0)
  select page_id, max_by(d, length(d)) known from h join k on host = d or ends_with(host, '.' || d) group by page_id""")
def domain_suffix(t):
    """Pages to the known domain that their host lies below."""
    hosts = t("pages").select("page_id", F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1)).alias("host"))
    known = hosts.where("page_id % 3 <> 0").select(F.substring_index("host", ".", -2).alias("known")).distinct()
    return attach.by_domain(hosts, "page_id", "host", known, "known")


@query("""with c as (select c_custkey id, case when c_custkey % 3 = 0 then c_custkey end code, case when c_custkey % 2 = 0 then c_name end cn from customer), k as (select c_custkey code, c_name cn, c_custkey target from customer where c_custkey % 5 <> 0)
  select id, coalesce(a.target, b.target) target, case when a.target is not null then 0 when b.target is not null then 1 end nth from c left join k a on a.code = c.code left join k b on b.cn = c.cn""")
def code_then_name(t):
    """Customers by their code, else by their name."""
    rows = t("customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("code"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("cn"))
    known = t("customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k_code"), F.col("c_name").alias("k_name"), F.col("c_custkey").alias("target"))
    return attach.prioritised(rows, "id", [("code", known, "k_code"), ("cn", known, "k_name")], "target")


@query(r"""with f as (select doc_id fact_id, case when doc_id % 5 = 0 then doc_id + 1 else doc_id end doc_id, case when doc_id % 7 = 0 then '' else substr("text", 11, 40) end q from documents)
  select fact_id, case when trim(coalesce(q, '')) = '' then 'empty quote' when d."text" is null then 'no such message' when not contains(trim(regexp_replace(lower(d."text"), '\s+', ' ', 'g')), trim(regexp_replace(lower(q), '\s+', ' ', 'g'))) then 'quote not found' end problem from f left join documents d using (doc_id)""")
def quotes_found(t):
    """A stretch of each document as a quote, some empty, some from the wrong document."""
    docs = t("documents")
    facts = docs.select(F.col("doc_id").alias("fact_id"), F.when(F.col("doc_id") % 5 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")).alias("doc_id"), F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.substring("text", 11, 40)).alias("q"))
    return evidence.quotes_checked(facts, docs.select("doc_id", "text"), "doc_id", "q", "text").select("fact_id", "problem")


@query("""with e as (select user_id, cast(ts as date) d, event_type p from events)
  select user_id, isoyear(d) as "year", week(d) as "week", count(distinct d) n_days, min(d) first_day, max(d) last_day from e group by all""")
def week_days(t):
    """Events of a user and ISO week as one week."""
    found = evidence.weeks(t("events").withColumn("day", F.col("ts").cast("date")), "user_id", "day", "event_type")
    return found.select("user_id", F.col("year").cast("long"), F.col("week").cast("long"), F.size("days").cast("long").alias("n_days"), F.array_min("days").alias("first_day"), F.array_max("days").alias("last_day"))


@query("""with w as (select c_custkey, c_nationkey, '+86138' || lpad((c_custkey % 40)::varchar, 8, '0') n, case when c_custkey % 4 = 2 then '+86138' else '+86139' end || lpad((c_custkey % 40)::varchar, 8, '0') m from customer),
  h as (select c_nationkey, m as n, min(c_custkey) contact from w group by all)
  select w.c_nationkey, c_custkey, contact from w join h using (c_nationkey, n)""")
def mobile_match(t):
    """People of a nation who share a mobile number with a contact that is held; three contacts of four have changed theirs."""
    digits = F.lpad((F.col("c_custkey") % 40).cast("string"), 8, "0")
    rows = t("customer").select("c_nationkey", "c_custkey", F.array(F.lit("+861062345678"), F.concat(F.lit("+86138"), digits)).alias("numbers"))
    held = t("customer").select("c_nationkey", F.col("c_custkey").alias("contact"), F.array(F.concat(F.when(F.col("c_custkey") % 4 == 2, "+86138").otherwise("+86139"), digits)).alias("numbers"))
    return attach.by_mobile(rows, held, "c_nationkey", "c_custkey", "numbers", "contact")


@query("""with p as (select distinct p_name party, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') f from part), l as (select distinct n_name as label, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') g from nation union select distinct string_split(p_name, ' ')[1], regexp_replace(lower(string_split(p_name, ' ')[1]), '[^a-z0-9]', '', 'g') from part)
  select party, label from p join l on contains(f, g) where length(g) >= 4""")
def label_in_party(t):
    """Part names that hold a label: a nation's name or a part's first word."""
    labels = t("nation").select(F.col("n_name").alias("label")).union(t("part").select(F.split("p_name", " ")[0].alias("label")))
    return attach.by_label(t("part").select(F.col("p_name").alias("party")), "party", labels, "label")
