"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import decontamination, divergence, filter_audit, html_text, licenses, packing, quality_rules, quotations, repeats, secret_scan, sharding, simhash, url_filters
from .shared import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digit(value: Column, place: int) -> Column:
    """A hexadecimal digit of the MD5 of a text, from 0 to 15."""
    return F.position(F.substring(F.md5(value), place, 1), F.lit("0123456789abcdef")) - 1


def dated_entries(pages: DataFrame) -> DataFrame:
    """An invented block list for the hosts of ``pages``: entries come and go at dates drawn from the names."""
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("pattern")).where("pattern is not null").distinct()
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct()
    n, m = _digit(F.col("pattern"), 1), _digit(F.col("pattern"), 2)
    day = lambda start, days: F.date_add(F.lit(start).cast("date"), days.cast("int"))
    entry = lambda rows, scope, pattern, action, on: rows.select(F.lit(scope).alias("scope"), pattern.alias("pattern"), F.lit(action).alias("action"), on.alias("listed_on"))
    pattern = F.col("pattern")
    parts = [
        entry(hosts.where(n < 8), "host", pattern, "block", day("2024-01-01", 20 * n)),
        entry(hosts.where(n < 4), "host", pattern, "allow", day("2024-07-01", n)),
        entry(domains.where(n < 8), "domain", pattern, "block", day("2024-10-01", n)),
        entry(hosts.where(m < 8), "path", F.concat(pattern, F.lit("/en")), "allow", day("2024-03-01", 10 * m)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (16 * _digit(F.col("url"), 1) + _digit(F.col("url"), 2)) + 100)
    return url_filters.filter_urls(pages.withColumn("fetched_at", fetched), dated_entries(pages))


OP1_SQL = """
with p as (
  select page_id, url, nullif(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '') host,
         regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) path,
         date '2024-01-01' + cast(16 * (instr('0123456789abcdef', substr(md5(url), 1, 1)) - 1) + (instr('0123456789abcdef', substr(md5(url), 2, 1)) - 1) + 100 as int) fetched_at
  from pages),
h as (select distinct host pattern from p where host is not null),
d as (select distinct array_to_string(string_split(pattern, '.')[-2:], '.') pattern from h),
hn as (select pattern, instr('0123456789abcdef', substr(md5(pattern), 1, 1)) - 1 n, instr('0123456789abcdef', substr(md5(pattern), 2, 1)) - 1 m from h),
dn as (select pattern, instr('0123456789abcdef', substr(md5(pattern), 1, 1)) - 1 n from d),
e as (
  select 'h:' || pattern k, 'block' action, date '2024-01-01' + cast(20 * n as int) listed_on from hn where n < 8
  union all select 'h:' || pattern, 'allow', date '2024-07-01' + cast(n as int) from hn where n < 4
  union all select 'd:' || pattern, 'block', date '2024-10-01' + cast(n as int) from dn where n < 8
  union all select 'p:' || pattern || '/en', 'allow', date '2024-03-01' + cast(10 * m as int) from hn where m < 8),
i as (select k, action, listed_on, lead(listed_on) over (partition by k order by listed_on) until from e),
c as (select page_id, url, fetched_at, host, path, count(*) n_captures from p group by all),
j as (
  select c.*, i.k, i.action, i.listed_on,
         row_number() over (partition by c.page_id, c.url, c.fetched_at order by case left(i.k, 1) when 'p' then 3 when 'h' then 2 when 'd' then 1 end desc nulls last) nth
  from c left join i on (i.k = 'h:' || c.host or i.k = 'd:' || array_to_string(string_split(c.host, '.')[-2:], '.')
                         or (i.k = 'p:' || c.host || '/en' and (c.path = '/en' or starts_with(c.path, '/en/'))))
       and i.listed_on <= c.fetched_at and (i.until is null or c.fetched_at < i.until))
select page_id, url, fetched_at, coalesce(action, 'none') verdict, k matched, listed_on, n_captures from j where nth = 1
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), wrapped=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append all documents in two arrivals, English and the rest, compact after each, and read the newest version back."""
    base, docs = new_path(spark, "shards"), _table(spark, sf_dir, "documents")
    english = F.col("lang").eqNullSafe("en")
    for arrival in (docs.where(~english), docs.where(english)):
        sharding.append(arrival, base)
        sharding.compact(spark, base)
    return sharding.read(spark, base).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


OP5_SQL = "select doc_id, length(text) n_chars, md5(text) text_md5 from documents"


def quoted_mail(turns: DataFrame) -> DataFrame:
    """``conversations`` as mail with a tree of replies: message n of a conversation quotes message n - 1 - n mod 3 (at least the first), and where n is a multiple of three, also what that one quotes.

    Each message begins with its number, so that no two of a conversation are alike.
    """
    before = Window.partitionBy("conv_id").orderBy("turn")
    nth = F.row_number().over(before)
    numbered = turns.select("conv_id", "turn", "role", nth.alias("nth"), F.concat(F.lit("No. "), nth, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("own"))
    said = lambda n: F.lag("own", n).over(before)
    quote = lambda text, mark: F.regexp_replace(text, "(?m)^", mark)
    parent = F.when(F.col("nth") % 3 == 0, said(1)).when(F.col("nth") % 3 == 1, said(2)).otherwise(F.coalesce(said(3), said(1)))
    above = F.when(F.col("nth") % 3 == 0, F.coalesce(said(4), said(2)))
    mail = F.concat_ws("\n", "own", quote(parent, "> "), quote(above, "> > "))
    return numbered.select("conv_id", "turn", "role", mail.alias("text"))


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_order(quoted_mail(_table(spark, sf_dir, "conversations")))


OP6_SQL = r"""
with recursive t as (
  select conv_id, turn, role, trim('No. ' || nth || E'\n' || coalesce(text, ''), E' \t\n\r') as text, nth,
         case when nth > 1 then greatest(1, nth - 1 - nth % 3) end as parent
  from (select *, row_number() over (partition by conv_id order by turn) as nth from conversations)),
tree as (
  select conv_id, nth, [nth] as path from t where parent is null
  union all
  select t.conv_id, t.nth, list_append(tree.path, t.nth) from tree join t on t.conv_id = tree.conv_id and t.parent = tree.nth)
select t.conv_id, t.turn, t.role, t.text, p.turn as parent_turn, r.turn as root_turn, len(tree.path) - 1 as depth,
       row_number() over (partition by t.conv_id order by tree.path) as reply_order,
       cast(case when t.nth = 1 then 0 when t.nth % 3 = 0 then 2 else 1 end as bigint) as n_quotes
from t join tree using (conv_id, nth)
left join t p on p.conv_id = t.conv_id and p.nth = t.parent
join t r on r.conv_id = t.conv_id and r.nth = tree.path[1]
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP11_SQL = r"""
with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as least from t),
m as (
  select part, doc_id,
         case when len(words) < 200 then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
         + case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) then 4 else 0 end
         + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
         + case when doc_id > least then 16 else 0 end as mask,
         exists (select 1 from labels l where l.doc_id = w.doc_id and quality = 1) as good,
         exists (select 1 from labels l where l.doc_id = w.doc_id and toxic = 1) as toxic
  from w),
cells as (select part, mask, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from m group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (
  select filter_order, step, 1 << instr('ABCDE', filter_order[step]) - 1 as bit,
         coalesce(list_sum([1 << instr('ABCDE', x) - 1 for x in string_split(filter_order[:step - 1], '') if x <> '']), 0)::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (
  select part, filter_order, step, bit,
         coalesce(sum(n) filter (where mask & (bit | before) = 0), 0)::bigint as kept,
         coalesce(sum(n) filter (where mask & bit <> 0 and mask & before = 0), 0)::bigint as removed,
         coalesce(sum(n) filter (where mask & bit <> 0 and mask & before <> 0), 0)::bigint as redundant,
         coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (where mask & bit <> 0 and mask & before = 0), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (where mask & bit <> 0 and mask & before = 0), 0)::bigint as toxic_lost
  from cells, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with t as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
words as (select doc, lang, source, unnest(terms) as term from t),
kept as (select lang, term from words group by lang, term having count(distinct doc) >= 30),
v as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from t),
n as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term),
total as (select lang, source, sum(n) as total from n group by lang, source),
whole as (select lang, sum(n) as total from n group by lang),
p as (
  select g.lang, g.source, k.term, coalesce(n.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(n.n, 0) + 5)) // (coalesce(total.total, 0)::hugeint + 5 * v.v) as p
  from groups g join kept k using (lang) join v using (lang) left join n using (lang, source, term) left join total using (lang, source)),
q as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 5)::hugeint) // (any_value(whole.total)::hugeint + 5 * any_value(v.v)) as q
  from n join whole using (lang) join v using (lang) group by lang, term),
f as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as f from p a join p b using (lang, term) where a.source <> b.source group by all),
pairs as (
  select g.lang, g.source, 'pair' as part, o.source as item, coalesce(f.f, 0)::bigint as value
  from groups g join groups o on o.lang = g.lang and o.source <> g.source left join f on f.lang = g.lang and f.source = g.source and f.item = o.source),
terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from p join q using (lang, term) where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 50
"""


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    """For each rule the matches, and the text between them, one after the other."""
    parts = []
    for nth, rule in enumerate(secret_scan.BASE + secret_scan.MORE):
        pattern = rule.pattern.replace("'", "''")
        if rule.kind == "assign":
            # RE2's (?i) reaches beyond ASCII: the letters one by one.
            words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
            pattern = f"({words})" + pattern[pattern.index("))") + 2 :]
        if rule.kind == "bearer":
            pattern = "[Bb][Ee][Aa][Rr][Ee][Rr]" + pattern[pattern.index(")") + 1 :]
        parts.append(
            f"""
  select k, {nth} as nth, '{rule.kind}' as kind, unnest(range(1, len(m) + 1)) as i, unnest(m) as m, unnest(gaps[:len(m)]) as gap, unnest(part) as part, {rule.least} as least
  from (select k, regexp_extract_all(text, '{pattern}') as m, string_split_regex(text, '{pattern}') as gaps, regexp_extract_all(text, '{pattern}', {rule.group}) as part from t)"""
        )
    return f"""
with t as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
every as ({" union all ".join(parts)}),
ends as (select *, (sum(length(gap) + length(m)) over (partition by k, nth order by i))::bigint as stop from every),
found as (select k, nth, kind, kind || ':' || (stop - length(m)) || ':' || stop as span, stop - length(m) as start from ends where length(part) >= least),
per as (
  select k, count(*) filter (where nth = 0) as n_assign, count(*) filter (where nth = 1) as n_access, count(*) filter (where nth = 2) as n_hex,
         string_agg(span, ',' order by start, nth) filter (where nth < 3) as base, string_agg(span, ',' order by start, nth) as spans
  from found group by k)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join per using (k)
"""


ALL = (
    op1_url_filters, op2_suffix_dedup, op3_html_text, op4_packing, op5_sharding, op6_quotations, op7_simhash, op8_quality_rules,
    op9_decontamination, op10_license_scan, op11_filter_audit, op12_source_divergence, op13_secret_scan,
)
QUERIES = {f.__name__: f for f in ALL}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL = {
    "op1_url_filters": OP1_SQL, "op5_sharding": OP5_SQL, "op6_quotations": OP6_SQL,
    "op11_filter_audit": OP11_SQL, "op12_source_divergence": OP12_SQL, "op13_secret_scan": _secrets_sql(),
}
