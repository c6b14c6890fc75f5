"""Queries: scalars, texts, sheets of cells, company names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates, emails, numbers, phones, status, text
from ..operators import headers, resolve, winners
from .registry import query


@query(r"""select doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all("text", '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}'), lambda x: lower(x)))), ',') mails
  from documents where regexp_matches("text", '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}')""")
def emails_found(t):
    found = emails.addresses(F.col("text"))
    return t("documents").select("doc_id", F.array_join(F.array_sort(found), ",").alias("mails")).where("mails <> ''")


@query(r"""with f as (select doc_id, regexp_extract_all("text", '\d{6,}') runs, regexp_extract_all("text", '\+?\(?\d[\d ()/.-]{6,}\d') chunks from documents)
  select doc_id, array_to_string(runs, ',') runs, array_to_string(list_transform(chunks, lambda c: right(regexp_replace(c, '\D', '', 'g'), 9)), ',') tails from f where len(runs) + len(chunks) > 0""")
def refs_found(t):
    """Long digit runs and the last nine digits of what looks like a phone number."""
    runs, chunks = F.regexp_extract_all("text", F.lit(r"\d{6,}"), F.lit(0)), phones.phone_chunks(F.col("text"))
    rows = t("documents").select("doc_id", runs.alias("runs"), chunks.alias("chunks")).where(F.size("runs") + F.size("chunks") > 0)
    return rows.select("doc_id", F.array_join("runs", ",").alias("runs"), F.array_join(F.transform("chunks", phones.phone_tail), ",").alias("tails"))


@query(r"""select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) title,
  length(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!--.*?-->', ' ', 'g'),
  '(?i)<br\s*/?>|</(?:p|div|tr|li|h[1-6])>', E'\n', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\x{00a0}]+', ' ', 'g'), ' ?\n[ \n]*', E'\n', 'g'))) n_chars from pages""")
def html_text(t):
    """Title and length of the text of a page, as for a mail's HTML part."""
    return t("pages").select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.length(text.html_text(F.col("html"))).cast("bigint").alias("n_chars"))


@query(r"""with l as (select doc_id, string_split("text", E'\n') ls from documents), f as (select doc_id, ls, list_position(list_transform(ls, lambda x: regexp_matches(x, '(?i)licen[sc]e[d ]|copyright')), true) p from l)
  select doc_id, length(trim(array_to_string(case when p > 0 then ls[1:p - 1] else ls end, E'\n'))) n_top, coalesce(p, 0) > 0 cut from f""")
def top_reply(t):
    """Documents up to their first line about a licence, which stands in for a quotation's head."""
    marker = "(?i)licen[sc]e[d ]|copyright"
    top = text.top_reply(F.col("text"), marker)
    return t("documents").select("doc_id", F.length(top).cast("bigint").alias("n_top"), F.exists(F.split("text", "\n"), lambda x: x.rlike(marker)).alias("cut"))


_PHRASES = ["in 3 working days", "tomorrow", "next week", "this week", "this month", "CW 21", "in June"]


@query("""with o as (select o_orderkey, cast(o_orderdate as date) d, cast(o_orderkey % 7 as int) k from orders), w as (select *, isodow(d) - 1 wd, case when 21 < week(d) - 26 then year(d) + 1 else year(d) end wy from o)
  select o_orderkey, case k when 0 then d + 3 when 1 then d + 1 when 2 then d + cast(7 - wd as int) when 3 then d + cast(greatest(0, 4 - wd) as int) when 4 then last_day(d)
  when 5 then date_trunc('week', make_date(wy, 1, 4))::date + 140 else make_date(case when month(d) > 6 then year(d) + 1 else year(d) end, 6, 1) end due from w""")
def deadline_dates(t):
    """Seven phrases, counted from the order's day."""
    day = F.col("o_orderdate").cast("date")
    phrase = F.get(F.array(*[F.lit(p) for p in _PHRASES]), (F.col("o_orderkey") % 7).cast("int"))
    return t("orders").select("o_orderkey", dates.deadline(phrase, day).alias("due"))


@query("select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) * case when o_orderkey % 4 = 3 then -1 else 1 end as double) amount from orders")
def number_parse(t):
    """Prices written in four ways and read back."""
    english = F.format_number(F.col("o_totalprice"), 2)
    spelled = F.when(F.col("o_orderkey") % 4 == 0, english).when(F.col("o_orderkey") % 4 == 1, F.translate(english, ",.", ".,")).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("RMB "), F.translate(english, ",", "'"))).otherwise(F.concat(F.lit("("), english, F.lit(")")))
    return t("orders").select("o_orderkey", numbers.parse_number(spelled).cast("decimal(18,2)").cast("double").alias("amount"))


@query("""select c_custkey, case cast(c_custkey % 4 as int) when 0 then '+86138' || lpad(c_custkey::varchar, 8, '0') when 1 then '+8610' || lpad(c_custkey::varchar, 8, '0') when 2 then '+49711' || c_custkey else c_custkey::varchar end number,
  case when c_custkey % 4 = 0 then 'mobile' else 'work' end kind from customer""")
def phone_e164(t):
    """Numbers made from customer keys: a mobile, a landline, a foreign number and none."""
    key = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("138-"), F.lpad(key, 8, "0"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("(010) "), F.lpad(key, 8, "0"))).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("0049 711 "), key)).otherwise(key)
    number = phones.phone_e164(raw)
    return t("customer").select("c_custkey", number.alias("number"), phones.phone_type(number).alias("kind"))


@query("""select o_orderkey, case when o_orderpriority like '%URGENT%' or o_orderpriority like '%HIGH%' then 'open' when o_orderpriority like '%LOW%' then 'waiting' else 'unknown' end state from orders""")
def status_map(t):
    rules = (("open", ("urgent", "high")), ("waiting", ("low",)))
    return t("orders").select("o_orderkey", status.state_of(F.col("o_orderpriority"), rules, "unknown").alias("state"))


@query("""select key, doc_id, copies from (select sha256(trim(lower("text"), E' \\n')) as key, doc_id, count(*) over (partition by sha256(trim(lower("text"), E' \\n'))) copies,
  row_number() over (partition by sha256(trim(lower("text"), E' \\n')) order by source desc, doc_id) n from documents) where n = 1""".replace("\\\\n", "\\n"))
def content_dedupe(t):
    """One document of each content, preferring a class of source; only hashes are shuffled."""
    rows = t("documents").select("doc_id", "source", F.sha2(F.trim(F.lower("text"), F.lit(" \n")), 256).alias("key"))
    return winners.newest_wins(rows, ["key"], [F.col("source").desc(), F.col("doc_id")]).select("key", "doc_id", (F.col("superseded") + 1).alias("copies"))


_WORDS = {"date": ["date"], "customer": ["customer", "visiting customer"], "status": ["=status"]}


def _cells(t):
    """A sheet for each nation: a header on row 3 to 5, a row for each supplier with its date in a merged cell, a total after every six."""
    nations = t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".xlsx")).alias("file"), F.lit("S").alias("sheet"), (F.col("n_nationkey") % 3 + 3).cast("int").alias("row"), F.col("n_name").alias("nation"))
    none = F.lit(None).cast("int")
    cell = lambda col, text, row=none, at=none: F.struct(F.lit(col).alias("col"), text.alias("text"), row.alias("merge_row"), at.alias("merge_col"))
    labels = ("Date", "Customer (full address)", "Status", "Bank account", "Mood")
    heads = nations.select("file", "sheet", "row", F.explode(F.array(cell(1, F.col("nation")))).alias("c")).withColumn("row", F.lit(1))
    heads = heads.unionByName(nations.select("file", "sheet", "row", F.explode(F.array(*[cell(k, F.lit(x)) for k, x in enumerate(labels, 1)])).alias("c")))
    nth = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    rows = t("supplier").withColumn("nth", nth).withColumn("top", (F.col("s_nationkey") % 3 + 4).cast("int")).withColumn("row", (F.col("top") + F.col("nth")).cast("int"))
    total, one = F.col("nth") % 7 == 6, F.lit(1)
    state = F.when(F.col("s_acctbal") < 3000, "open").otherwise("closed")
    plain = F.array(
        cell(1, F.when(F.col("nth") == 0, "2026-05-18"), F.col("top"), one), cell(2, F.col("s_name")), cell(3, state), cell(4, F.col("s_acctbal").cast("string")), cell(5, F.when(F.col("s_suppkey") % 2 == 0, "good")),
    )
    body = rows.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file"), F.lit("S").alias("sheet"), "row", F.explode(F.when(total, F.array(cell(1, F.lit("Total")))).otherwise(plain)).alias("c"))
    return heads.unionByName(body).select("file", "sheet", "row", "c.*")


@query("select 'n' || n_nationkey || '.xlsx' as file, 'S' as sheet, cast(n_nationkey % 3 + 3 as int) as header_row, f.field, cast(f.col as int) as col from nation, (values ('date', 1), ('customer', 2), ('status', 3)) f(field, col)")
def header_detect(t):
    """The header of each sheet, found by its labels."""
    cells = headers.resolved(_cells(t))
    return headers.find_headers(cells, headers.synonyms(cells.sparkSession, _WORDS), 3, ["date", "customer"]).drop("until")


@query("""with r as (select *, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as nth from supplier)
  select 'n' || s_nationkey || '.xlsx' as file, 'S' as sheet, cast(s_nationkey % 3 + 4 + nth as int) as row, case when nth % 7 = 6 then 'Total' else '2026-05-18' end as date, case when nth % 7 <> 6 then s_name end as customer,
    case when nth % 7 <> 6 then case when s_acctbal < 3000 then 'open' else 'closed' end end as status, case when nth % 7 <> 6 and s_suppkey % 2 = 0 then 'good' end as mood, case when nth % 7 = 6 then 'total row' end as reason from r""")
def pivot_cells(t):
    """Rows under the headers with merged cells filled, an unknown column kept, a bank account never read, and the reason of a skipped row."""
    cells = headers.resolved(_cells(t))
    found = headers.find_headers(cells, headers.synonyms(cells.sparkSession, _WORDS), 3, ["date", "customer"])
    rows = headers.pivoted(cells, found, ["date", "customer", "status"])
    rows = rows.join(headers.extras(cells, found), ["file", "sheet", "row"], "left")
    rows = headers.skip_reasons(rows, "customer", ["date", "customer", "status"])
    return rows.select("file", "sheet", "row", "date", "customer", "status", F.col("extra")["Mood"].alias("mood"), "reason")


_LETTERS = "bcdfghklmnprstvz"


@query(f"""with m as (select c_custkey, 'CR' || lpad(cast(c_custkey as varchar), 7, '0') as code, translate(substr(md5(cast(c_custkey as varchar)), 1, 14), '0123456789abcdef', '{_LETTERS}') as w from customer),
  n as (select *, c_custkey % 5 as k, left(w, 8) || ' ' || right(w, 6) || ' Ltd' as name from m)
  select case k when 0 then name when 1 then '(old) ' || name || ' Co., Ltd.' when 2 then left(w, 4) || right(w, 9) || ' Ltd' when 3 then code || ' ' || name else 'Yoyuyi ' || translate(cast(c_custkey as varchar), '0123456789', 'eiouyaqjxw') end as written,
    case k when 4 then null else code end as code, case k when 2 then round(200 * 13 / 27.0 * 0.95 / 100, 4) else 1.0 end::double as score,
    case k when 2 then 'fuzzy' when 3 then 'code' when 4 then 'new' else 'exact' end as method from n""")
def company_cascade(t):
    """Every customer's name as it is, with other legal forms, with a letter lost, with its code, or unknown, against all customers as master."""
    key = F.col("c_custkey")
    w = F.translate(F.substring(F.md5(key.cast("string")), 1, 14), "0123456789abcdef", _LETTERS)
    name = F.concat(F.substring("w", 1, 8), F.lit(" "), F.substring("w", 9, 6), F.lit(" Ltd"))
    master = t("customer").select(key, F.concat(F.lit("CR"), F.lpad(key.cast("string"), 7, "0")).alias("code"), w.alias("w")).withColumn("name", name)
    k = key % 5
    written = (
        F.when(k == 0, F.col("name")).when(k == 1, F.concat(F.lit("(old) "), F.col("name"), F.lit(" Co., Ltd.")))
        .when(k == 2, F.concat(F.substring("w", 1, 4), F.substring("w", 6, 9), F.lit(" Ltd"))).when(k == 3, F.concat_ws(" ", "code", "name"))
        .otherwise(F.concat(F.lit("Yoyuyi "), F.translate(key.cast("string"), "0123456789", "eiouyaqjxw")))
    )
    return resolve.match_companies(master.select(written.alias("written")), "written", master, "name", "code")


@query(r"""select doc_id, length(regexp_replace("text", '\s', '', 'g')) as letters, true as conserved from documents where "text" is not null""")
def cell_conservation(t):
    """Splitting a text at its script changes and line ends neither loses nor invents a letter."""
    bare = lambda c: F.regexp_replace(c, "\\s", "")
    rows = t("documents").where("text is not null").select("doc_id", bare(F.col("text")).alias("before"), bare(text.script_spaced(F.col("text"))).alias("after"))
    # The same letters in the same order need no sorting; only where they are not are they counted out.
    letters = lambda c: F.sort_array(F.split(c, ""))
    conserved = (F.col("before") == F.col("after")) | (letters(F.col("before")) == letters(F.col("after")))
    return rows.select("doc_id", F.length("after").cast("bigint").alias("letters"), conserved.alias("conserved"))
