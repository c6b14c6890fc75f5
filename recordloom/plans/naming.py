"""Queries on names: surnames by longest prefix, names out of headers and signatures, companies in two scripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import people, resolve
from .registry import query

GIVEN = ("wei", "na", "ming", "xiao", "anna", "gang")
STRANGE = ("okafor", "berg", "dupont")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values, k):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


_PEOPLE = f"""people as (
  select who, form, k, {_sql_list(people.LATIN_SURNAMES)}[k % 23 + 1] as s, {_sql_list(GIVEN)}[k % 6 + 1] as g,
         {_sql_list(people.LATIN_SURNAMES)}[(k + 7) % 23 + 1] as other, {_sql_list(STRANGE)}[k % 3 + 1] as strange
  from (select 'c' || c_custkey as who, c_custkey % 9 as form, c_custkey // 9 as k from customer
        union all select 's' || s_suppkey, s_suppkey % 9, s_suppkey // 9 from supplier)),
cap as (select *, upper(s[1]) || s[2:] as cs, upper(g[1]) || g[2:] as cg, upper(other[1]) || other[2:] as co, upper(strange[1]) || strange[2:] as ct from people),
named as (
  select who, case form when 0 then 'Mr. ' || cs || g when 1 then cs || ' ' || cg when 2 then cg || ' ' || cs when 3 then upper(s) when 4 then cs || ', ' || cg
         when 5 then 'Ms.' || cs when 6 then ct || ' ' || cg when 7 then cs || ' ' || co else cs || ' ' || cg || ' Co., Ltd.' end as written
  from cap)"""


@query(f"""with {_PEOPLE},
known as (select unnest({_sql_list(people.LATIN_SURNAMES)}) as surname),
w as (
  select who, written, list_filter(string_split_regex(regexp_replace(lower(written), '^(mr|ms)[.] *', ''), '[ .,]+'), lambda x: x not in ('', 'co', 'ltd')) as words from named),
b as (
  select w.*, array_to_string(words, '') as glued, (select arg_max(surname, length(surname)) from known where starts_with(array_to_string(words, ''), surname)) as begun,
         words[1] in (select surname from known) as is_first, words[-1] in (select surname from known) as is_last
  from w),
v as (
  select *, case when len(words) = 1 then case when begun is null then 'unknown surname' when begun = glued then 'alone' else 'run together' end
                 when is_first and is_last and words[1] <> words[-1] then 'two surnames' when is_first then 'first' when is_last then 'last' else 'unknown surname' end as verdict
  from b)
select who, written, case verdict when 'first' then words[1] when 'last' then words[-1] when 'alone' then begun when 'run together' then begun end as surname,
       case verdict when 'first' then array_to_string(words[2:], ' ') when 'last' then array_to_string(words[:-2], ' ') when 'run together' then glued[length(begun) + 1:] end as given,
       coalesce(begun, glued) as surname_key, len(words) >= 2 or verdict = 'run together' as spelled_out, verdict
from v""")
def surnames_of_people(t):
    """Customers and suppliers under people's names in nine ways of writing; unknown and doubled surnames are questions."""
    c = t("customer").select(F.concat(F.lit("c"), "c_custkey").alias("who"), F.col("c_custkey").alias("id"))
    rows = c.unionByName(t("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("who"), F.col("s_suppkey").alias("id")))
    form, k = F.col("id") % 9, F.floor(F.col("id") / 9)
    s, g, other, strange = (_pick(x, n) for x, n in ((people.LATIN_SURNAMES, k), (GIVEN, k), (people.LATIN_SURNAMES, k + 7), (STRANGE, k)))
    cs, cg = F.initcap(s), F.initcap(g)
    ways = [F.concat(F.lit("Mr. "), cs, g), F.concat_ws(" ", cs, cg), F.concat_ws(" ", cg, cs), F.upper(s), F.concat_ws(", ", cs, cg), F.concat(F.lit("Ms."), cs), F.concat_ws(" ", F.initcap(strange), cg), F.concat_ws(" ", cs, F.initcap(other)), F.concat_ws(" ", cs, cg, F.lit("Co., Ltd."))]
    rows = rows.select("who", F.element_at(F.array(*ways), (form + 1).cast("int")).alias("written"))
    known = rows.sparkSession.createDataFrame([(x,) for x in people.LATIN_SURNAMES], "surname string")
    return people.surnames(rows, "written", known, "surname")


HAN_SURNAMES = ("王", "李", "张", "刘", "陈", "欧", "欧阳", "司马")
HAN_NAMES = ("王芳", "李小明", "欧阳娜", "某某某", "司马光", "陈经理")


@query(f"""with m as (
  select o_orderkey as key, o_custkey as c, o_orderkey % 7 as form, {_sql_list(HAN_NAMES)}[o_custkey % 6 + 1] as han, o_custkey % 6 not in (3, 5) as known,
         o_custkey % 4 as box, {_sql_list(people.LATIN_SURNAMES)}[o_custkey % 23 + 1] as s, {_sql_list(GIVEN)}[o_custkey % 6 + 1] as g
  from orders),
n as (
  select *, upper(g[1]) || g[2:] || ' ' || upper(s[1]) || s[2:] as full_name,
         case box when 0 then 'sales' || c || '@a.com' when 1 then g || '.' || s || '@b' || c || '.com' when 2 then 'x' || c || '@c.com' else 'y' || c || '@d.com' end as address
  from m),
heads as (
  select address, key, case when form in (0, 1) then full_name when form = 2 and known then full_name when form = 3 and known then han when form = 4 then full_name end as name,
         case when form in (2, 4) and known then han end as native
  from n where form in (0, 1, 2, 3, 4) and box <> 2 and not (box = 1 and form <> 5) and not (box = 0 and form > 1)),
votes as (select address, name, count(*) as n, min(key) as first, min(native) as native from heads where name is not null group by address, name),
head as (
  select address, best.name, best.native, most, all_n
  from (select address, arg_min({{'name': name, 'native': native}}, (-n, first, name)) as best, max(n) as most, list(n) as all_n from votes group by address)),
signs as (select address, case when box = 3 then 'An ' || full_name else upper(g[1]) || g[2:] end as latin, case when known and box = 2 then han end as han, count(*) as n, min(key) as first
          from n where form in (5, 6) group by all),
strong as (select *, han is not null or latin like '% %' as strong from signs),
longer as (select h.address, arg_min(s.latin, (-s.n, s.first)) as longer from head h join strong s using (address) where s.strong and h.name similar to '[A-Za-z ]+' and s.latin like '%' || h.name group by h.address),
signed as (
  select address, arg_min(latin, (-n, first)) as latin, arg_min(coalesce(han, ''), (-n, first)) as han
  from strong where strong or (n >= 2 and not starts_with(address, 'sales') and not regexp_matches(split_part(address, '@', 1), '[0-9].*[0-9]') and length(latin) > 3) group by address)
select a.address, coalesce(longer, h.name, signed.latin, case when a.box = 1 then any_value(a.full_name) end, a.address) as name,
       case when h.name is not null then h.native when signed.latin is not null then nullif(signed.han, '') end as native,
       case when longer is not null or (h.name is null and signed.latin is not null) then 'signature' when h.name is not null then 'header' when a.box = 1 then 'address' else 'mailbox' end as source,
       case when len(list_filter(all_n, lambda x: x = most)) > 1 and longer is null then 'header names tie'
            when longer is null and h.name is null and signed.latin is null and a.box <> 1 then 'no name' end as review
from n a left join head h using (address) left join longer using (address) left join signed using (address)
group by a.address, a.box, longer, h.name, h.native, h.most, h.all_n, signed.latin, signed.han""")
def names_of_senders(t):
    """Orders as mail: display names in both scripts, handles, signatures in full and by first name, shared mailboxes."""
    o = t("orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("c"))
    s, g, han = _pick(people.LATIN_SURNAMES, F.col("c")), _pick(GIVEN, F.col("c")), _pick(HAN_NAMES, F.col("c"))
    form, box = F.col("key") % 7, F.col("c") % 4
    full = F.concat_ws(" ", F.initcap(g), F.initcap(s))
    address = F.when(box == 0, F.concat(F.lit("sales"), "c", F.lit("@a.com"))).when(box == 1, F.concat(g, F.lit("."), s, F.lit("@b"), "c", F.lit(".com")))
    address = address.when(box == 2, F.concat(F.lit("x"), "c", F.lit("@c.com"))).otherwise(F.concat(F.lit("y"), "c", F.lit("@d.com")))
    display = F.when(form == 0, full).when(form == 1, F.concat(F.initcap(s), F.lit(", "), F.initcap(g))).when(form == 2, F.concat_ws(" ", full, han)).when(form == 3, han)
    display = display.when(form == 4, F.concat(full, F.lit(" ("), han, F.lit(")")))
    display = F.when((box == 2) | (box == 1) | ((box == 0) & (form > 1)), F.when(box == 0, F.lit("Sales Team"))).otherwise(display)
    first = F.when(box == 3, F.concat_ws(" ", F.lit("An"), full)).when(box == 2, F.concat_ws(" ", F.initcap(g), han)).otherwise(F.initcap(g))
    text = F.when(form >= 5, F.concat(F.lit("Dear all,\nplease see below.\n\nBest regards,\n"), first, F.lit("\nTel: 12345")))
    rows = o.select("key", address.alias("address"), display.alias("display"), text.alias("text"))
    known = rows.sparkSession.createDataFrame([(x,) for x in HAN_SURNAMES], "surname string")
    return people.names_of_senders(rows, "key", "address", "display", "text", "key", known)


_CONSONANTS, _VOWELS = "bdfghjklmnprstwz", ("a", "e", "i", "o", "u")
_LETTERS = "bcdfghklmnprstvz"


def syllable(n: int) -> str:
    return _CONSONANTS[n % 16] + _VOWELS[n // 16 % 5]


def invented_readings() -> list[tuple[str, str]]:
    """Readings by rule for 256 Chinese letters; every fourth has two."""
    return [(chr(0x4E00 + n), syllable(n + 37 * k)) for n in range(256) for k in range(2 if n % 4 == 0 else 1)]


_HAN_CASE = f"""
with c as (
  select c_custkey as key, c_custkey % 2 = 0 as han, c_custkey // 2 % 9 as k, 'CR' || lpad(cast(c_custkey as varchar), 7, '0') as code, md5(cast(c_custkey as varchar)) as h from customer),
n as (
  select *, translate(h[:14], '0123456789abcdef', '{_LETTERS}') as w, [cast('0x' || h[2 * i - 1:2 * i] as int) for i in range(1, 9)] as b from c),
s as (
  select *, array_to_string([chr(19968 + x) for x in b], '') as cn,
         [substr('{_CONSONANTS}', x % 16 + 1, 1) || substr('aeiou', x // 16 % 5 + 1, 1) for x in b] as first,
         [substr('{_CONSONANTS}', (x + 37) % 16 + 1, 1) || substr('aeiou', (x + 37) // 16 % 5 + 1, 1) for x in b] as second from n),
f as (
  select *, case when k = 6 then 'Shanghai ' else '' end || w[:8] || ' ' || w[9:] || ' Ltd' as latin,
         case when han then case k when 0 then cn || '有限公司' when 1 then array_to_string(first, '') when 2 then array_to_string([case when b[i] % 4 = 0 then second[i] else first[i] end for i in range(1, 9)], '')
                when 3 then array_to_string(first[:7], '') when 4 then cn[:7] when 5 then cn[:3] || cn[5:] when 6 then cn when 7 then '龘靐' || translate(cast(key as varchar), '0123456789', '齉爩鱻麤龗灪吁龖厵滟') else cn || '某' end
         else case k when 1 then code || ' ' || w[:8] || ' ' || w[9:] when 2 then code || ' yyyy yyyyyy' when 3 then w[:4] || w[6:] || ' Ltd' when 4 then 'Yoyuyi ' || translate(cast(key as varchar), '0123456789', 'eiouyaqjxw')
                when 5 then w[:12] when 6 then 'Beijing ' || w[:8] || ' ' || w[9:] when 7 then repeat('?', key % 5 + 1) when 8 then 'Hong Kong' else w[:8] || ' ' || w[9:] || ' Ltd' end end as written
  from s)
select distinct written,
       case when han and k in (0, 1, 2, 3, 4, 5) or not han and k in (0, 1, 3, 5) then code end as code,
       case when han and k in (1, 2) then 0.95 when han and k in (3, 4) or not han and k = 5 then 0.9 when han and k = 5 then round(200 * 7 / 15.0 * 0.95 / 100, 4)
            when not han and k = 3 then round(200 * 13 / 27.0 * 0.95 / 100, 4) when not han and k = 2 then 0.8 when not han and k = 6 then 0.89 when han and k = 6 or not han and k = 7 then 0.0 else 1.0 end::double as score,
       case when han then case k when 0 then 'exact' when 4 then 'contains' when 5 then 'fuzzy' when 6 then 'ambiguous' when 7 then 'new' when 8 then 'new' else 'pinyin' end
            else case k when 1 then 'code' when 2 then 'review' when 3 then 'fuzzy' when 4 then 'new' when 5 then 'contains' when 6 then 'review' when 7 then 'none' when 8 then 'new' else 'exact' end end as method
from f
"""


@query(_HAN_CASE)
def company_cascade_in_two_scripts(t):
    """Every way through the cascade: Chinese names spelled in Latin letters (by either reading, or their beginning), a code beside another name,
    twins, places apart, names of one place only, answers given before, and what the one-script query has."""
    key, h = F.col("c_custkey"), F.md5(F.col("c_custkey").cast("string"))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring("h", 2 * i + 1, F.lit(2)), 16, 10).cast("int"))
    spoken = lambda x: F.concat(F.substring(F.lit(_CONSONANTS), x % 16 + 1, F.lit(1)), F.substring(F.lit("".join(_VOWELS)), F.floor(x / 16).cast("int") % 5 + 1, F.lit(1)))
    ways = [spoken, lambda x: spoken(x + F.when(x % 4 == 0, 37).otherwise(0))]
    said = lambda way, n: F.array_join(F.transform(F.slice("b", 1, n), way), "")
    c = t("customer").select(key, (key % 2 == 0).alias("han"), (F.floor(key / 2) % 9).alias("k"), F.concat(F.lit("CR"), F.lpad(key.cast("string"), 7, "0")).alias("code"), h.alias("h"))
    c = c.withColumns({"w": F.translate(F.substring("h", 1, 14), "0123456789abcdef", _LETTERS), "b": numbers})
    # The letters from U+4E00 on, by their numbers.
    c = c.withColumn("cn", F.decode(F.unhex(F.regexp_replace(F.substring("h", 1, 16), "(..)", "4e$1")), "UTF-16BE"))
    cut = lambda a, b: F.substring("w", a, b)
    plain, k, written = F.concat(cut(1, 8), F.lit(" "), cut(9, 6)), F.col("k"), None
    digits = lambda text: F.translate(key.cast("string"), "0123456789", text)
    chinese = [
        F.concat("cn", F.lit("有限公司")), said(ways[0], 8), said(ways[1], 8), said(ways[0], 7), F.substring("cn", 1, 7), F.concat(F.substring("cn", 1, 3), F.substring("cn", 5, 4)), F.col("cn"),
        F.concat(F.lit("龘靐"), digits("齉爩鱻麤龗灪吁龖厵滟")), F.concat("cn", F.lit("某")),
    ]
    latin = [
        F.concat(plain, F.lit(" Ltd")), F.concat_ws(" ", "code", plain), F.concat("code", F.lit(" yyyy yyyyyy")), F.concat(cut(1, 4), cut(6, 9), F.lit(" Ltd")), F.concat(F.lit("Yoyuyi "), digits("eiouyaqjxw")),
        cut(1, 12), F.concat(F.lit("Beijing "), plain), F.repeat(F.lit("?"), (key % 5 + 1).cast("int")), F.lit("Hong Kong"),
    ]
    pick = lambda cases: F.element_at(F.array(*cases), (k + 1).cast("int"))
    written = F.when(F.col("han"), pick(chinese)).otherwise(pick(latin))
    name = F.when(F.col("han"), F.concat("cn", F.lit("股份有限公司"))).otherwise(F.concat(F.when(k == 6, "Shanghai ").otherwise(""), plain, F.lit(" Ltd")))
    master = c.select("code", name.alias("name"))
    twins = c.where("han and k = 6").select(F.concat(F.lit("T"), "code").alias("code"), name.alias("name"))
    decided = c.where("han and k = 8").select("cn")
    readings = c.sparkSession.createDataFrame(invented_readings(), "letter string, reading string")
    return resolve.match_companies(c.select(written.alias("written")), "written", master.unionByName(twins), "name", "code", decided, readings)
