"""Queries: cells of visit, account and task sheets, people of accounts, mail counters.

Each writes values of a whole table in several of the ways that sheets write them
and reads them back; the SQL says what must come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import customers, dates, status
from ..operators import accounts, lookups, mail, planning
from ..sources import mbox
from ..sources.shared import new_path
from .registry import query

_STATES = ["未完成", "完成", "Pending (Li)", "on hold", "blocked", "erledigt", "offen", "wip", "planned", "待处理", "进行中", "取消", "", "who knows"]
_READ = ["open", "done", "open", "waiting", "waiting", "done", "open", "wip", "open", "open", "wip", "cancelled", "open", "open"]


@query(f"""select o_orderkey, {_READ}[o_orderkey % 14 + 1] as state, o_orderkey % 14 <> 13 as known from orders""")
def todo_states(t):
    """Fourteen ways of saying how far a task is, with the order's priority behind some of them."""
    said = F.get(F.array(*map(F.lit, _STATES)), (F.col("o_orderkey") % 14).cast("int"))
    cell = F.when(said.rlike("^[a-z]+$") & (F.col("o_orderkey") % 2 == 0), F.concat_ws(" ", said, F.lower("o_orderpriority"))).otherwise(said)
    state = status.todo_state(cell)
    return t("orders").select("o_orderkey", state["state"].alias("state"), state["known"].alias("known"))


@query(r"""select c_custkey, trim(case c_custkey % 6 when 0 then c_name || ' Co., Ltd.' when 1 then c_name when 2 then c_name || ' GmbH' when 3 then c_name || ' wen da xin' when 4 then c_name else c_name end) as name,
  case c_custkey % 6 when 0 then c_mktsegment || ' Road ' || c_nationkey when 1 then 'No. ' || c_nationkey || ' ' || c_mktsegment || ' Road' when 4 then 'No. ' || c_nationkey || ' ' || c_mktsegment else '' end as address,
  c_custkey % 6 <> 4 as sure from customer""")
def customer_split(t):
    """Name and address of a cell: legal form, line end, form typed twice, a name in two lines, a house number, a name alone."""
    k, name, segment, nation = F.col("c_custkey") % 6, F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")
    cell = (
        F.when(k == 0, F.concat(name, F.lit(" Co., Ltd., "), segment, F.lit(" Road "), nation))
        .when(k == 1, F.concat(name, F.lit(" \nNo. "), nation, F.lit("  "), segment, F.lit(" Road, ")))
        .when(k == 2, F.concat(name, F.lit(" GmbH Ltd.")))
        .when(k == 3, F.concat(name, F.lit("\nwen da  xin")))
        .when(k == 4, F.concat(name, F.lit(", No. "), nation, F.lit(" "), segment))
        .otherwise(F.concat(F.lit(" "), name))
    )
    s = customers.split_customer(cell)
    return t("customer").select("c_custkey", s["name"].alias("name"), s["address"].alias("address"), s["sure"].alias("sure"))


@query("""with v as (select o_orderkey, case o_orderkey % 6 when 0 then 'exhibition' when 1 then 'internal' when 2 then 'internal' else '' end as row_kind, o_orderkey % 6 k, o_orderstatus, o_orderpriority from orders)
  select o_orderkey, row_kind, case when row_kind <> '' then row_kind when k = 3 then 'dealer' when k = 4 and o_orderstatus = 'F' then 'internal' else 'customer' end as kind,
  case k when 3 then 'dealer' when 5 then 'existing' else '' end as customer_type,
  case when row_kind <> '' then row_kind when k = 4 and o_orderstatus = 'F' then 'internal' when o_orderpriority = '5-LOW' then 'cancelled' else 'done' end as status from v""")
def visit_kinds(t):
    """Rows of visit sheets: exhibitions, trainings, sentences, dealers, rows without any customer data, and visits."""
    k = F.col("o_orderkey") % 6
    number = F.col("o_custkey").cast("string")
    cell = (
        F.when(k == 0, F.concat(F.lit("Attend the expo in hall "), number)).when(k == 1, F.concat(F.lit("Training "), number))
        .when(k == 2, F.concat(F.lit("On the way to the customer "), number)).otherwise(F.concat(F.lit("Company "), number))
    )
    row = customers.row_kind(cell)
    kind = F.when(k == 3, "Dealer (new)").when(k == 5, " Existing customer").otherwise("")
    phone = F.when((k == 4) & (F.col("o_orderstatus") == "F"), "").otherwise("138")
    notes = F.array(F.lit("talked"), F.when(F.col("o_orderpriority") == "5-LOW", "Visit CANCELLED").otherwise("went well"))
    v = customers.visit_state(row, kind, [phone, F.lit(None).cast("string")], notes)
    return t("orders").select("o_orderkey", row.alias("row_kind"), v["kind"].alias("kind"), v["customer_type"].alias("customer_type"), v["status"].alias("status"))


_PEOPLE = ["Anna Berg", "Anna Wolf", "Carl Stein", "Dora Lang"]


@query(f"""with p as (select s_suppkey, {_PEOPLE}[s_suppkey % 4 + 1] as one, s_suppkey % 5 k from supplier)
  select s_suppkey, case when k = 1 and one like 'Anna%' then '' when k = 3 then '' else one end as owner, case when k = 1 and one like 'Anna%' then '' else one end as in_file from p""")
def owner_names(t):
    """The person a cell and a file name mean: whole name, first name, name inside a text; two persons or a shared first name are nobody."""
    k = F.col("s_suppkey") % 5
    one = F.get(F.array(*map(F.lit, _PEOPLE)), (F.col("s_suppkey") % 4).cast("int"))
    other = F.get(F.array(*map(F.lit, _PEOPLE)), ((F.col("s_suppkey") + 1) % 4).cast("int"))
    cell = (
        F.when(k == 0, F.concat(F.lit(" "), F.upper(one))).when(k == 1, F.lower(F.substring_index(one, " ", 1)))
        .when(k == 2, F.concat(F.lit("by "), one, F.lit(" for "), F.col("s_name"))).when(k == 3, F.concat_ws(" / ", one, other)).otherwise(one)
    )
    name = F.when(k == 1, F.substring_index(one, " ", 1)).otherwise(one)
    path = F.concat(F.lit("/reports/"), F.col("s_suppkey"), F.lit("_"), F.translate(name, " ", "_"), F.lit("_CW12.xlsx"))
    return t("supplier").select("s_suppkey", customers.owner_of(cell, _PEOPLE).alias("owner"), customers.owner_in_file_name(path, _PEOPLE).alias("in_file"))


@query("""select p_partkey, p_name || ' Works' as topic_company, case p_partkey % 3 when 0 then p_name when 1 then p_name || ' Co., Ltd' else '' end as role_company from part""")
def companies_in_topics(t):
    """The company of a topic and of a person's role."""
    name, k = F.col("p_name"), F.col("p_partkey") % 3
    topic = F.when(k == 0, F.concat(F.lit("Visit to "), name, F.lit(" Works and lunch"))).when(k == 1, F.concat(F.lit("Meeting with "), name, F.lit(" Works (urgent)"))).otherwise(F.concat(F.lit("拜访 "), name, F.lit(" Works，合同")))
    role = F.when(k == 0, F.concat(F.lit("director of "), name)).when(k == 1, F.concat(F.lit("Technical Manager "), name, F.lit(" Co., Ltd"))).otherwise(F.concat(F.lit("manager "), name))
    return t("part").select("p_partkey", customers.topic_company(topic).alias("topic_company"), customers.role_company(role).alias("role_company"))


@query("""with c as (select c_custkey, lpad(cast(c_custkey as varchar), 8, '0') as n, c_custkey % 6 as k from customer)
  select c_custkey, case k when 0 then '+86138' || n || ',+86139' || n when 1 then '+8610' || n when 2 then '+8610' || n when 3 then '+86400' || right(n, 7) when 4 then '' else '+86138' || n end as numbers,
  case k when 1 then '010-' || n || '/65' when 2 then '010-' || n || '-806' when 4 then n when 5 then '138' || n || ' Li' else '' end as texts from c""")
def account_phones(t):
    """Phone cells of accounts: two numbers, a slash with the end of a second, an extension, a service line, a local number, a name behind it."""
    n, k = F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.col("c_custkey") % 6
    cell = (
        F.when(k == 0, F.concat(F.lit("138"), n, F.lit(" / 139"), n)).when(k == 1, F.concat(F.lit("010-"), n, F.lit("/65"))).when(k == 2, F.concat(F.lit("010-"), n, F.lit("-806")))
        .when(k == 3, F.concat(F.lit("400"), F.right(n, F.lit(7)), F.lit(" a@b.com"))).when(k == 4, n).otherwise(F.concat(F.lit("138"), n, F.lit(" Li")))
    )
    rows = t("customer").select("c_custkey")
    # Keys of millions of customers are a small file, which would be read and worked on by one task.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    rows = rows.select("c_custkey", F.when(F.monotonically_increasing_id() >= 0, customers.account_numbers(cell)).alias("got"))
    got = F.col("got")
    return rows.select("c_custkey", F.array_join(got["numbers"], ",").alias("numbers"), F.array_join(got["texts"], ",").alias("texts"))


@query("""with o as (select o_orderkey, cast(o_orderdate as date) d, date_trunc('week', o_orderdate)::date monday from orders)
  select o_orderkey, d as day, case when week(d) = week(monday + 7) then true else false end as next_week, true as own_week from o""")
def weeks_and_months(t):
    """A day number typed without its month goes back into the week of its sheet; a date agrees with its own week and no other."""
    day = F.col("o_orderdate").cast("date")
    monday = F.trunc(day, "week")
    # The same day number, in a month in which every number exists and which is far from the week.
    typed = dates.make_day(F.year(day) - 2, F.when(F.month(day) == 1, 8).otherwise(1), F.dayofmonth(day))
    week, later = F.extract(F.lit("week"), day), F.extract(F.lit("week"), F.date_add(monday, 7))
    rows = t("orders").select("o_orderkey", typed.alias("typed"), monday.alias("monday"), day.alias("d"), week.alias("w"), later.alias("l"))
    return rows.select(
        "o_orderkey", dates.mistyped_month(F.col("typed"), F.col("monday")).alias("day"),
        dates.week_agrees(F.col("d"), F.col("l"), F.lit(None).cast("int")).alias("next_week"), dates.week_agrees(F.col("d"), F.col("w"), F.lit(0)).alias("own_week"),
    )


@query("""with o as (select o_orderkey, cast(o_orderdate as date) d, cast(o_orderkey % 52 + 1 as int) w from orders),
  y as (select o_orderkey, d, yr, date_trunc('week', make_date(yr, 1, 4))::date + 7 * (w - 1) as monday from o, lateral (select unnest([year(d) - 1, year(d), year(d) + 1]) as yr))
  select o_orderkey, cast(arg_min(yr, (abs(monday - d), yr)) as int) as year from y group by o_orderkey""")
def nearest_years(t):
    """The year of a week number that stands alone, by the file's date."""
    rows = t("orders").select("o_orderkey", (F.col("o_orderkey") % 52 + 1).cast("int").alias("w"), F.col("o_orderdate").cast("date").alias("d"))
    return rows.select("o_orderkey", dates.nearest_week_year(F.col("w"), F.col("d")).alias("year"))


@query("""with l as (select l_orderkey, list_distinct(list(l_partkey)) parts from lineitem group by 1), k as (select p_partkey, p_brand, p_type from part where p_retailprice > 1000),
  f as (select l_orderkey, array_to_string(list_sort(list_distinct(list(v))), ',') found from (select l_orderkey, unnest(parts) p from l) join (select p_partkey, unnest([p_brand, p_type]) v from k) on p = p_partkey group by 1)
  select l.l_orderkey, coalesce(found, '') as found from l left join f using (l_orderkey)""")
def references_of_documents(t):
    """Orders with the marks of all their parts that are known, as messages get the references of their documents."""
    rows = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    known = t("part").where("p_retailprice > 1000").select(F.col("p_partkey").alias("p"), F.array("p_brand", "p_type").alias("marks"))
    return lookups.by_any_of(rows, "l_orderkey", "parts", known, "p", "marks").select("l_orderkey", F.array_join("found", ",").alias("found"))


@query("""with d as (select o_custkey, o_orderpriority, sum(cast(o_totalprice as decimal(18,2))) total from orders where o_orderstatus = 'O' group by all),
  s as (select o_custkey, string_agg(o_orderpriority || '=' || total, ';' order by o_orderpriority) sums from d group by 1)
  select c_custkey, coalesce(sums, '') as sums from customer left join s on c_custkey = o_custkey""")
def open_deals_by_currency(t):
    """Customers with the sums of their open orders, one for each priority, which stands in for a currency."""
    facts = t("orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_totalprice")
    out = lookups.with_sums(t("customer").select("c_custkey"), "c_custkey", facts, "o_orderpriority", "o_totalprice")
    spelled = F.transform(F.map_entries("sums"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("c_custkey", F.array_join(spelled, ";").alias("sums"))


@query("""select o_orderkey, cast(o_orderdate as date) + 40 < (select date_trunc('week', max(o_orderdate))::date from orders) as closed from orders""")
def closed_by_cutoff(t):
    rows = t("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return planning.behind_cutoff(rows, F.date_add("d", 40), "d").select("o_orderkey", "closed")


@query("""select p_partkey, case when p_size % 2 = 0 then array_to_string(list_sort(string_split(regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g'), '')), '') else '' end as letters,
  p_size % 2 = 1 as covered from part""")
def letters_left(t):
    """What a name has beyond its translation, letter by letter, and whether all its words are in the other."""
    whole, part = F.concat_ws(" ", "p_name", "p_type"), F.col("p_name")
    taken = F.when(F.col("p_size") % 2 == 0, part).otherwise(F.reverse(whole))
    words = lambda c: F.split(c, " ")
    covered = lookups.covered_by(F.array_distinct(words(whole)), F.when(F.col("p_size") % 2 == 0, words(part)).otherwise(words(whole)))
    return t("part").select("p_partkey", customers.only_letters_left(whole, taken).alias("letters"), covered.alias("covered"))


@query("""select l_orderkey, max(l_linenumber) filter (l_returnflag = 'R' or l_linestatus = 'O') as last_task, count(*) filter ((l_returnflag = 'R' or l_linestatus = 'O') and l_tax <> 0.08) as tasks from lineitem group by l_orderkey
  having true""".replace("max(l_linenumber) filter (l_returnflag = 'R' or l_linestatus = 'O')", "max(l_linenumber) filter ((l_returnflag = 'R' or l_linestatus = 'O') and l_tax <> 0.08)"))
def notes_worth_a_task(t):
    """Lines as notes: returned ones highlighted, open ones dated, those with the highest tax cancelled."""
    note = F.struct(
        F.when(F.col("l_tax") == 0.08, "Cancelled order").otherwise("call again").alias("text"), (F.col("l_returnflag") == "R").alias("highlighted"),
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("date")).alias("deadline"), F.col("l_linenumber").alias("n"),
    )
    rows = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(note).alias("notes")).withColumn("kept", customers.task_notes(F.col("notes")))
    return rows.select("l_orderkey", F.array_max(F.transform("kept", lambda x: x["n"])).alias("last_task"), F.size("kept").cast("bigint").alias("tasks"))


@query("""with e as (select label, vec_id % 4 as col, vec_id from embeddings)
  select label, 'kind' as field, min(col) as col from (select label, col, bool_and(case when col = 1 then true when col = 3 then label % 2 = 0 else false end) ok from e group by all) where ok group by label""")
def columns_by_values(t):
    """Unlabelled columns known by their values: every one a kind of company, in one column or two."""
    k = F.col("vec_id") % 4
    value = F.when((k == 1) | ((k == 3) & (F.col("label") % 2 == 0)), F.when(F.col("vec_id") % 8 < 4, "客户").otherwise(" Supplier ")).otherwise(F.col("vec_id").cast("string"))
    cells = t("embeddings").select("label", k.alias("col"), value.alias("text"))
    return accounts.columns_by_values(cells, ["label"], "col", F.col("text"), {"kind": ["客户", "supplier"], "ledger": ["应收"]})


@query("""with r as (select o_orderkey, o_custkey, o_orderkey % 4 as k, lpad(cast(o_custkey as varchar), 8, '0') n from orders),
  p as (select o_custkey, case when k = 3 then null else 'li wei' end as name, k, n from r)
  select o_custkey, name, case when name is null then '' else array_to_string(list_distinct(list_filter([case when bool_or(k in (0, 2)) then '+86138' || any_value(n) end, case when bool_or(k = 1) then '+8610' || any_value(n) end], x -> x is not null)), ',') end as phones,
  count(*) as dummy from p group by o_custkey, name""".replace("count(*) as dummy", "case when name is null then 'phone ' || any_value(n) else '' end as other").replace("array_to_string(list_distinct(list_filter", "array_to_string(list_sort(list_filter").replace("], x -> x is not null))", "], lambda x: x is not null))"))
def people_of_accounts(t):
    """Orders as contact rows of a customer: a mobile or a switchboard number under one name written two ways, and numbers that name nobody."""
    k, n = F.col("o_orderkey") % 4, F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    rows = t("orders").select(
        "o_custkey", "o_orderkey", F.when(k == 3, None).when(k == 2, F.lit("Li  Wei")).otherwise("li wei").alias("name"),
        F.when(k == 1, F.concat(F.lit("010-"), n)).when(k == 3, n).alias("phone"), F.when(k.isin(0, 2), F.concat(F.lit("138"), n)).alias("mobile"), F.lit("/").alias("email"),
    )
    out = accounts.people(rows, "o_custkey", "o_orderkey", "name", "phone", "mobile", "email")
    name = F.when(F.col("person").isNotNull(), F.lower(F.regexp_replace("name", r"\s+", " ")))
    other = F.when(F.col("person").isNull(), F.array_join(F.filter("other", lambda x: x.startswith("phone")), ",")).otherwise("")
    return out.select("o_custkey", name.alias("name"), F.array_join(F.array_sort("phones"), ",").alias("phones"), other.alias("other"))


@query("""with r as (select s_suppkey, s_suppkey % 5 k, s_nationkey n from supplier) select s_suppkey, 'place' field, 'Jiangsu ' || n as value, 'Suzhou ' || n as kept from r where k = 0
  union all select s_suppkey, 'person', 'Anna Berg', 'Carl Stein' from r where k = 1 union all select s_suppkey, 'product', 'Cutting', 'Rotomotion' from r where k = 2""")
def conflicts_of_meaning(t):
    """Two rows for each supplier whose values differ in spelling only, or in one field really."""
    k, n = F.col("s_suppkey") % 5, F.col("s_nationkey").cast("string")
    first = F.struct(F.lit(1).alias("o"), F.concat(F.lit("苏州 Suzhou "), n).alias("place"), F.lit("Carl Stein").alias("person"), F.lit("2021-05").alias("first_order"), F.lit("Rotomotion").alias("product"))
    first = F.when(k == 0, first.withField("place", F.concat(F.lit("Suzhou "), n))).otherwise(first)
    place = F.when(k == 0, F.concat(F.lit("Jiangsu "), n)).when(k == 3, F.lit("苏州市")).otherwise(F.concat(F.lit("suzhou-"), n))
    second = F.struct(F.lit(2).alias("o"), place.alias("place"), F.when(k == 1, "Anna Berg").when(k == 4, "Stein").otherwise("Stein, Carl").alias("person"), F.lit("2021").alias("first_order"), F.when(k == 2, "Cutting").otherwise("motion").alias("product"))
    rows = t("supplier").select("s_suppkey", F.explode(F.array(first, second)).alias("r")).select("s_suppkey", "r.*")
    kinds = {"place": "place", "person": "person", "first_order": "order", "product": "product"}
    return accounts.conflicts(rows, ["s_suppkey"], F.col("o"), kinds, "o").select("s_suppkey", "field", "value", "kept")


@query("""with m as (select *, event_id % 7 k, 'u' || user_id as me, 'u' || (user_id + 1) % 50 as next from events),
  d as (select me as key, case when k = 0 then 1 else 0 end filed, case when k = 1 then 1 else 0 end filed_other, case when event_type = 'error' then 1 else 0 end mass,
    case when event_type = 'view' and k % 2 = 1 then 1 else 0 end automated, event_type not in ('error') and not (event_type = 'view' and k % 2 = 1) as live, k, event_type, next, me from m),
  x as (select *, live and k % 2 = 0 as sent, live and k % 2 = 1 and event_type = 'purchase' as billed from d), y as (select *, live and k % 2 = 1 and not billed as came from x)
  select key, sum(filed + 0) filed, sum(filed_other) filed_other, sum(mass) mass, sum(automated) automated, sum(sent::int) "out", sum(billed::int) bill, sum(came::int) "in", sum((came and event_type = 'click')::int) in_inquiry,
    sum(((sent or came) and event_type = 'signup')::int) deal, 0 as dummy from y group by key""")
def mail_counters(t):
    """Events as mails of their users: filed, mass, automated, sent, received, bills and inquiries."""
    k, kind = F.col("event_id") % 7, F.col("event_type")
    me = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    no, nobody = F.lit(False), F.array().cast("array<struct<sender:string,keys:array<string>,domains:int>>")
    mails = t("events").select(
        (k % 2 == 0).alias("outbound"), no.alias("own"), (kind == "view").alias("automated"), F.array(me).alias("keys"), F.when(kind == "error", 8).otherwise(1).alias("domains"),
        F.when(k == 0, me).alias("filed_key"), (k < 2).alias("filed"), F.lit(None).cast("string").alias("topic"), no.alias("supplier"), no.alias("product"), (kind == "click").alias("inquiry"),
        (kind == "signup").alias("deal"), (kind == "purchase").alias("bill"), no.alias("our_po"), no.alias("order_ref"), no.alias("service"), no.alias("price"), nobody.alias("quoted"),
    )
    out = mail.all_counters(mails)
    return out.select("key", "filed", "filed_other", "mass", "automated", "out", "bill", "in", "in_inquiry", "deal", F.lit(0).alias("dummy"))


@query("""with p as (select s_nationkey, case when s_suppkey % 3 = 0 then 'sales' else 'info' end || s_nationkey || '@x.com' as email from supplier)
  select array_to_string(list_sort(['nation', chr(97 + s_nationkey % 26)]), ' ') as person, min(email) as email from p group by s_nationkey having count(distinct email) = 1""")
def sole_addresses(t):
    """Names with exactly one address among the suppliers."""
    name = F.concat(F.lit("Nation "), F.char((F.lit(65) + F.col("s_nationkey") % 26).cast("int")))
    email = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "Sales").otherwise("info"), F.col("s_nationkey").cast("string"), F.lit("@x.com"))
    people = t("supplier").select(name.alias("name"), email.alias("email"))
    return mail.sole_addresses(people, "name", "email")


@query("""select doc_id, md5(regexp_replace("text", '\\s+', ' ', 'g')) as body from documents where "text" is not null and trim("text") <> ''""".replace("\\\\s", "\\s"))
def mbox_roundtrip(t):
    """Documents written as mailboxes, each behind a line that begins with "From ", and read back."""
    docs = t("documents").where("text is not null and trim(text) <> ''")
    head = F.concat(F.lit("From - Mon May 18 10:00:00 2026\nMessage-ID: <"), F.col("doc_id").cast("string"), F.lit("@x>\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\nFrom here on\n"))
    path = new_path(docs.sparkSession, "mailboxes")
    docs.select(F.concat(head, F.replace("text", F.lit("\nFrom "), F.lit("\n>From ")), F.lit("\n"))).write.text(path)
    back = mbox.messages(docs.sparkSession, path)
    body = F.regexp_replace(F.regexp_replace("body", "^From here on\n", ""), r"\n+$", "")
    return back.select(F.substring_index("message_id", "@", 1).cast("bigint").alias("doc_id"), F.md5(F.regexp_replace(body, r"\s+", " ")).alias("body"))


@query("""select c_custkey, case when c_custkey % 3 = 0 then 'han' when c_custkey % 3 = 1 then 'latin' else '' end as shape, c_custkey % 3 <> 2 as person, c_custkey % 3 = 2 or (c_custkey % 3 = 1 and c_mktsegment = 'BUILDING') as address from customer""")
def name_shapes(t):
    """Chinese and Latin names of people, and cells that are no person."""
    k = F.col("c_custkey") % 3
    cell = F.when(k == 0, F.lit("王小明")).when(k == 1, F.concat(F.lit("Anna "), F.initcap(F.translate(F.col("c_mktsegment"), "_", "")))).otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")), "yyyy-MM-dd"))
    return t("customer").select("c_custkey", customers.name_shape(cell).alias("shape"), customers.looks_like_person(cell).alias("person"), customers.looks_like_address(cell).alias("address"))
