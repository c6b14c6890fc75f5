"""Queries on saved pages: chains of cursors and the companies in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import paged
from .registry import query


def saved_pages(t):
    """Customers in pages of five, a chain for each market segment; the second segment lacks its fourth page, in the third a page leads back, and every chain's third page was saved twice."""
    from pyspark.sql import Window

    place = Window.partitionBy("c_mktsegment").orderBy("c_custkey")
    c = t("customer").select("c_mktsegment", "c_custkey", "c_name", F.floor((F.row_number().over(place) - 1) / 5).alias("page"))
    pages = c.groupBy("c_mktsegment", "page").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("items"))
    last = pages.groupBy("c_mktsegment").agg(F.max("page").alias("last"))
    number = last.select("c_mktsegment", "last", (F.dense_rank().over(Window.orderBy("c_mktsegment"))).alias("s"))
    cursor = lambda n: F.concat(F.lit("p"), n.cast("string"))
    p = F.col("page")
    onward = F.when((F.col("s") == 3) & (p == 2), cursor(p - 1)).when(p < F.col("last"), cursor(p + 1))
    rows = pages.join(number, "c_mktsegment").where(~((F.col("s") == 2) & (p == 3)))
    rows = rows.select("c_mktsegment", F.when(p > 0, cursor(p)).alias("cursor"), onward.alias("following"), "items")
    return rows.unionByName(rows.where("cursor = 'p2'"))


_PAGES = """c as (select c_mktsegment as g, c_custkey, c_name, (row_number() over (partition by c_mktsegment order by c_custkey) - 1) // 5 as page, dense_rank() over (order by c_mktsegment) as s from customer),
p as (select g, s, page, max(page) over (partition by g) as last from (select distinct g, s, page from c)),
q as (select g, s, page, case when s = 3 and page = 2 then page - 1 when page < last then page + 1 end as following from p where not (s = 2 and page = 3)),
recursive_start as (select 1)"""


@query(f"""with recursive {_PAGES},
r as (select g, page, following, 0 as nth from q where page = 0 union all select q.g, q.page, q.following, r.nth + 1 from r join q on q.g = r.g and q.page = r.following where q.page > r.page)
select c.g as segment, r.nth::bigint as nth, (row_number() over (partition by c.g, c.page order by c_custkey) - 1)::int as at, c.c_custkey, c.c_name from c join r on r.g = c.g and r.page = c.page""")
def paged_customers(t):
    """Customers of the pages that their chains reach, in order."""
    got = paged.records(saved_pages(t), "cursor", "following", "items", "c_mktsegment")
    return got.select(F.col("source").alias("segment"), "nth", "at", "item.*")


@query(f"""with recursive {_PAGES},
r as (select g, page, following, 0 as nth from q where page = 0 union all select q.g, q.page, q.following, r.nth + 1 from r join q on q.g = r.g and q.page = r.following where q.page > r.page)
select g as segment, 'p2' as cursor, 'repeated' as finding from q where page = 2
union all select g, 'p3', 'missing' from q where s = 2 and page = 2 and following = 3
union all select g, 'p' || page, 'unreached' from q where page > 0 and (g, page) not in (select (g, page) from r)
union all select g, 'p2', 'loop' from q where s = 3 and page = 2""")
def paging_findings(t):
    """What breaks the chains."""
    _, findings = paged.chained(saved_pages(t), "cursor", "following", "c_mktsegment")
    return findings.withColumnRenamed("source", "segment")


@query("""with a as (select 'CR' || c_custkey as code, c_name as cn, case when c_custkey % 2 = 0 then 'Target ' || c_custkey end as en, c_custkey as r from customer where c_custkey % 3 <> 0),
  b as (select case when c_custkey % 4 <> 0 then 'CR' || c_custkey end as code, c_name as cn, 'File ' || c_custkey as en, c_custkey as r from customer where c_custkey % 5 <> 0)
  select coalesce(a.code, b.code) as code, coalesce(a.cn, b.cn) as cn, coalesce(a.en, b.en) as en, case when a.cn is not null then 'target' else 'files' end as origin from a full join b on a.cn = b.cn""")
def master_of_two_sources(t):
    """Customers as the target holds them, and as files list them: by code, or by name where the file has no code."""
    c, k = t("customer"), F.col("c_custkey")
    none = F.lit(None).cast("string")
    target = c.where(k % 3 != 0).select(F.concat(F.lit("CR"), k).alias("code"), F.col("c_name").alias("cn"), F.when(k % 2 == 0, F.concat(F.lit("Target "), k)).alias("en"), none.alias("short"), k.alias("rank"))
    files = c.where(k % 5 != 0).select(F.when(k % 4 != 0, F.concat(F.lit("00cr"), k)).alias("code"), F.col("c_name").alias("cn"), F.concat(F.lit("File "), k).alias("en"), none.alias("short"), k.alias("rank"))
    return paged.companies(target, files).drop("short")
