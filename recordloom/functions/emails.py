"""Mail addresses and the organisations behind their domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADDRESS = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}"
SECOND_LEVEL = ("com", "net", "org", "co", "gov", "edu", "ac")
FREE_MAIL = ("gmail.com", "outlook.com", "hotmail.com", "yahoo.com", "icloud.com", "qq.com", "163.com", "126.com", "sina.com", "foxmail.com")
ROLE_BOXES = "^(?:no-?reply|do-?not-?reply|mailer-daemon|postmaster|bounce|notification|newsletter)s?\\b"


def addresses(text: Column) -> Column:
    """Distinct addresses in small letters, in the order of their first place."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(ADDRESS), F.lit(0)), F.lower))


def domain_of(address: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(address, "@([^@]+)$", 1)), F.lit(""))


def org_domain(domain: Column) -> Column:
    """``mail.delta.com`` to ``delta.com``; ``iota.com.cn`` stays."""
    parts = F.split(F.lower(domain), "\\.")
    n = F.size(parts)
    long = (n >= 3) & F.get(parts, n - 2).isin(*SECOND_LEVEL) & (F.length(F.get(parts, n - 1)) == 2)
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), n - F.when(long, 2).otherwise(1)), F.lit(3)), ".")


def company_name(domain: Column) -> Column:
    """A readable name: the last label that is no common ending, with capitals."""
    parts = F.filter(F.split(F.lower(domain), "\\."), lambda p: ~p.isin("www", "mail", "example", *SECOND_LEVEL) & (F.length(p) > 2))
    name = F.coalesce(F.get(parts, F.size(parts) - 1), domain)
    return F.initcap(F.regexp_replace(name, "-", " "))


def key_of(address: Column) -> Column:
    """The address itself at a free mail host, else its organisation."""
    domain = domain_of(address)
    return F.when(domain.isin(*FREE_MAIL), F.lower(address)).otherwise(org_domain(domain))


def domain_suffixes(domain: Column) -> Column:
    """A domain and every domain it lies below: an equality join then does what "is or ends with" asks."""
    parts = F.split(F.lower(domain), "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def is_role_box(address: Column) -> Column:
    return F.lower(address).rlike(ROLE_BOXES)
