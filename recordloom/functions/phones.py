"""Phone numbers.  The spreadsheet rule and the mail rule differ and stay apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MOBILE = "1[3-9]\\d{9}"


def placeholder(text: Column) -> Column:
    """Cells that say there is nothing."""
    return F.lower(F.trim(text)).isin("", "/", "-", "—", "none", "n/a", "not offer", "无", "暂无", "没有")


def phone_e164(raw: Column) -> Column:
    """``+`` and digits where the rules place the number, else the text as written; empty for a placeholder."""
    return e164(raw, lambda value, then: then(value))


def e164(raw: Column, bound: Callable[[Column, Callable[[Column], Column]], Column]) -> Column:
    """:func:`phone_e164`; ``bound(value, then)`` says how ``then`` gets a value that it uses several times (inside a lambda nothing else keeps it from being worked out again)."""

    def placed(text: Column, s: Column) -> Column:
        return (
            F.when(text.isNull() | placeholder(text), "")
            .when(s.startswith("+"), F.concat(F.lit("+"), F.regexp_replace(s, "\\D", "")))
            .when(s.rlike("^86\\d{11}$"), F.concat(F.lit("+"), s))
            .when(s.rlike(f"^{_MOBILE}$"), F.concat(F.lit("+86"), s))
            .when(s.rlike("^0\\d{9,11}$"), F.concat(F.lit("+86"), F.substring(s, 2, 20)))
            .otherwise(text)
        )

    def stripped(text: Column) -> Column:
        s = F.regexp_replace(text, "[\\s\\-().（）/]", "")
        s = F.regexp_replace(s, "(?i)^(?:tel|t|f|m|mob|fax)[:：]?(?=[+\\d])", "")
        return F.regexp_replace(s, "^00", "+")

    return bound(F.regexp_replace(F.trim(raw), "^(\\d+)\\.0$", "$1"), lambda text: bound(stripped(text), lambda s: placed(text, s)))


def mail_e164(raw: Column) -> Column:
    """``+`` and 8 to 15 digits, or null where the number cannot be placed; a trunk 0 behind some country codes goes."""
    s, digits = F.trim(raw), F.regexp_replace(raw, "\\D", "")
    n = F.length(digits)
    number = (
        F.when(s.startswith("+"), F.concat(F.lit("+"), digits))
        .when(digits.startswith("0086") & (n >= 13), F.concat(F.lit("+"), F.substring(digits, 3, 40)))
        .when((n == 11) & digits.startswith("1"), F.concat(F.lit("+86"), digits))
        .when((n == 13) & digits.startswith("86"), F.concat(F.lit("+"), digits))
        .when(digits.startswith("0") & n.between(10, 12), F.concat(F.lit("+86"), F.substring(digits, 2, 40)))
    )
    number = F.regexp_replace(F.regexp_replace(number, "^\\+860(\\d)", "+86$1"), "^\\+(49|43|41)0(\\d)", "+$1$2")
    return F.when(number.rlike("^\\+\\d{8,15}$"), number)


def phone_type(number: Column) -> Column:
    """``mobile`` for a Chinese mobile number, ``work`` for any other."""
    return F.when(number.rlike(f"^\\+86{_MOBILE}$"), "mobile").otherwise("work")


def phone_tail(text: Column) -> Column:
    """The last nine digits, by which numbers are compared."""
    return F.right(F.regexp_replace(text, "\\D", ""), F.lit(9))


def phone_chunks(text: Column) -> Column:
    """What looks like a phone number in a text."""
    return F.regexp_extract_all(text, F.lit("\\+?\\(?\\d[\\d ()/.-]{6,}\\d"), F.lit(0))


def phone_numbers(text: Column) -> Column:
    """Every number of a cell, in order: short tokens go before the next, runs of over 13 digits are two numbers."""
    tokens = F.filter(F.split(text, "[/,;，；、\\s]+"), lambda t: t != "")
    digits = lambda t: F.length(F.regexp_replace(t, "\\D", ""))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(a: Column, t: Column) -> Column:
        joined = F.trim(F.concat_ws(" ", a["open"], t))
        whole = digits(t) >= 7
        return F.struct(F.when(whole, F.array_append(a["done"], joined)).otherwise(a["done"]).alias("done"), F.when(whole, "").otherwise(joined).alias("open"))

    def end(a: Column) -> Column:
        last = F.size(a["done"])
        tailed = F.concat(F.slice(a["done"], F.lit(1), F.greatest(last - 1, F.lit(0))), F.array(F.concat_ws(" ", F.get(a["done"], last - 1), a["open"])))
        return F.when(a["open"] == "", a["done"]).when(last > 0, tailed).otherwise(F.array(a["open"]))

    def cut(g: Column) -> Column:
        n = F.length(g)
        at = F.when(n % 2 == 0, F.floor(n / 2).cast("int")).otherwise(11)
        return F.when(g.rlike("^\\d{14,}$"), F.array(F.substring(g, F.lit(1), at), F.substring(g, at + 1, n))).otherwise(F.array(g))

    return F.when(text.isNull() | placeholder(text), F.array().cast("array<string>")).otherwise(F.flatten(F.transform(F.aggregate(tokens, start, step, end), cut)))


def looks_like_phone(text: Column) -> Column:
    return (F.length(F.regexp_replace(text, "\\D", "")) >= 6) & (F.length(F.regexp_replace(text, "[^\\p{L}]", "")) <= 4)
