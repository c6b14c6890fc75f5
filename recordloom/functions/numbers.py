"""Numbers and money as people write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_WIDTH = "０１２３４５６７８９．，（）－＋"
HALF_WIDTH = "0123456789.,()-+"


def parse_number(text: Column) -> Column:
    """A decimal(38,6) from any locale's spelling, null if it is none.

    Currency words and signs go; ``(x)``, ``x-`` and ``-x`` are negative; with
    both separators the last one is the decimal point; commas in groups of three
    group, any other comma is a decimal point; several points must group.
    """

    def once(value: Column, then) -> Column:
        # Worked out once, however often ``then`` uses it: written out, the expression would hold its first step hundreds of times.
        return F.get(F.transform(F.array(value), then), 0)

    def unsigned(s: Column) -> Column:
        bracketed = s.rlike("^\\(.*\\)$")
        return once(F.when(bracketed, F.regexp_replace(s, "^\\(|\\)$", "")).otherwise(s), lambda inner: trailed(bracketed, inner))

    def trailed(bracketed: Column, s: Column) -> Column:
        trailing = s.endswith("-")
        return once(F.regexp_replace(s, "-$", ""), lambda rest: signed(bracketed.cast("int") + trailing.cast("int"), rest))

    def signed(negative: Column, s: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(s, "^-", ""), "^\\++", "")
        body = once(digits, lambda d: F.when(d.rlike("^[\\d.,']+$"), F.regexp_replace(d, "'", "")))
        odd = (F.when(negative > 0, 1).otherwise(0) + s.startswith("-").cast("int")) % 2 == 1
        return once(once(body, plain).try_cast("decimal(38,6)"), lambda value: F.when(odd, -value).otherwise(value))

    def plain(body: Column) -> Column:
        last_comma = F.length(body) - F.locate(",", F.reverse(body))
        last_point = F.length(body) - F.locate(".", F.reverse(body))
        return (
            F.when(body.contains(",") & body.contains(".") & (last_comma > last_point), F.regexp_replace(F.regexp_replace(body, "\\.", ""), ",", "."))
            .when(body.contains(",") & body.contains("."), F.regexp_replace(body, ",", ""))
            .when(body.rlike("^\\d{1,3}(,\\d{3})+$"), F.regexp_replace(body, ",", ""))
            .when(body.contains(","), F.regexp_replace(body, ",", "."))
            .when(body.rlike("\\..*\\.") & body.rlike("^\\d{1,3}(\\.\\d{3})+$"), F.regexp_replace(body, "\\.", ""))
            .when(body.rlike("\\..*\\."), F.lit(None).cast("string"))
            .otherwise(body)
        )

    s = F.regexp_replace(F.translate(text, FULL_WIDTH, HALF_WIDTH), "[\\s\\u00a0]", "")
    return once(F.regexp_replace(s, "(?i)rmb|cny|eur|usd|¥|€|\\$|元|￥", ""), unsigned)


def money(value: Column) -> Column:
    """Two decimals, halves away from zero."""
    return value.cast("decimal(18,2)")


def minor_units(value: Column) -> Column:
    """Hundredths as a long, halves away from zero."""
    return F.round(value.cast("decimal(20,4)") * 100).cast("long")


def minor_units_even(value: Column) -> Column:
    """Hundredths as a long, halves to the even neighbour."""
    return F.bround(value.cast("decimal(20,4)") * 100).cast("long")


def forecast_units(text: Column) -> Column:
    """``12台`` or ``12`` to 12; null for anything else."""
    return F.regexp_extract(text, "^\\s*(\\d{1,9})\\s*(?:台|sets?|units?|pcs)?\\s*$", 1).try_cast("int")


def amount_spellings(minor: Column) -> Column:
    """How an amount in hundredths may be written in a text."""
    value = (minor / 100).cast("decimal(18,2)")
    plain = value.cast("string")
    grouped = F.format_number(value, 2)
    swapped = F.translate(grouped, ",.", ".,")
    whole = F.when(minor % 100 == 0, F.array(F.regexp_replace(plain, "\\.00$", ""), F.regexp_replace(grouped, "\\.00$", ""))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(plain, grouped, swapped), whole))


def quote_amount(total: Column, price: Column, quantity: Column) -> Column:
    """The total, else price times quantity (one if unknown), a zero counting as not given."""
    some = lambda x: F.nullif(x, F.lit(0).cast("decimal(18,2)"))
    return F.coalesce(some(total), money(price * F.coalesce(some(quantity), F.lit(1).cast("decimal(18,2)"))))
