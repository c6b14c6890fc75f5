"""Dates, deadlines and weeks as people write them.

Column functions for the spellings of each kind of sheet.  Where a spelling is
read in more than one way, the reading nearest to a reference day wins, and the
flag that says how sure it is travels with the value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Spellings of an order date, tried in this order.
ORDER_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "dd.MM.yyyy HH:mm:ss", "yyyy年MM月dd日", "dd-MMM-yyyy", "dd MMM yyyy", "yyyyMMdd")
NEAR_DAYS = 10
ROLL_DAYS = 60


def make_day(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where there is no such day."""
    parts = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    good = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.when(good, F.try_to_date(parts, "yyyy-MM-dd"))


def month_number(name: Column) -> Column:
    """Of a month's name or its first three letters."""
    return F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(F.lower(name), 1, 3)), F.lit(0)).cast("int")


def week_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week; null for a week the year doesn't have."""
    monday = F.date_add(F.trunc(make_day(year, F.lit(1), F.lit(4)), "week"), (7 * (week - 1)).cast("int"))
    own = F.extract(F.lit("yearofweek"), monday)
    return F.when(week.between(1, 53) & (own == year), monday)


def iso_week(day: Column) -> Column:
    """Year and week of a date, as a struct."""
    return F.struct(F.extract(F.lit("yearofweek"), day).cast("int").alias("year"), F.extract(F.lit("week"), day).cast("int").alias("week"))


def serial_day(number: Column) -> Column:
    """A spreadsheet's day number, for numbers that can be one."""
    return F.when(number.between(20000, 80000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number).cast("int")))


def order_date(text: Column) -> Column:
    """First of eleven spellings that fits, or a day number."""
    s = F.trim(text)
    tries = [F.try_to_timestamp(s, F.lit(f)).cast("date") for f in ORDER_FORMATS]
    return F.coalesce(*tries, serial_day(s.try_cast("double")))


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def _whole(text: Column, pattern: str, k: int) -> Column:
    return _group(text, pattern, k).try_cast("int")


def visit_date(text: Column, year: Column) -> Column:
    """``13-May``, ``26th,May``, ``May 13`` and ``13/05`` (day first) in a year that is known."""
    s = F.trim(text)
    a, b, c = r"^(\d{1,2})(?:st|nd|rd|th)?[\s,.-]*([A-Za-z]{3,})$", r"^([A-Za-z]{3,})[\s,.-]*(\d{1,2})(?:st|nd|rd|th)?$", r"^(\d{1,2})/(\d{1,2})$"
    return F.coalesce(
        make_day(year, month_number(_group(s, a, 2)), _whole(s, a, 1)),
        make_day(year, month_number(_group(s, b, 1)), _whole(s, b, 2)),
        make_day(year, _whole(s, c, 2), _whole(s, c, 1)),
    )


def _nearest(candidates: Column, ref: Column) -> Column:
    """The candidate nearest to ``ref``, the first of equals, with its distance."""
    ranked = F.transform(candidates, lambda c, k: F.struct(F.abs(F.date_diff(c, ref)).alias("off"), k.alias("k"), c.alias("day")))
    return F.array_min(ranked)


def _text_date(s: Column, ref: Column, year: Column) -> Column:
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[ T].*)?$"
    num = r"^(\d{1,2})/(\d{1,2})(?:/(\d{4}))?$"
    dm = r"^(\d{1,2})(?:st|nd|rd|th)?[\s,.-]*([A-Za-z]{3,})\.?[\s,.-]*(\d{4})?$"
    md = r"^([A-Za-z]{3,})\.?[\s,.-]*(\d{1,2})(?:st|nd|rd|th)?(?:[\s,.-]+(\d{4}))?$"
    known = F.coalesce(year, F.year(ref))
    of = lambda pattern: F.coalesce(_whole(s, pattern, 3), known)
    out = lambda day, flag: F.struct(day.cast("date").alias("day"), flag.alias("flag"))
    bad = lambda flag: out(F.lit(None), F.lit(flag))
    dated = lambda day: F.when(day.isNull(), bad("unparsed")).otherwise(out(day, F.lit("")))
    both = F.array_compact(F.array(make_day(of(num), _whole(s, num, 2), _whole(s, num, 1)), make_day(of(num), _whole(s, num, 1), _whole(s, num, 2))))
    both = F.array_distinct(both)
    best = _nearest(both, ref)
    slashed = (
        F.when(of(num).isNull(), bad("no_year"))
        .when(F.size(both) == 0, bad("unparsed"))
        .when(F.size(both) == 1, out(both[0], F.lit("")))
        .when(ref.isNull(), out(both[0], F.lit("ambiguous")))
        .otherwise(out(best["day"], F.when(best["off"] <= NEAR_DAYS, "").otherwise("ambiguous")))
    )

    def named(pattern: str, month: int, day: int) -> Column:
        m = month_number(_group(s, pattern, month))
        return F.when(m.isNull(), bad("unparsed")).when(of(pattern).isNull(), bad("no_year")).otherwise(dated(make_day(of(pattern), m, _whole(s, pattern, day))))

    return (
        F.when(s.rlike(iso), dated(make_day(_whole(s, iso, 1), _whole(s, iso, 2), _whole(s, iso, 3))))
        .when(s.rlike(num), slashed).when(s.rlike(dm), named(dm, 2, 1)).when(s.rlike(md), named(md, 1, 2)).otherwise(bad("unparsed"))
    )


def general_date(text: Column, ref: Column, year: Column | None = None) -> Column:
    """``day, flag`` of a cell's text.

    Flags: empty (clean), ``ambiguous``, ``range`` (the first day is taken),
    ``formula`` (not resolved here), ``empty``, ``unparsed`` and ``no_year``.
    Day and month are told apart by the distance to ``ref``.
    """
    year = F.lit(None).cast("int") if year is None else year
    s = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "\\s+", " "))
    out = lambda day, flag: F.struct(day.cast("date").alias("day"), F.lit(flag).alias("flag"))
    none = F.lit(None)
    first, second = F.trim(F.regexp_extract(s, "^(.*?)\\s*(?:--|–)", 1)), F.regexp_extract(s, "(?:--|–)(.*)$", 1)
    month, later = F.regexp_extract(second, "[A-Za-z]{3,}", 0), F.regexp_extract(second, "\\d{4}", 0)
    first = F.when(~first.rlike("[A-Za-z]{3,}") & (month != ""), F.concat_ws(" ", first, month)).otherwise(first)
    first = F.when(~first.rlike("\\d{4}") & (later != ""), F.concat_ws(" ", first, later)).otherwise(first)
    begin = _text_date(first, ref, year)
    serial = serial_day(s.try_cast("double"))
    return (
        F.when(s.isin("", "-", "--", "/", "—", "none", "n/a", "无", "暂无", "没有"), out(none, "empty"))
        .when(s.startswith("="), out(none, "formula"))
        .when(serial.isNotNull(), out(serial, ""))
        .when(s.rlike("--|–"), F.when(begin["day"].isNotNull(), out(begin["day"], "range")).otherwise(out(none, "unparsed")))
        .otherwise(_text_date(s, ref, year))
    )


def this_year(day: Column, ref: Column) -> Column:
    """A day before 1990 is one whose year was never typed: it gets the reference day's."""
    return F.when(F.year(day) < 1990, make_day(F.year(ref), F.month(day), F.dayofmonth(day))).otherwise(day)


def decimal_due(text: Column, visit: Column) -> Column:
    """``M.DD`` as a due date: 5.1 may be the 1st or the 10th; the nearest on or after the visit, next year if it is long past."""
    pattern = r"^\s*(\d{1,2})\.(\d{1,2})\s*$"
    month, digits = _whole(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    days = F.when((F.length(digits) == 1) & (digits.try_cast("int") * 10 <= 31), F.array(digits.try_cast("int"), digits.try_cast("int") * 10)).otherwise(F.array(digits.try_cast("int")))

    def rolled(d: Column) -> Column:
        day = make_day(F.year(visit), month, d)
        return F.when(F.date_diff(visit, day) > ROLL_DAYS, make_day(F.year(visit) + 1, month, d)).otherwise(day)

    found = F.array_compact(F.transform(days, rolled))
    ahead = F.filter(found, lambda d: d >= visit)
    return F.when(text.rlike(pattern), F.when(F.size(ahead) > 0, F.array_min(ahead)).otherwise(F.array_max(found)))


def deadline(phrase: Column, visit: Column) -> Column:
    """The day a phrase points at, counted from the visit: ``in 3 working days``, ``next week``, ``CW 21``, ``in June`` and so on."""
    s, low = F.trim(phrase), F.lower(F.trim(phrase))
    weekday = F.weekday(visit)
    days = _whole(low, r"\bin\s+(\d{1,3})\s+(?:working\s+)?days?\b", 1)
    week = _whole(low, r"\b(?:cw|week)\s*(\d{1,2})\b", 1)
    month = F.regexp_extract(low, r"\bin\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b", 1)
    number = month_number(month)
    week_year = F.year(visit) + F.when(week < F.extract(F.lit("week"), visit) - 26, 1).otherwise(0)
    return (
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
        .when(days.isNotNull(), F.date_add(visit, days))
        .when(low.contains("tomorrow"), F.date_add(visit, 1))
        .when(low.contains("next week"), F.date_add(visit, 7 - weekday))
        .when(low.contains("this week"), F.date_add(visit, F.greatest(F.lit(0), 4 - weekday)))
        .when(low.contains("this month"), F.last_day(visit))
        .when(week.isNotNull(), week_monday(week_year, week))
        .when(number.isNotNull(), make_day(F.year(visit) + F.when(number < F.month(visit), 1).otherwise(0), number, F.lit(1)))
    )


def first_order(text: Column) -> Column:
    """``2021.12`` as ``2021-12`` and ``2020`` as ``2020``; of ``2020.1`` only the year is sure."""
    s = F.trim(text)
    year, month = F.regexp_extract(s, r"^((?:19|20)\d{2})(?:[./-](\d{1,2}))?$", 1), F.regexp_extract(s, r"^((?:19|20)\d{2})(?:[./-](\d{1,2}))?$", 2)
    good = month.try_cast("int").between(1, 12)
    sure = good & ~s.rlike(r"\.1$")
    return F.when(year == "", None).when(sure, F.concat_ws("-", year, F.lpad(month, 2, "0"))).when((month == "") | good, year)


def never_filled(text: Column) -> Column:
    """``2026-x-xx`` and the like."""
    return F.lower(F.regexp_replace(text, "\\s", "")).rlike(r"^(?=.*x)[\dx\-/.]+$")


def date_spellings(day: Column) -> Column:
    """How a date may be written in a text."""
    formats = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "dd.MM.yyyy", "d.M.yyyy", "dd/MM/yyyy", "d/M/yyyy", "MM/dd/yyyy", "yyyy年M月d日", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd")
    return F.array_distinct(F.array(*[F.date_format(day, f) for f in formats]))


def stamp_in_name(name: Column) -> Column:
    """The ``YYYYMMDD`` in a file name."""
    return F.try_to_date(F.regexp_extract(name, r"(?<!\d)((?:19|20)\d{6})(?!\d)", 1), "yyyyMMdd")


def visit_slot(day: Column, order: Column, zone: str = "UTC") -> Column:
    """Nine o'clock for a day's first visit and two hours more for each that follows."""
    start = F.to_utc_timestamp(day.cast("timestamp_ntz") + F.expr("interval 9 hours"), zone)
    return start + F.make_dt_interval(F.lit(0), (2 * order).cast("int"))


def mistyped_month(day: Column, monday: Column) -> Column:
    """A date typed as a mere day number, which lies more than a week off its sheet's week: the same day number in that week (one day before it, or two behind, at most), else unchanged."""
    guesses = [make_day(F.year(a), F.month(a), F.dayofmonth(day)) for a in (monday, F.date_add(monday, 6))]
    close = [F.when(F.date_diff(g, monday).between(-1, 7), g) for g in guesses]
    return F.when(F.abs(F.date_diff(day, monday)) > 7, F.coalesce(*close, day)).otherwise(day)


def week_agrees(day: Column, *weeks: Column) -> Column:
    """The date lies in each of the ISO weeks that are known; false without a date."""
    out = day.isNotNull()
    for week in weeks:
        out = out & F.coalesce(F.extract(F.lit("week"), day) == F.nullif(week, F.lit(0)), F.lit(True))
    return F.coalesce(out, F.lit(False))


def nearest_week_year(week: Column, modified: Column) -> Column:
    """Of the three years around a file's date the one whose week lies nearest; its own year for an unknown week."""
    years = [F.year(modified) + d for d in (-1, 0, 1)]
    near = F.array_compact(F.array(*[F.when(week_monday(y, week).isNotNull(), F.struct(F.abs(F.date_diff(week_monday(y, week), modified)).alias("off"), y.alias("year"))) for y in years]))
    return F.coalesce(F.array_min(near)["year"], F.year(modified))
