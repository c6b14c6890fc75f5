"""Scalar functions against tables of cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordloom.functions import dates, emails, numbers, phones, status


def each(spark, function, cases, *more):
    """``function`` over the first items of ``cases``."""
    rows = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(cases)], "k int, x string")
    got = {r.k: r.y for r in rows.select("k", function(F.col("x"), *more).alias("y")).collect()}
    return [(c, got[k]) for k, (c, _) in enumerate(cases)]


def test_numbers(spark):
    cases = [("1,234.50", "1234.5"), ("1.234,50", "1234.5"), ("(12)", "-12"), ("12-", "-12"), ("-12", "-12"), ("1,234", "1234"), ("1,5", "1.5"), ("1.234.567", "1234567"), ("1.2.3", None),
             ("RMB 1'000", "1000"), ("￥１２．５", "12.5"), ("abc", None), ("", None), (None, None), ("+7", "7"), ("(-3)", "3")]
    for (text, got), (_, want) in zip(each(spark, numbers.parse_number, cases), cases, strict=True):
        assert got == (None if want is None else Decimal(want)), text


def test_minor_units(spark):
    row = spark.sql("select cast(2.345 as decimal(10,3)) x, cast(2.355 as decimal(10,3)) y").select(
        numbers.money(F.col("x")).alias("a"), numbers.minor_units(F.col("y")).alias("b"), numbers.minor_units_even(F.lit("0.125").cast("decimal(6,4)")).alias("c"),
        numbers.quote_amount(F.lit(0).cast("decimal(18,2)"), F.lit("2.50").cast("decimal(18,2)"), F.lit(3).cast("decimal(18,2)")).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (Decimal("2.35"), 236, 12, Decimal("7.50"))


def test_phones(spark):
    cases = [("138 0013 8000", "+8613800138000"), ("0086 138 0013 8000", "+8613800138000"), ("86 13800138000", "+8613800138000"), ("010-12345678", "+861012345678"), ("+49 (711) 123", "+49711123"),
             ("Tel: 13800138000", "+8613800138000"), ("n/a", ""), (None, ""), ("12345", "12345"), ("13800138000.0", "+8613800138000")]
    for (text, got), (_, want) in zip(each(spark, phones.phone_e164, cases), cases, strict=True):
        assert got == want, text
    cases = [("+86 021 3416 1967", "+862134161967"), ("+49 0711 123456", "+49711123456"), ("12345", None), ("13800138000", "+8613800138000"), ("021 3416 1967", "+862134161967"), ("0086-13800138000", "+8613800138000")]
    for (text, got), (_, want) in zip(each(spark, phones.mail_e164, cases), cases, strict=True):
        assert got == want, text
    cases = [("13800138000/13900139000", ["13800138000", "13900139000"]), ("010 12345678 (Mr. Li)", ["010 12345678 (Mr. Li)"]), ("1380013800013900139000", ["13800138000", "13900139000"]), ("-", []), ("12 34", ["12 34"])]
    for (text, got), (_, want) in zip(each(spark, phones.phone_numbers, cases), cases, strict=True):
        assert got == want, text


def test_emails(spark):
    cases = [("mail.delta.com", "delta.com"), ("a.iota.com.cn", "iota.com.cn"), ("iota.com.cn", "iota.com.cn"), ("x.y.z.org", "z.org"), ("single", "single")]
    for (text, got), (_, want) in zip(each(spark, emails.org_domain, cases), cases, strict=True):
        assert got == want, text
    cases = [("a@b.com, A@B.com; c.d@e-f.co", ["a@b.com", "c.d@e-f.co"]), ("none", [])]
    for (text, got), (_, want) in zip(each(spark, emails.addresses, cases), cases, strict=True):
        assert got == want, text
    cases = [("x@gmail.com", "x@gmail.com"), ("x@mail.delta.com", "delta.com")]
    for (text, got), (_, want) in zip(each(spark, emails.key_of, cases), cases, strict=True):
        assert got == want, text


def test_week_monday(spark):
    rows = spark.createDataFrame([(2026, 1), (2026, 53), (2027, 53), (2020, 53), (2026, 0)], "y int, w int")
    got = [r.m for r in rows.select(dates.week_monday(F.col("y"), F.col("w")).alias("m")).collect()]
    assert got == [dt.date(2025, 12, 29), dt.date(2026, 12, 28), None, dt.date(2020, 12, 28), None]


def test_deadlines(spark):
    visit = F.lit("2026-12-16").cast("date")  # a Wednesday in week 51
    cases = [("in 3 working days", "2026-12-19"), ("tomorrow", "2026-12-17"), ("next week", "2026-12-21"), ("this week", "2026-12-18"), ("this month", "2026-12-31"), ("CW 2", "2027-01-11"),
             ("week 52", "2026-12-21"), ("in June", "2027-06-01"), ("2026-02-30", None), ("some day", None), ("2026-02-03", "2026-02-03")]
    for (text, got), (_, want) in zip(each(spark, dates.deadline, cases, visit), cases, strict=True):
        assert (got and got.isoformat()) == want, text


def test_general_dates(spark):
    ref = F.lit("2026-05-20").cast("date")
    cases = [("2026-05-13", ("2026-05-13", "")), ("13/5", ("2026-05-13", "")), ("6/5", ("2026-05-06", "ambiguous")), ("5/6/2026", ("2026-05-06", "ambiguous")), ("21/5", ("2026-05-21", "")),
             ("15th June 2026", ("2026-06-15", "")), ("June 15th", ("2026-06-15", "")), ("12 -- 14 May", ("2026-05-12", "range")), ("=D9+1", (None, "formula")), ("", (None, "empty")), ("n/a", (None, "empty")),
             ("soon", (None, "unparsed")), ("2026-02-30", (None, "unparsed")), ("45000", ("2023-03-15", ""))]
    for (text, got), (_, want) in zip(each(spark, dates.general_date, cases, ref), cases, strict=True):
        assert (got.day and got.day.isoformat(), got.flag) == want, text


def test_visit_and_order_dates(spark):
    cases = [("13-May", "2026-05-13"), ("26th,May", "2026-05-26"), ("May 13", "2026-05-13"), ("13/05", "2026-05-13"), ("31/02", None), ("x", None)]
    for (text, got), (_, want) in zip(each(spark, dates.visit_date, cases, F.lit(2026)), cases, strict=True):
        assert (got and got.isoformat()) == want, text
    cases = [("2026-03-04", "2026-03-04"), ("04.03.2026", "2026-03-04"), ("2026年03月04日", "2026-03-04"), ("04-Mar-2026", "2026-03-04"), ("20260304", "2026-03-04"), ("46085", "2026-03-04"), ("99", None), ("", None)]
    for (text, got), (_, want) in zip(each(spark, dates.order_date, cases), cases, strict=True):
        assert (got and got.isoformat()) == want, text


def test_decimal_due(spark):
    visit = F.lit("2026-05-05").cast("date")
    cases = [("5.1", "2026-05-10"), ("5.20", "2026-05-20"), ("1.15", "2027-01-15"), ("13.1", None), ("5.40", None), ("x", None)]
    for (text, got), (_, want) in zip(each(spark, dates.decimal_due, cases, visit), cases, strict=True):
        assert (got and got.isoformat()) == want, text


@pytest.mark.parametrize(("text", "want"), [("2021.12", "2021-12"), ("2020.1", "2020"), ("2020", "2020"), ("2021.5", "2021-05"), ("x", None)])
def test_first_order(spark, text, want):
    assert spark.range(1).select(dates.first_order(F.lit(text)).alias("x")).first().x == want


def test_states(spark):
    cases = [("Partially received", "in_progress"), ("Cancelled", "cancelled"), ("已完成", "completed"), ("???", "other"), (None, "other")]
    for (text, got), (_, want) in zip(each(spark, lambda c: status.state_of(c, status.ORDER_STATES, "other"), cases), cases, strict=True):
        assert got == want, text
    cases = [("", ("open", True)), ("Done", ("done", True)), ("done by Li", ("done", True)), ("whatever", ("open", False)), ("已完成了", ("done", True))]
    for (text, got), (_, want) in zip(each(spark, status.todo_state, cases), cases, strict=True):
        assert (got.state, got.known) == want, text
