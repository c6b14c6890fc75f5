"""What goes into a family's reader must come out of it: every row as a record or with a reason, every amount as the cell states it.

A family says how its cells become lines, records and reasons (:class:`Family`); the
check is the same for all.  Its findings are a table, empty when all is well.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_number
from ..functions.text import cell_text
from ..sources.shared import stored
from . import account_sheets, families
from .headers import SHEET


class Reading(NamedTuple):
    """What a reader made of cells: ``records`` and ``review``, both with ``file, sheet, row``."""

    records: DataFrame
    review: DataFrame


class Family(Protocol):
    """What the check must know of a family of workbooks."""

    name: str
    #: Amounts of a record that must be what its row's cells say.
    amounts: Sequence[str]

    def lines(self, cells: DataFrame) -> DataFrame:
        """``file, sheet, row, n`` and the amounts: rows that hold data of this family and how many records each can give."""
        ...

    def read(self, cells: DataFrame) -> Reading: ...


@dataclass(frozen=True)
class Labelled:
    """A family of ``operators.families``: what lies below its headers, in their columns, is data."""

    name: str
    amounts: Sequence[str] = ()

    def lines(self, cells: DataFrame) -> DataFrame:
        family = families.FAMILIES[self.name]
        tidy = cells.withColumn("text", cell_text(F.col("text")))
        placed = tidy.where("text is not null").join(families.labelled(tidy, family), [*SHEET, "col"]).where("row > header_row and (until is null or row < until)")
        # Each cell is parsed once, apart from the reader's own columns; a row holds as many as its headers name.
        number = F.when(F.col("field").isin(*self.amounts), parse_number(F.col("text"))) if self.amounts else F.lit(None).cast("double")
        held = placed.groupBy(*SHEET, "row").agg(F.count_distinct("header_row").alias("n"), F.collect_list(F.struct("field", number.alias("value"))).alias("held"))
        of = lambda f: F.array_max(F.transform(F.filter("held", lambda h: h["field"] == f), lambda h: h["value"]))
        return held.select(*SHEET, "row", "n", *[of(f).alias(f) for f in self.amounts])

    def read(self, cells: DataFrame) -> Reading:
        # Records and review are parts of one reading, which is not made twice.
        return Reading(*families.parted(stored(families.rows_read(cells, self.name), "rows"), self.name))


@dataclass(frozen=True)
class CustomerLists:
    """The lists of ``operators.account_sheets``: rows of a region below a header, several regions side by side."""

    name: str = "customer lists"
    amounts: Sequence[str] = ()

    def lines(self, cells: DataFrame) -> DataFrame:
        placed = account_sheets.regions(cells.select(*SHEET, "row", "col", "text"))
        heads = account_sheets.headers(placed)
        columns = heads.select(*SHEET, "block", F.col("row").alias("head"), F.explode("fields").alias("field", "col"))
        below = placed.join(columns, [*SHEET, "block", "col"]).where("row > head").groupBy(*SHEET, "block", "row").agg(F.max("head").alias("head"))
        # A row under a header in columns that only an earlier header knows belongs to none.
        last = placed.select(*SHEET, "block", "row").distinct().join(heads.select(*SHEET, "block", F.col("row").alias("start")), [*SHEET, "block"]).where("start <= row")
        last = last.groupBy(*SHEET, "block", "row").agg(F.max("start").alias("head"))
        return below.join(last, [*SHEET, "block", "row", "head"], "left_semi").groupBy(*SHEET, "row").agg(F.count("*").alias("n"))

    def read(self, cells: DataFrame) -> Reading:
        got = account_sheets.read(cells)
        return Reading(got.records, got.review)


#: The families that are read row by row.
ADAPTERS: Mapping[str, Family] = {
    "orders": Labelled("orders", ("quantity", "net", "tax", "gross")), "receivables": Labelled("receivables", ("amount",)), "quotes": Labelled("quotes", ("price", "total")),
    "todos": Labelled("todos"), "accounts": Labelled("accounts"), "contacts": Labelled("contacts"), "customer lists": CustomerLists(),
}


def balance(cells: DataFrame, family: Family) -> DataFrame:
    """``file, sheet, row, n_in, n_out, reviewed`` and each amount as ``…_in`` and ``…_out``: a row for each row of a sheet that went in or came out.

    Two outer joins on the row's place, of tables that were written before: a
    reader's expressions are long, and one plan of all would be compiled for minutes.
    Amounts of several records of a row are added; those of the cells have the reader's type.
    """
    place, amounts = [*SHEET, "row"], list(family.amounts)
    got = family.read(cells)
    lines = stored(family.lines(cells), "lines").select(*place, F.col("n").cast("long").alias("n_in"), *[F.col(a).cast(got.records.schema[a].dataType).alias(f"{a}_in") for a in amounts])
    out = stored(got.records.select(*place, *amounts), "records").groupBy(*place).agg(F.count("*").alias("n_out"), *[F.sum(a).alias(f"{a}_out") for a in amounts])
    seen = stored(got.review.select(*place), "review").distinct().withColumn("reviewed", F.lit(True))
    both = lines.join(out, place, "full").join(seen, place, "full")
    return both.withColumns({"n_in": F.coalesce("n_in", F.lit(0)), "n_out": F.coalesce("n_out", F.lit(0)), "reviewed": F.coalesce("reviewed", F.lit(False))})


def _found(amounts: Iterable[str]) -> Column:
    """What is wrong with a row of :func:`balance`, as an array."""
    line = lambda c, what, field, a, b: F.when(c, F.struct(F.lit(what).alias("finding"), F.lit(field).cast("string").alias("field"), a.cast("decimal(28,4)").alias("went_in"), b.cast("decimal(28,4)").alias("came_out")))
    n, m = F.col("n_in"), F.col("n_out")
    tests = [line((m < n) & ~F.col("reviewed"), "lost", None, n, m), line(m > n, "made", None, n, m)]
    # Of a row that lost or gained records the number says all.
    tests += [line((m == n) & (m > 0) & ~F.col(f"{a}_in").eqNullSafe(F.col(f"{a}_out")), "changed", a, F.col(f"{a}_in"), F.col(f"{a}_out")) for a in amounts]
    return F.array_compact(F.array(*tests))


def findings(balanced: DataFrame, amounts: Iterable[str] = ()) -> DataFrame:
    """``file, sheet, row, finding, field, went_in, came_out`` of what :func:`balance` gives.

    ``lost``: a row that gave fewer records than it can, and no reason; ``made``: more
    records than it can give; ``changed``: an amount that is not the cell's.
    Rows of the review that are no line of the family (a region without a header) are no finding.
    """
    return balanced.select(*SHEET, "row", F.inline(_found(amounts)))


def self_test(cells: DataFrame, chosen: Mapping[str, Family]) -> DataFrame:
    """``family, lines, records, rows_left, findings``: each of ``chosen`` over the files of ``cells`` that ``families.classify`` sends to it.

    ``lines`` and ``records`` count what went in and came out, ``rows_left`` rows with a reason and no record.
    Customer lists take the files that no other family knows.  A family without files has zeros.
    """
    kinds = stored(families.classify(cells), "kinds")
    out = []
    for name, family in chosen.items():
        own = kinds.where(F.col("family") == ("unrecognised" if isinstance(family, CustomerLists) else name)).select("file")
        rows = balance(cells.join(own, "file", "left_semi"), family).withColumn("wrong", F.size(_found(family.amounts)))
        left = F.sum(F.when((F.col("n_out") == 0) & (F.col("n_in") > 0) & F.col("reviewed"), 1).otherwise(0))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        out.append(rows.agg(total("n_in").alias("lines"), total("n_out").alias("records"), F.coalesce(left, F.lit(0)).cast("long").alias("rows_left"), total("wrong").alias("findings")).select(F.lit(name).alias("family"), "*"))
    return reduce(DataFrame.unionByName, out)
