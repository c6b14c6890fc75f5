"""Quotation linking: reply-ordered conversations without quotes.

Messages are parsed into their own text and quoted passages with nesting levels.
Passages and lines are normalised and hashed; a quoted one belongs to the latest
earlier message of its conversation that says the same.  What a message quotes at
level one votes for its parent, or if nothing of that is found, what it quotes at
the least deeper level of which something is.

A thread is read depth first: its tour enters and leaves every message, and
pointer jumping over that list gives root, depth and place of all messages at
once, in a number of rounds that grows with the logarithm of the longest thread.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

_MARKS = re.compile(r"^[ \t]*(?:>[ \t]?)+")
#: Lines that introduce a quotation.
_INTRO = re.compile(r"^(?:On\b.{1,200}\bwrote|Am\b.{1,200}\bschrieb\b.{0,80}|Le\b.{1,200}\ba écrit|El\b.{1,200}\bescribió) ?:$")


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """Own text and ``(level, passage)`` of every quoted run of lines of one level."""
    lines = text.split("\n")
    levels = [m[0].count(">") if (m := _MARKS.match(x)) else 0 for x in lines]
    own: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    before = 0
    for k, (line, level) in enumerate(zip(lines, levels, strict=True)):
        if level:
            if level != before:
                quoted.append((level, []))
            quoted[-1][1].append(_MARKS.sub("", line))
        elif not (_INTRO.match(line.strip()) and k + 1 < len(lines) and levels[k + 1]):
            own.append(line)
        before = level
    return "\n".join(own).strip(), [(level, "\n".join(part)) for level, part in quoted]


def _hash(text: str) -> str | None:
    """Of the text in small letters with single spaces; null for none."""
    folded = " ".join(text.lower().split())
    return hashlib.md5(folded.encode()).hexdigest() if folded else None


def parsed(messages: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``conv, turn, role, own, n_quotes, said`` with ``said``: ``hash, level`` (0: its own), ``weight``, once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said_type = pa.list_(pa.struct([("hash", pa.string()), ("level", pa.int32()), ("weight", pa.int64())]))
        for batch in batches:
            owns, counts, saids = [], [], []
            texts = batch.column(3).cast(pa.large_string())
            for k in range(batch.num_rows):
                own, quoted = parse(texts[k].as_py() or "")
                said: dict[tuple[str, int], int] = {}
                for level, passage in [(0, own), *quoted]:
                    for unit in {passage, *passage.split("\n")}:
                        if h := _hash(unit):
                            said[h, level] = len(unit)
                owns.append(own)
                counts.append(len(quoted))
                saids.append([{"hash": h, "level": level, "weight": n} for (h, level), n in said.items()])
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(owns, pa.string()), pa.array(counts, pa.int64()), pa.array(saids, said_type)]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "turn", "role", "own", "n_quotes", "said"])

    conv, turn, role = keys
    rows = messages.where(F.col(f"`{conv}`").isNotNull() & F.col(f"`{turn}`").isNotNull())
    rows = rows.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "conv long, turn long, role string, own string, n_quotes long, said array<struct<hash: string, level: int, weight: long>>")


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """``rows``, stored, with ``part``: equal ``order`` lies in one part and parts follow each other, so a large group is spread over many."""
    return stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt")


def _carried(parts: DataFrame, group: list[str], value: str, fold, backwards: bool = False) -> DataFrame:
    """``group, part, carried``: ``fold`` of ``value`` over the parts before each (with ``backwards``, behind it) that hold the group; a few rows for each group."""
    order = Window.partitionBy(*group).orderBy(F.col("part").desc() if backwards else F.col("part")).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("carried", fold(value).over(order)).select(*group, "part", "carried")


def _sources(said: DataFrame) -> DataFrame:
    """``said`` with ``source``: the latest earlier message of the conversation that says the same itself."""
    group = ["conv", "hash"]
    dealt = _dealt(said, *group, "turn")
    own = F.when(F.col("level") == 0, F.col("turn"))
    before = Window.partitionBy(*group, "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(*group, "part").agg(F.max(own).alias("latest"))
    out = dealt.withColumn("near", F.max(own).over(before)).join(_carried(parts, group, "latest", F.max), [*group, "part"])
    return out.select("conv", "turn", "level", "weight", F.coalesce("near", "carried").alias("source"))


def _tour(nodes: DataFrame) -> DataFrame:
    """Two arcs for each of ``nodes`` (``conv, turn, parent``), into it and out of it (``leaves``), with the arc that follows, ``to, to_leaves``."""
    group = ["conv", "parent"]
    dealt = _dealt(nodes.where("parent is not null"), *group, "turn")
    parts = dealt.groupBy(*group, "part").agg(F.min("turn").alias("first"))
    behind = Window.partitionBy(*group, "part").orderBy("turn")
    siblings = dealt.withColumn("near", F.lead("turn").over(behind)).join(_carried(parts, group, "first", F.min, backwards=True), [*group, "part"])
    siblings = siblings.select("conv", "turn", F.coalesce("near", "carried").alias("sibling"))
    firsts = parts.groupBy("conv", F.col("parent").alias("turn")).agg(F.min("first").alias("child"))
    both = nodes.join(siblings, ["conv", "turn"], "left").join(firsts, ["conv", "turn"], "left")
    into = F.struct(F.lit(False).alias("leaves"), F.coalesce("child", "turn").alias("to"), F.col("child").isNull().alias("to_leaves"))
    out_of = F.struct(F.lit(True).alias("leaves"), F.coalesce("sibling", "parent").alias("to"), F.col("sibling").isNull().alias("to_leaves"))
    return both.select("conv", "turn", F.explode(F.array(into, out_of)).alias("arc")).select("conv", "turn", "arc.*")


def _ranked(tour: DataFrame) -> DataFrame:
    """``conv, turn, root, depth, ahead`` of each message; ``ahead``: the messages of its thread from it on, in the order of the tour."""
    one = F.lit(1).cast("long")
    start = tour.withColumn("entered", F.when(F.col("leaves"), 0 * one).otherwise(one)).withColumn("level", F.when(F.col("leaves"), -one).otherwise(one))
    now = stored(start.withColumn("root", F.when(F.col("to").isNull(), F.col("turn"))), "tour")
    done, columns = now.where("to is null"), now.columns
    while not now.where("to is not null").isEmpty():
        # Arcs that have come to the end of their thread are written once and only looked up from then on.
        open_ = now.where("to is not null")
        ahead = done.unionByName(open_).select("conv", F.col("turn").alias("to"), F.col("leaves").alias("to_leaves"), F.struct("to", "to_leaves", "entered", "level", "root").alias("n"))
        moved = open_.drop("root").join(ahead, ["conv", "to", "to_leaves"])
        moved = moved.select(
            "conv", "turn", "leaves", F.col("n.to").alias("to"), F.col("n.to_leaves").alias("to_leaves"),
            (F.col("entered") + F.col("n.entered")).alias("entered"), (F.col("level") + F.col("n.level")).alias("level"), F.col("n.root").alias("root"),
        )
        now = stored(moved.select(*columns), "tour")
        done = done.unionByName(now.where("to is null"))
    # All that is entered is left again, so what is still to be left from here on is the depth.
    return done.where(~F.col("leaves")).select("conv", "turn", "root", (-F.col("level")).alias("depth"), F.col("entered").alias("ahead"))


def reply_order(messages: DataFrame, text: str = "text", conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """``conv_id, turn, role, text, parent_turn, root_turn, depth, reply_order, n_quotes``: one row per message.

    ``text`` is the message without quotes.  A message without a quote that can
    be found starts a thread of its own.  Threads of a conversation follow one
    another by their first turn; within one, each message stands behind what it
    answers, followed by its own replies before the next reply to the same
    message (depth first, replies by turn).  Null texts are empty; rows without a
    conversation or turn are left out; of rows that share both, the one with the
    least role and text counts; an empty table gives no rows; very long texts stay
    whole; other columns are ignored.
    """
    rows = parsed(messages, text, [conv, turn, role])
    one = Window.partitionBy("conv", "turn").orderBy("role", "own", "n_quotes")
    rows = stored(rows.withColumn("nth", F.row_number().over(one)).where("nth = 1").drop("nth"), "messages")
    said = rows.select("conv", "turn", F.explode("said").alias("s")).select("conv", "turn", "s.hash", "s.level", "s.weight")
    found = _sources(said).where("level >= 1 and source is not null")
    votes = found.groupBy("conv", "turn", "level", "source").agg(F.sum("weight").alias("weight"))
    parents = votes.groupBy("conv", "turn").agg(F.max_by("source", F.struct(-F.col("level"), "weight", "source")).alias("parent"))
    nodes = stored(rows.select("conv", "turn").join(parents, ["conv", "turn"], "left"), "parents")
    ranked = _ranked(_tour(nodes)).withColumn("place", -F.col("ahead"))
    dealt = _dealt(ranked, "conv", "root", "place")
    sizes = _carried(dealt.groupBy("conv", "part").agg(F.count("*").alias("n")), ["conv"], "n", F.sum)
    order = F.row_number().over(Window.partitionBy("conv", "part").orderBy("root", "place"))
    placed = dealt.withColumn("nth", order).join(sizes, ["conv", "part"])
    placed = placed.select("conv", "turn", "root", "depth", (F.col("nth") + F.coalesce("carried", F.lit(0))).cast("long").alias("nth"))
    out = rows.select("conv", "turn", "role", "own", "n_quotes").join(nodes, ["conv", "turn"]).join(placed, ["conv", "turn"])
    return out.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.col("own").alias("text"),
        F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"), "depth", F.col("nth").alias("reply_order"), "n_quotes",
    )
