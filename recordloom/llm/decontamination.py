"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask laid over consecutive words: the words under its ones are
hashed, those under its zeros are ignored, so a seed survives substitutions.
Seeds of documents are joined with seeds of benchmark items by hash; each hit
fixes an alignment, which is then verified word by word: what counts is the
best stretch, in which a mismatch costs as much as four matches earn, or if that is
too short, any other with at most one mismatch in five.  The masks are chosen so
that no such stretch is without a seed.

The benchmark goes to the tasks in blocks of a checked size, each block in one
pass over the documents, which are read where they lie and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import ALNUM, Words, blocks, words

#: Masks by the least number of equal words they are for.  Every stretch with so many and at most one mismatch in five
#: holds one of the masks: one with twice as many has a half that is such a stretch too, and the rest are enumerated in a test.
MASKS = {
    8: ("1111011", "110010111", "111111", "101100111", "1011111", "1110101001"),
    5: ("1111", "111011", "110111"),
    4: ("1111", "11011", "10111", "11101"),
    3: ("111",),
    2: ("11",),
    1: ("1",),
}
#: Alignments and words of items that are compared at once.
LOT, LOT_WORDS = 1 << 16, 1 << 22

SCHEMA = "doc_id long, item_id long, n_match long, n_aligned long, item_words long, first_word long, last_word long"

_MIX = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def needed(words: int, least: int, share: float) -> int:
    """How many equal words an item of ``words`` words needs."""
    return max(1, min(least, int(np.ceil(share * words))))


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each place where ``mask`` fits."""
    n = len(hashes) - len(mask) + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for k, one in enumerate(mask):
                if one == "1":
                    out += hashes[k : k + n] * _MIX[k]
            out ^= out >> np.uint64(31)
            out *= np.uint64(0x94D049BB133111EB)
    return out


@dataclass
class Benchmark:
    """One block of items: their word hashes, and for each mask its seeds in order with item and place."""

    ids: np.ndarray
    items: list[np.ndarray]
    spelled: list[list[bytes]]
    needs: np.ndarray
    flat: np.ndarray
    begin: np.ndarray
    tables: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[int, str]], least: int = 13, share: float = 0.8, fewest: int = 1) -> Benchmark:
        items, spelled = [], []
        for _, text in rows:
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            found = words(data, np.array([0, len(data)]), ALNUM)
            items.append(found.hashes)
            spelled.append([found.word(k) for k in range(len(found.starts))])
        tables = []
        needs = [needed(len(hashes), least, share) for hashes in items]
        bound = [next(n for n in MASKS if n <= need) for need in needs]
        for n, mask in ((n, mask) for n, masks in MASKS.items() for mask in masks):
            got, item, place = [], [], []
            for k, hashes in enumerate(items):
                if bound[k] != n or len(hashes) < fewest:
                    continue
                s = seeds(hashes, mask)
                got.append(s)
                item.append(np.full(len(s), k))
                place.append(np.arange(len(s)))
            if sum(map(len, got)):
                s, i, p = np.concatenate(got), np.concatenate(item), np.concatenate(place)
                order = np.argsort(s, kind="stable")
                tables.append((mask, s[order], i[order], p[order]))
        begin = np.cumsum([0, *map(len, items)])
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *items])
        return Benchmark(np.array([r[0] for r in rows], dtype=np.int64), items, spelled, np.array(needs, dtype=np.int64), flat, begin, tables)


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the largest sum of +1 for a match and -4 for a mismatch."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    return start, end


def fullest_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the most matches of all with at most one mismatch in five; of equal ones the shortest, then the first."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    # For each match as the first, the last match behind which the sum of +1 and -4 is no less than before the first.
    beyond = np.maximum.accumulate(total[at + 1][::-1])
    last = len(at) - 1 - np.searchsorted(beyond, total[at], "left")
    k = int(np.lexsort((at, at[last] - at, np.arange(len(at)) - last))[0])
    return int(at[k]), int(at[last[k]]) + 1


def alignments(bench: Benchmark, found: Words) -> Iterator[np.ndarray]:
    """``text number, item number, first word`` of the seeds that agree, in lots of at most ``LOT``, each lot without repeats."""
    for mask, known, item, place in bench.tables:
        own = seeds(found.hashes, mask)
        if not len(own):
            continue
        quick = np.zeros(1 << 16, dtype=bool)
        quick[(known >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(quick[(own >> np.uint64(48)).astype(np.int64)])
        at = at[at + len(mask) <= found.first[found.text_of(at) + 1]]
        low = np.searchsorted(known, own[at], "left")
        ends = np.cumsum(np.searchsorted(known, own[at], "right") - low)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, LOT):
            number = np.arange(lo, min(lo + LOT, int(ends[-1])))
            row = np.searchsorted(ends, number, "right")
            k = low[row] + number - np.concatenate([[0], ends])[row]
            yield np.unique(np.stack([found.text_of(at[row]), item[k], at[row] - place[k]], axis=1), axis=0)


def matching(bench: Benchmark, found: Words, lot: np.ndarray) -> np.ndarray:
    """Those of a lot of alignments with as many equal words in place as the item needs."""
    text, item, start = lot.T
    a = np.maximum(start, found.first[text])
    b = np.minimum(start + np.diff(bench.begin)[item], found.first[text + 1])
    ends, keep, lo = np.cumsum(b - a), np.zeros(len(lot), dtype=bool), 0
    while lo < len(lot):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + LOT_WORDS, "right")))
        n = (b - a)[lo:hi]
        heads = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(heads, n)
        here = found.hashes[np.repeat(a[lo:hi], n) + step]
        there = bench.flat[np.repeat((bench.begin[item] + a - start)[lo:hi], n) + step]
        keep[lo:hi] = np.add.reduceat(here == there, heads, dtype=np.int64) >= bench.needs[item[lo:hi]]
        lo = hi
    return lot[keep]


def hits(bench: Benchmark, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """``(text number, item number, matches, aligned, first word, last word)``, the best alignment of each pair."""
    found = words(data, offsets, ALNUM)
    best: dict[tuple[int, int], tuple] = {}
    for text, item, start in (row for lot in alignments(bench, found) for row in matching(bench, found, lot).tolist()):
        own = bench.items[item]
        a, b = max(start, int(found.first[text])), min(start + len(own), int(found.first[text + 1]))
        equal = found.hashes[a:b] == own[a - start : b - start]
        for k in np.flatnonzero(equal).tolist():
            equal[k] = found.word(a + k) == bench.spelled[item][a - start + k]
        s, e = best_stretch(equal)
        if np.count_nonzero(equal[s:e]) < bench.needs[item]:
            s, e = fullest_stretch(equal)
        match = int(np.count_nonzero(equal[s:e]))
        if match >= bench.needs[item]:
            first = a + s - int(found.first[text])
            row = (match, e - s, first, first + e - s - 1)
            if (text, item) not in best or (row[0], -row[2]) > (best[text, item][0], -best[text, item][2]):
                best[text, item] = row
    for (text, item), row in sorted(best.items()):
        yield (text, item, *row)


def benchmark_blocks(benchmark: DataFrame, bound: int, text: str = "text", key: str = "item_id") -> Iterator[list[tuple[int, str]]]:
    """Distinct items in blocks of at most ``bound`` characters; an item longer than that is a block of its own."""
    rows = benchmark.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if total <= bound:
        yield [(r.id, r.text) for r in rows.orderBy("id", "text").collect()]
        return
    count = 2 * -(-total // bound)
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(count)))
        sizes = dealt.groupBy("block").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows"))
        if sizes.where((F.col("n") > bound) & (F.col("rows") > 1)).isEmpty():
            break
        count *= 2
    for block in range(count):
        got = [(r.id, r.text) for r in dealt.where(F.col("block") == block).orderBy("id", "text").collect()]
        if got:
            yield got


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8, bound: int = 16_000_000, text: str = "text", key: str = "doc_id", fewest: int = 1) -> DataFrame:
    """``SCHEMA``: one row for each document and item that overlap.

    They overlap if some stretch has ``least`` equal words in place, or
    ``share`` of the item's words if that is less, with at most one mismatch
    in five words; items of one to four words must stand there as they are.  Items of
    fewer than ``fewest`` words are left out.  Words are runs of ASCII letters, digits and non-ASCII
    characters, in small letters.  Null and empty texts overlap with nothing.  Of several alignments the one with the
    most equal words counts, then the first; repeated rows of ``docs`` are reported
    each, repeated rows of the benchmark once; an item longer than ``bound`` is a block of its own.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for items in benchmark_blocks(benchmark, bound):
        shared = spark.sparkContext.broadcast(Benchmark.of(items, least, share, fewest))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            for batch in batches:
                ids, got = batch.column(0).to_pylist(), []
                for row, data, offsets in blocks(batch.column(1)):
                    for t, i, match, aligned, first, last in hits(bench, data, offsets):
                        got.append((ids[row + t], int(bench.ids[i]), match, aligned, len(bench.items[i]), first, last))
                columns = list(zip(*got, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        found = rows.mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8, bound: int = 16_000_000, text: str = "text", fewest: int = 5) -> DataFrame:
    """The rows of ``docs`` that overlap with no item of ``fewest`` words or more, all columns as they are, in one pass for each block of items.

    Shorter items (``contaminated`` reports them) are everyday phrases, for which no document has to go.
    """
    spark = docs.sparkSession
    schema, column = docs.schema, docs.columns.index(text)
    for items in benchmark_blocks(benchmark, bound):
        shared = spark.sparkContext.broadcast(Benchmark.of(items, least, share, fewest))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for row, data, offsets in blocks(batch.column(column)):
                    for t, *_ in hits(shared.value, data, offsets):
                        keep[row + t] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
