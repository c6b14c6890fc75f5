"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

A window is any ``width`` bytes of one text.  Sorting all suffixes of a corpus
would shuffle a row for every byte, so suffixes are first sampled and bucketed:

1. Each window names the least of its 32-grams (leftmost of equal hashes) as its
   anchor.  Equal windows have equal anchors at equal offsets, so windows can
   only repeat inside one initial bucket, that of an anchor's hash.  Neighbouring
   windows with the same anchor make a run; a run is one row.
2. Inside a bucket, runs with the same content (a second hash) repeat the
   earliest of them as a whole.  Only the earliest of each content goes on, and
   only where a bucket holds several contents.
3. The bytes of those runs are fetched, and their suffixes are refined by bucket
   pointers: buckets start as the first 8 bytes, and each bucket that still holds
   several suffixes is sorted by the pointers found as far behind as its members are known to
   agree.  New pointers are written at once, so the buckets sorted next already
   use them; buckets of one suffix, or of suffixes that agree far enough, are
   left alone.  Neighbours in the final order are compared byte by byte, and of
   equal windows all but the earliest repeat it.

Tasks combine equal runs before they are shuffled, so a passage that stands in a
third of all documents costs a row for each task, not for each document.  A
bucket with very many contents is spread by content from the start, if a share of the documents shows
it beforehand, and dealt out by window instead of by anchor.
Documents are shuffled by id once; both joins with them use that shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import blocks
from .shared import kept, let_go, stored

WIDTH = 100
GRAM = 32
#: Buckets of about so many rows are spread over so many tasks; the share of documents they are looked for in, and how many are told apart at most.
HOT_ROWS, HOT_SALTS, HOT_SHARE, HOT_MOST = 20_000, 256, 64, 10_000
#: Bits of an anchor's place inside a segment.
_PLACE_BITS = 21
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_BYTES = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 512, dtype=np.uint64).reshape(2, 256)
_STEPS = np.random.Generator(np.random.PCG64(12)).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = 1 << max(16, (n - 1).bit_length())

    def of(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return kept(("powers", size), lambda: (of(_BASE), of(pow(_BASE, -1, 1 << 64))))


def runs(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: ``(text number, first window's place in the text, windows, anchor's place in the run, anchor hash, content hash)``."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < width:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    with np.errstate(over="ignore"):
        grams = _BYTES[0][data]
        step = 1
        for k in range(GRAM.bit_length() - 1):
            grams = grams[:-step] * _STEPS[k] + grams[step:]
            step *= 2
        grams = _mix(grams)
        best = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span, need = 1, width - GRAM + 1
        while 2 * span <= need:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if need > span:
            best = np.minimum(best[: len(best) - (need - span)], best[need - span :])
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(best)]
        valid = np.arange(len(best)) + width <= offsets[text + 1]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (best[1:] != best[:-1]) | (text[1:] != text[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (best[1:] != best[:-1]) | (text[1:] != text[:-1])
        lo, hi = np.flatnonzero(new), np.flatnonzero(last)
        anchor = (best[lo] & _PLACE).astype(np.int64)
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[1][data] * up[:n], dtype=np.uint64, out=sums[1:])
        count, place = hi - lo + 1, anchor - lo
        content = (sums[hi + width] - sums[lo]) * down[lo] + (count * 128 + place).astype(np.uint64) * _STEPS[7]
        return text[lo], lo - offsets[text[lo]], count, place, grams[anchor], _mix(content)


def segments(column: pa.Array, ids: np.ndarray, width: int, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, place of each piece in its text, bytes, offsets)``; a long text comes in pieces that share ``width - 1`` bytes, so every window lies in one piece."""
    for row, data, offsets in blocks(column, most):
        own = ids[row : row + len(offsets) - 1]
        if len(data) <= 2 * most - width:
            yield own, np.zeros(len(own), dtype=np.int64), data, offsets
            continue
        for at in range(0, len(data) - width + 1, most):  # blocks() gives a longer text alone
            piece = data[at : at + most + width - 1]
            yield own, np.array([at]), piece, np.array([0, len(piece)])


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted and joined where they touch, for each document."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = doc[1:] != doc[:-1]
    # The furthest end so far within a document: ends are made to grow from one document to the next.
    number = np.cumsum(fresh) - 1
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * big) - number * big
    fresh[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


_ANCHORS = "h long, c long, doc long, lo long, n long, place int"


def anchors(docs: DataFrame, width: int, flush: int = 300_000) -> DataFrame:
    """Runs of all texts (``_ANCHORS``); of equal runs in a task only the earliest.  The others are rows with a null ``c``, the span being ``n`` bytes from ``lo``."""

    def out(parts: list[tuple]) -> pa.RecordBatch:
        doc, lo, n, place, h, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((lo, doc, c, h))
        h, c, doc, lo, n, place = h[order], c[order], doc[order], lo[order], n[order], place[order]
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
        same &= (doc != doc[lead]) | (lo != lo[lead])  # a repeated row of one document repeats nothing
        d, a, b = _spans(doc[same], lo[same], lo[same] + n[same] + width - 1)
        keep = ~same
        spread = _mix(d.astype(np.uint64) * np.uint64(31) + a.astype(np.uint64))
        columns = [
            pa.array(np.concatenate([h[keep], spread]).view(np.int64)),
            pa.array(np.concatenate([c[keep].view(np.int64), np.zeros(len(d), dtype=np.int64)]), mask=np.arange(keep.sum() + len(d)) >= keep.sum()),
            pa.array(np.concatenate([doc[keep], d])),
            pa.array(np.concatenate([lo[keep], a])),
            pa.array(np.concatenate([n[keep], b - a])),
            pa.array(np.concatenate([place[keep], np.zeros(len(d), dtype=np.int64)]).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["h", "c", "doc", "lo", "n", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            for own, at, data, offsets in segments(batch.column(1), batch.column(0).to_numpy(), width):
                text, lo, n, place, h, c = runs(data, offsets, width)
                parts.append((own[text], lo + at[text], n, place, h, c))
                rows += len(lo)
                if rows >= flush:
                    yield out(parts)
                    parts, rows = [], 0
        let_go()
        if parts:
            yield out(parts)

    return docs.mapInArrow(run, _ANCHORS)


def _joined_windows(places: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """``doc, first window, windows`` of windows joined where they touch."""
    out: list[tuple[int, int, int]] = []
    for doc, lo in sorted(places):
        if out and out[-1][0] == doc and lo <= out[-1][1] + out[-1][2] - 1 + width:
            out[-1] = (doc, out[-1][1], lo - out[-1][1] + 1)
        else:
            out.append((doc, lo, 1))
    return out


def contexts(texts: DataFrame, width: int) -> DataFrame:
    """The bytes of each wanted run: ``texts`` starts with ``doc, text, wanted``.

    A run of a very large bucket comes window by window under a hash of the
    window, each window once for each batch; spans of windows that a batch repeats
    come without bytes, under a hash of their place that spreads them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = lambda raw: int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.large_binary())
            rows: list[tuple] = []
            single: dict[bytes, tuple[int, int]] = {}
            repeated: list[tuple[int, int]] = []
            for k, wanted in enumerate(batch.column(2).to_pylist()):
                text = texts[k].as_py()
                for r in sorted(wanted, key=lambda r: r["lo"]):
                    part = text[r["lo"] : r["lo"] + r["n"] + width - 1]
                    if len(part) < r["n"] + width - 1:  # another row with this id
                        continue
                    if not r["split"]:
                        rows.append((r["h"], docs[k], r["lo"], r["n"], part))
                        continue
                    for j in range(r["n"]):
                        window, here = part[j : j + width], (docs[k], r["lo"] + j)
                        before = single.setdefault(window, here)
                        if before != here:
                            single[window] = min(here, before)
                            repeated.append(max(here, before))
            rows += [(key(window), doc, lo, 1, window) for window, (doc, lo) in single.items()]
            rows += [(key(b"%d %d" % (doc, lo)), doc, lo, n, None) for doc, lo, n in _joined_windows(repeated, width)]
            names, kinds = ["h", "doc", "lo", "n", "part"], [pa.int64()] * 4 + [pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    return texts.mapInArrow(run, "h long, doc long, lo long, n long, part binary")


def suffix_order(data: np.ndarray, starts: np.ndarray, width: int, lot: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` in an order in which those of ``starts`` that agree in ``width`` bytes are neighbours; and the first 8 bytes of each suffix as a number.

    ``pointer`` has for each suffix where its bucket begins in the order, and
    ``depth`` for each beginning how many bytes its bucket is known to share.
    """
    size = len(data)
    gram, bits = np.zeros(size, dtype=np.uint64), data.astype(np.uint64)
    for k in range(min(8, size)):
        gram[: size - k] |= bits[k:] << np.uint64(8 * (7 - k))
    order = np.argsort(gram, kind="stable")
    sorted_ = gram[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    counts = np.diff(np.append(heads, size))
    pointer, depth = np.empty(size, dtype=np.int64), np.full(size, 8, dtype=np.int64)
    pointer[order] = np.repeat(heads, counts)
    asked = np.zeros(size, dtype=np.int64)
    asked[starts] = 1
    open_ = (counts > 1) & (np.add.reduceat(asked[order], heads) > 0) & (width > 8)
    heads, counts = heads[open_], counts[open_]
    while len(heads):
        left, ends, lo = [], np.cumsum(counts), 0
        while lo < len(heads):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + lot, "right")))
            h, n = heads[lo:hi], counts[lo:hi]
            lo = hi
            place = np.repeat(h - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            own, bucket = order[place], np.repeat(np.arange(len(h)), n)
            later = own + np.repeat(depth[h], n)
            # Behind the end of the data each suffix has a number of its own, below all pointers.
            key = np.where(later < size, pointer[np.minimum(later, size - 1)], size - 1 - later)
            ranked = np.lexsort((key, bucket))
            own, key = own[ranked], key[ranked]
            first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])]))
            n, at = np.diff(np.append(first, len(own))), place[first]
            reached = depth[h][bucket[first]] + np.where(key[first] >= 0, depth[key[first]], 0)
            order[place], pointer[own], depth[at] = own, np.repeat(at, n), reached
            open_ = (n > 1) & (reached < width) & (np.add.reduceat(asked[own], first) > 0)
            left.append((at[open_], n[open_]))
        heads, counts = (np.concatenate(x) for x in zip(*left, strict=True))
    return order, gram


def refine(doc: np.ndarray, lo: np.ndarray, n: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that repeat an earlier window, by bucket-pointer refinement of all suffixes of the given parts."""
    part = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[part] + step
    order, gram = suffix_order(data, starts, width)
    rank = np.empty(len(data), dtype=np.int64)
    rank[order] = np.arange(len(data))
    near = np.argsort(rank[starts])
    docs, places, starts = doc[part[near]], lo[part[near]] + step[near], starts[near]
    fresh = np.ones(len(starts), dtype=bool)
    same = np.ones(max(0, len(starts) - 1), dtype=bool)
    for at in [*range(0, width - 8, 8), width - 8]:
        word = gram[starts + at]
        same &= word[1:] == word[:-1]
    fresh[1:] = ~same
    ids = np.cumsum(fresh)
    ranked = np.lexsort((places, docs, ids))
    docs, places = docs[ranked], places[ranked]
    lead = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
    again = (docs != docs[lead]) | (places != places[lead])
    return _spans(docs[again], places[again], places[again] + width)


def refined(parts: DataFrame, width: int, most: int = 16_000) -> DataFrame:
    """``doc, lo, hi``: repeated spans of parts that lie bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table) -> pa.RecordBatch:
            alone = table.column("part").is_null().to_numpy()
            doc, lo, n = (table.column(c).to_numpy() for c in ("doc", "lo", "n"))
            d, a, b = doc[alone], lo[alone], lo[alone] + n[alone] + width - 1
            column = table.column("part").filter(pa.array(~alone)).combine_chunks().cast(pa.large_binary())
            if len(column):
                _, ends, data = column.buffers()
                offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
                raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
                got = refine(doc[~alone], lo[~alone], n[~alone], raw, offsets[:-1] - offsets[0], width)
                d, a, b = (np.concatenate(x) for x in zip((d, a, b), got, strict=True))
            d, a, b = _spans(d, a, b)
            return pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(b)], ["doc", "lo", "hi"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < most:
                continue
            table = pa.Table.from_batches(held)
            # Whole buckets only: what follows the last change of h stays for the next round.
            h = table.column("h").to_numpy()
            changes = np.flatnonzero(h[1:] != h[:-1])
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:
                yield out(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield out(pa.Table.from_batches(held))

    dealt = parts.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "doc long, lo long, hi long")


def hot_buckets(docs: DataFrame, width: int) -> DataFrame:
    """``h``: at most ``HOT_MOST`` buckets of which one document in ``HOT_SHARE`` shows that they have some ``HOT_ROWS`` rows or more.

    This only says how rows are dealt to tasks; no result depends on it.
    """
    seen = anchors(docs.where(F.pmod(F.xxhash64("doc"), F.lit(HOT_SHARE)) == 0), width).where("c is not null")
    counts = seen.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") * HOT_SHARE >= HOT_ROWS)
    return counts.orderBy(F.col("n").desc(), "h").limit(HOT_MOST).select("h", F.lit(True).alias("hot"))


def repeated_spans(docs: DataFrame, texts: DataFrame, width: int, split_over: int = 4000) -> DataFrame:
    """``doc, spans``: the byte spans to remove from each document that has any; ``texts`` is ``docs`` (``doc``, ``text``) dealt out by ``doc``; all its columns are read, so that its shuffle is the caller's."""
    found = anchors(docs, width).join(F.broadcast(hot_buckets(docs, width)), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    # A hot bucket is spread by content.  Its rows all go on to the refinement, window by window, so nothing has to be known about it as a whole.
    found = found.withColumn("salt", F.when(F.col("hot"), F.pmod(F.coalesce("c", F.lit(0)), F.lit(HOT_SALTS))).otherwise(0))
    bucket, content = Window.partitionBy("h", "salt"), Window.partitionBy("h", "salt", "c").orderBy("doc", "lo")
    found = found.withColumn("first_doc", F.first("doc").over(content)).withColumn("first_lo", F.first("lo").over(content))
    found = found.withColumn("c_min", F.min("c").over(bucket)).withColumn("c_max", F.max("c").over(bucket)).withColumn("rows", F.count("*").over(bucket))
    first = (F.col("doc") == F.col("first_doc")) & (F.col("lo") == F.col("first_lo"))
    found = found.withColumn("whole", F.col("c").isNull() | ~first).where("whole or hot or c_min <> c_max")
    length = F.when(F.col("c").isNull(), F.col("n")).otherwise(F.col("n") + (width - 1))
    marks = stored(found.select("whole", "h", "doc", "lo", "n", length.alias("length"), ((F.col("rows") > split_over) | F.col("hot")).alias("split")), "marks")
    wanted = marks.where("not whole").groupBy("doc").agg(F.collect_list(F.struct("h", "lo", "n", "split")).alias("wanted"))
    parts = contexts(texts.join(wanted.hint("shuffle_hash"), "doc").select("doc", "text", "wanted", *texts.columns[2:]), width)
    spans = marks.where("whole").select("doc", "lo", (F.col("lo") + F.col("length")).alias("hi")).unionByName(refined(parts, width))
    return spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _removed(text: bytes, spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s["lo"]):
        lo, hi = s["lo"], min(s["hi"], len(text))
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        elif lo < hi:
            out.append((lo, hi))
    return out


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for lo, hi in spans:
        kept.append(text[at:lo])
        at = hi
    return b"".join([*kept, text[at:]])


def _joined(docs: DataFrame, width: int, text: str, key: str, rest: list[str]) -> DataFrame:
    """``doc``, ``text``, ``rest`` (the other columns, if any) and ``spans`` of each row."""
    rows = docs.where(F.col(f"`{key}`").isNotNull())
    plain = [F.col(f"`{key}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]
    more = [F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")] if rest else []
    dealt = rows.select(*plain, *more).repartition("doc")
    spans = repeated_spans(rows.select(*plain), dealt, width)
    return dealt.join(spans.hint("shuffle_hash"), "doc", "left")


def removal(docs: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every document.

    Bytes covered by a ``width``-byte string that also starts earlier (a smaller
    id, or the same document further ahead) are removed; strings are judged on
    the texts as they are given.  Null and empty texts, and texts shorter than
    ``width``, lose nothing.  Rows that share an id count as one document, so
    none of them is earlier than another.  Rows without an id are left out; an
    empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        for batch in batches:
            texts, rows = batch.column(1).cast(pa.large_binary()), []
            for k, (doc, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own = texts[k].as_py()
                gone = _removed(own, spans or [])
                kept = _without(own, gone)
                rows.append((doc, len(own), len(own) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), [{"lo": a, "hi": b} for a, b in gone]))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo: long, hi: long>>"
    return _joined(docs, width, text, key, []).select("doc", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the repeats cut out of ``text``; all columns stay.

    A cut never splits a character: it is narrowed to whole ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(1).cast(pa.large_binary()), []
            for k, spans in enumerate(batch.column(2).to_pylist()):
                own = texts[k].as_py()
                inside = lambda p, own=own: p < len(own) and own[p] & 0xC0 == 0x80
                whole = []
                for lo, hi in _removed(own, spans or []):
                    while inside(lo):
                        lo += 1
                    while inside(hi):
                        hi -= 1
                    if lo < hi:
                        whole.append((lo, hi))
                kept.append(_without(own, whole).decode())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), batch.column(0)], ["text", "rest"])

    joined = _joined(docs, width, text, key, [c for c in docs.columns if c != text])
    rest = joined.schema["rest"].dataType.simpleString()
    out = joined.select("rest", "text", "spans").mapInArrow(run, f"text string, rest {rest}")
    return out.select(*[(F.col("text") if c == text else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
