"""SimHash near-duplicates with a Gray-order hierarchical index.

Distinct fingerprints are dealt to buckets by pairs of five bit groups: two
fingerprints that differ in at most three bits agree on at least two groups, so
every link lies inside some bucket.  Inside a bucket the fingerprints are sorted
by Gray rank; every 16 neighbours make a node and every 16 nodes a node above.
A node holds the bits its members share; a search walks down from the root, adds
up the differences in the bits that a node shares beyond its parent, and drops
whole nodes when the sum passes the radius.  A node all of whose members are
already in the searcher's class is dropped too, so a bucket yields a spanning
set of links rather than all pairs, and classes are joined across buckets.

The pipeline's stage, :func:`one_of_near_copies`, asks for more than fingerprints of 64
bits can tell: near copies by the overlap of their shingles, whose fingerprints
may lie some ten bits apart.  The same index links the fingerprints of its shingles
first, and what it links is compared exactly; only sets that this leaves in different
classes are then paired by least-value keys of the same shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import dropped, let_go, stored

SEED = 42
FAN = 16
#: Keys of a document for near copies, and the least values that each is made of.
BANDS, ROWS = 24, 4
#: Sets of a key that are compared with each other at once.
BLOCK = 512
_XOR, _TIMES = (np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

#: ASCII capitals to small letters.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every run of ``words`` words, space-joined; of the whole sequence if it is shorter."""
    parts = text.translate(_LOWER).split()  # of bytes: at ASCII white space
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    starts = (ends - np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) - 1)[: 1 - words].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends - 1)[words - 1 :].tolist(), strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """A bit is set where more than half of the hashes have it; 0 for none."""
    total = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[lo : lo + (1 << 15)], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, fp``: one row per row of ``docs``; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = [fingerprint(shingle_hashes(texts[k].as_py() or b"", words)) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """The place of a word in the reflected Gray order, as a signed long."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def bit_groups(radius: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of ``radius + 2`` groups of the 64 bits."""
    edges = [64 * k // (radius + 2) for k in range(radius + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def buckets(fps: DataFrame, radius: int) -> DataFrame:
    """``fp`` once for each pair of bit groups, with the pair's bits as ``bucket``."""
    groups = bit_groups(radius)
    part = lambda shift, width: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
    keys = []
    for table, ((s1, w1), (s2, w2)) in enumerate(combinations(groups, 2)):
        bits = F.shiftleft(part(s1, w1), w2).bitwiseOR(part(s2, w2))
        keys.append(F.lit(table << (w1 + w2 + 1)).bitwiseOR(bits) if w1 + w2 < 56 else bits)
    return fps.select("fp", "node", F.explode(F.array(*keys)).alias("bucket"))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of each link, and all that had their labels, the least label."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def linked(bucket: np.ndarray, fp: np.ndarray, radius: int, chunk: int = 2048, frontier: int = 1 << 20) -> np.ndarray:
    """For each fingerprint the index of the first one in its class; rows are sorted by bucket and Gray rank.

    Buckets are searched side by side; links never leave a bucket.
    """
    n = len(fp)
    label = np.arange(n)
    if n < 2:
        return label
    new = np.empty(n, dtype=bool)
    new[0], new[1:] = True, bucket[1:] != bucket[:-1]
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    own = np.repeat(np.arange(len(head)), size)
    place = np.arange(n) - head[own]
    # levels[0]: leaves of FAN members; the last level has one node for each bucket.
    levels, step = [], FAN
    while True:
        node_new = new | (place % step == 0)
        start = np.flatnonzero(node_new)
        levels.append({"start": start, "of": np.cumsum(node_new) - 1, "all": np.bitwise_and.reduceat(fp, start), "any": np.bitwise_or.reduceat(fp, start)})
        if len(start) == len(head):
            break
        step *= FAN
    for level in levels:
        level["mask"] = ~(level["all"] ^ level["any"])
        level["end"] = np.append(level["start"][1:], n)
    for low, high in zip(levels, levels[1:], strict=False):
        up = high["of"][low["start"]]
        low["mask_here"] = low["mask"] & ~high["mask"][up]
        high["child"] = low["of"][high["start"]]
        high["children"] = low["of"][high["end"] - 1] + 1 - high["child"]
    levels[-1]["mask_here"] = levels[-1]["mask"]
    root = levels[-1]["of"]

    def spread(index: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each ``index`` with ``count`` numbers from ``first`` on."""
        total = np.cumsum(count)
        many = np.repeat(np.arange(len(index)), count)
        return many, first[many] + np.arange(len(many)) - (total - count)[many]

    def search(q: np.ndarray, node: np.ndarray, dist: np.ndarray, depth: int) -> None:
        level = levels[depth]
        dist = dist + _popcount((fp[q] ^ level["all"][node]) & level["mask_here"][node])
        low, high = level["low"][node], level["high"][node]
        keep = (dist <= radius) & (level["end"][node] > q + 1) & ~((low == high) & (low == label[q]))
        q, node, dist = q[keep], node[keep], dist[keep]
        for lo in range(0, len(q), frontier // FAN):
            qs, ns, ds = (x[lo : lo + frontier // FAN] for x in (q, node, dist))
            if depth:
                many, child = spread(qs, level["child"][ns], level["children"][ns])
                search(qs[many], child, ds[many], depth - 1)
            else:
                many, j = spread(qs, level["start"][ns], level["end"][ns] - level["start"][ns])
                i = qs[many]
                near = (j > i) & (_popcount(fp[i] ^ fp[j]) <= radius)
                _merge(label, i[near], j[near])

    # Few searches first: they join most of a large class, and later ones meet whole nodes of their own class.
    at, width = 0, 64
    while at < n:
        q = np.arange(at, min(n, at + width))
        for level in levels:
            level["low"] = np.minimum.reduceat(label, level["start"])
            level["high"] = np.maximum.reduceat(label, level["start"])
        search(q, root[q], np.zeros(len(q), dtype=np.int16), len(levels) - 1)
        at, width = at + width, min(chunk * 64, width * 4)
    return label


def links(fps: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links that join every class of ``fps`` (``fp``, ``node``), at most one for each fingerprint and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def out(batch: list[np.ndarray]) -> pa.RecordBatch:
            bucket, fp, node = batch
            label = linked(bucket, fp.view(np.uint64), radius)
            # The least node of each class is its centre.
            least = node.copy()
            np.minimum.at(least, label, node)
            centre = least[label]
            off = np.flatnonzero(centre != node)
            return pa.RecordBatch.from_arrays([pa.array(node[off]), pa.array(centre[off])], ["a", "b"])

        def taken(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
            return [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in batches]) for k in range(3)]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= 100_000 and held[0].column(0)[0] != batch.column(0)[batch.num_rows - 1]:
                whole = taken(held)
                last = int(np.searchsorted(whole[0], whole[0][-1]))
                yield out([x[:last] for x in whole])
                rest = [x[last:] for x in whole]
                held, rows = [pa.RecordBatch.from_arrays([pa.array(x) for x in rest], ["bucket", "fp", "node"])], len(rest[0])
        if held:
            yield out(taken(held))

    dealt = buckets(fps, radius).withColumn("gray", gray_rank(F.col("fp")))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "gray").select("bucket", "fp", "node")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id reachable.  Null, empty and blank texts
    have the fingerprint zero and are linked like any other.  Repeated rows stay;
    rows without an id are ignored; an empty table gives no rows; other columns
    are ignored.
    """
    rows = stored(fingerprints(docs.where(F.col(f"`{key}`").isNotNull()), words, text, key), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    roots = components(links(fps, radius))
    classes = stored(fps.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id")), "classes")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes, words: int) -> tuple[np.ndarray, int]:
    """The distinct hashes of a text's shingles in order, and a hash of them all."""
    hashes = np.unique(np.array(shingle_hashes(text, words), dtype=np.uint64))
    return hashes, int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A hash for each of ``BANDS`` groups of ``ROWS`` least values of the set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(hashes), 4096):
            mixed = (hashes[lo : lo + 4096, None] ^ _XOR) * _TIMES
            np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0), out=least)
    found = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(found, dtype=np.uint64).view(np.int64).tolist()


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """``doc_id, node, size, fp, keys`` for each of ``rows`` (``doc_id, text``); ``node`` stands for the set of shingles, ``fp`` is its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            got = [shingle_set(texts[k].as_py() or b"", words) for k in range(len(texts))]
            columns = [pa.array([n for _, n in got], pa.int64()), pa.array([len(h) for h, _ in got], pa.int64()), pa.array([fingerprint(h.tolist()) for h, _ in got], pa.int64()), pa.array([band_keys(h) if len(h) else [] for h, _ in got], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "node", "size", "fp", "keys"])

    return rows.mapInArrow(run, "doc_id long, node long, size long, fp long, keys array<long>")


def alike(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int, share: float) -> DataFrame:
    """The rows of ``pairs`` (``a, b``) whose sets overlap by ``share`` or more, stored; ``nodes`` has a ``doc_id`` for each node."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            got = [shingle_set(texts[k].as_py() or b"", words) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays([pa.array([n for _, n in got], pa.int64()), pa.array([h.tobytes() for h, _ in got], pa.binary())], ["node", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_py(), dtype=np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= share * (len(x) + len(y) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = nodes.join(needed, "node", "left_semi").select("doc_id").distinct()
    # Rows that share an id may have other sets; those that no pair asks for find no partner below.
    sets = rows.join(ids, "doc_id", "left_semi").select("text").mapInArrow(shingles, "node long, hashes binary")
    sets = stored(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "shingle-sets")
    of = lambda end: sets.select(F.col("node").alias(end), F.col("hashes").alias(f"hashes_{end}"))
    out = stored(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "hashes_a", "hashes_b").mapInArrow(compare, "a long, b long"), "links")
    dropped(sets)
    return out


def joining(node: np.ndarray, label: np.ndarray, block: np.ndarray, sets: list[np.ndarray], share: float, across: bool) -> list[tuple[int, int]]:
    """Links between sets with different labels that overlap by ``share`` or more, as many as join the labels; with ``across`` only between blocks.

    Overlaps of one set with all others are counted through a list of the holders of each of its hashes;
    sets of the most frequent label are only found by others.
    """
    n, size = len(node), np.array([len(s) for s in sets])
    label = np.unique(label, return_inverse=True)[1]
    if n < 2 or not label.any():
        return []
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(size)
    order = np.argsort(token, kind="stable")
    holder = np.repeat(np.arange(n), size)[order]
    last = np.cumsum(np.bincount(token))
    out = []
    for k in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
        own = token[ends[k] - size[k] : ends[k]]
        count = last[own] - np.where(own > 0, last[own - 1], 0)
        at = np.repeat(last[own] - np.cumsum(count), count) + np.arange(int(count.sum()))
        common = np.bincount(holder[at], minlength=n)
        near = (common >= share * (size[k] + size - common) - 1e-9) & (label != label[k])
        if across:
            near &= block != block[k]
        for j in np.flatnonzero(near).tolist():
            if label[j] != label[k]:
                out.append((int(min(node[j], node[k])), int(max(node[j], node[k]))))
                label[label == label[j]] = label[k]
    return out


def links_within(open_: DataFrame, nodes: DataFrame, rows: DataFrame, words: int, share: float) -> DataFrame:
    """``a, b``: links between different classes inside the bands of ``open_`` (``band, node, class``), stored.

    The sets of a band meet in one task, those of a large band block by block: a task holds ``2 * BLOCK`` sets at most.
    Only links leave a task, at most one for each set.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            got = [shingle_set(texts[k].as_py() or b"", words) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays([pa.array([n for _, n in got], pa.int64()), pa.array([h.tobytes() for h, _ in got], pa.binary())], ["node", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            node, label, block = (np.array([h[k] for h in held], dtype=np.int64) for k in range(3))
            found = joining(node, label, block, [np.frombuffer(h[3], dtype=np.uint64) for h in held], share, now[1] != now[2]) if held else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)] + [batch.column(6)]
            for k, key in enumerate(zip(*columns[:3], strict=True)):
                if key != now:
                    if len(held) > 1:
                        yield out()
                    now, held = key, []
                held.append((columns[3][k], columns[4][k], columns[5][k], columns[6][k].as_py()))
        if len(held) > 1:
            yield out()

    ids = nodes.join(open_.select("node").distinct(), "node", "left_semi").select("doc_id").distinct()
    # Rows that share an id may have other sets; those that no band asks for find no partner below.
    sets = rows.join(ids, "doc_id", "left_semi").select("text").mapInArrow(shingles, "node long, hashes binary")
    sets = stored(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "shingle-sets")
    counts = open_.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = open_.join(counts, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "class", "block")
    dealt = spread.join(sets, "node").repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "node")
    found = stored(dealt.select("band", "lo", "hi", "node", "class", "block", "hashes").mapInArrow(compare, "a long, b long").distinct(), "links")
    dropped(sets)
    return found


def near_copies(docs: DataFrame, words: int = 5, share: float = 0.8, text: str = "text", key: str = "doc_id", radius: int = 3) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs`` with an id.

    Documents whose sets of ``words``-word shingles overlap by ``share`` or more
    (intersection by union) are linked; ``component_id`` is the smallest id
    reachable.  Texts without words are copies of each other.

    First the Gray index links fingerprints within ``radius`` bits; linked sets are compared.
    What is still in different classes meets on one of ``BANDS`` keys of ``ROWS`` least values each: a pair at
    0.8 has none with a chance of 3 in a million.  The sets of a key
    are compared with its least one; then those of a key that are still in different classes
    are compared inside tasks, which give the links that join them and no other pairs.
    """
    rows = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = stored(sketches(rows, words), "sketches")
    nodes = stored(found.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "sets")
    fps = stored(nodes.groupBy("fp").agg(F.min("node").alias("node")), "distinct-fingerprints")
    same = nodes.join(fps.withColumnRenamed("node", "a"), "fp").select("a", F.col("node").alias("b")).where("a <> b")
    gray = alike(stored(links(fps, radius).unionByName(same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates"), nodes, rows, words, share)
    dealt = stored(nodes.join(components(gray), "node", "left").select("node", "size", "keys", F.coalesce("root", "node").alias("class")), "dealt").select("node", "size", "class", F.explode("keys").alias("band"))
    centres = dealt.groupBy("band").agg(F.min(F.struct("node", "size", "class")).alias("c"), F.count("*").alias("n")).where("n > 1")
    centres = centres.select("band", F.col("c.node").alias("centre"), F.col("c.size").alias("centre_size"), F.col("c.class").alias("centre_class"))
    near = lambda x, y: F.least(x, y) >= F.lit(share) * F.greatest(x, y) - 1e-9
    first = dealt.join(centres, "band").where((F.col("class") != F.col("centre_class")) & near("size", "centre_size"))
    first = stored(first.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "candidates")
    found_links = gray.unionByName(alike(first, nodes, rows, words, share))
    roots = components(found_links)
    dealt = dealt.drop("class")
    classed = stored(dealt.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("class")), "classed")
    mixed = classed.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("band")
    open_ = stored(classed.join(mixed, "band", "left_semi"), "open")
    roots = components(found_links.unionByName(links_within(open_, nodes, rows, words, share)))
    classes = found.select("doc_id", "node").join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return classes.join(least, "root").select("doc_id", "component_id")


def _first_of(docs: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    first = classes.where("doc_id = component_id").select(F.col("doc_id").alias("first_id")).distinct()
    return docs.join(first.hint("shuffle_hash"), F.col(f"`{key}`") == F.col("first_id"), "left_semi")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class; rows that share an id stay or go together."""
    return _first_of(docs, near_duplicates(docs, words, radius, text, key), key)


def one_of_near_copies(docs: DataFrame, words: int = 5, share: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The same for the classes of :func:`near_copies`."""
    return _first_of(docs, near_copies(docs, words, share, text, key), key)
