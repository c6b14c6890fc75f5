"""Cost-balanced packing of tokenised documents into fixed-length sequences.

One pass without a shuffle: a task tokenises its documents and packs them block
by block.  Within a block the cost of a piece of ``n`` tokens is estimated as
``linear * n + quadratic * n * n`` (projections and attention), and documents in
descending order go to the sequence of lowest cost that still has room.  What
fits nowhere is cut into the gaps, so every sequence but the task's last ones is
full; the rest of a task becomes sequences of a power of two, which need no
padding.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept

#: White space as the tokenizer's normalizer has it; no token crosses it.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")

#: ASCII marks but the apostrophe, which starts tokens of its own kind.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: The pattern that keeps runs of letters and runs of marks apart; with another one every new part goes through the whole tokenizer.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, sequence_cost double"


class Encoder:
    """Little-endian 32-bit ids of whole texts, with a bounded cache of the parts between white space.

    A part may be encoded alone because the normalizer and the pattern of the
    tokenizer keep white space as a boundary.  A part of letters with marks
    around it, the usual case, goes to the tokenizer's model run by run; any other
    new part goes through the whole tokenizer, and so does a text that holds a
    special token's spelling.
    """

    def __init__(self, path: str, end_id: int, cache_parts: int = 400_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.uint32(end_id).tobytes()
        self.bound = cache_parts
        self.cache: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {"": b""}
        parts = json.loads(self.tokenizer.to_str())
        steps = [x.get("type") for x in (parts["normalizer"] or {}).get("normalizers", [])]
        cuts = [x.get("pattern", {}).get("Regex") for x in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_run = steps == ["NFC", "Replace", "Lowercase"] and cuts[:1] == [_PATTERN]

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else self.tokenizer.pre_tokenizer.pre_tokenize_str(run)[0][0]
        got = self.runs[run] = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(spelled)])
        return got

    def _part(self, part: str) -> bytes:
        if self.by_run and "Σ" not in part:
            low = part.lower()
            core = low.strip(_MARKS)
            if core.isalpha() and (core.isascii() or is_normalized("NFC", core)):
                got = self.runs.get(core) or self._run(core)
                if len(core) == len(low):
                    return got
                at = low.index(core)
                head, tail = low[:at], low[at + len(core) :]
                return (self.runs.get(head) or self._run(head) if head else b"") + got + (self.runs.get(tail) or self._run(tail) if tail else b"")
        return self._ids(part)

    @staticmethod
    def _parts(text: str) -> list[str]:
        """``str.split`` also takes four control characters for white space."""
        return _SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        whole = [any(s in t for s in self.special) for t in texts]
        cut = [[] if w else self._parts(t) for w, t in zip(whole, texts, strict=True)]
        cache = self.cache
        new = {p for parts in cut for p in parts if p not in cache}
        if len(cache) + len(new) > self.bound:
            cache = self.cache = {"": b""}
            new = {p for parts in cut for p in parts}
        if len(self.runs) > self.bound // 2:
            self.runs = {"": b""}
        for part in new:
            cache[part] = self._part(part)
        code = cache.__getitem__
        return [(self._ids(t) if w else b"".join(map(code, parts))) + self.end for w, t, parts in zip(whole, texts, cut, strict=True)]


def _encoder(path: str, end_id: int) -> Encoder:
    """One for each Python worker, which runs many tasks; tasks of other operators let it go."""
    return kept(("encoder", path, end_id), lambda: Encoder(path, end_id))


class Packer:
    """Packs pieces ``(doc_id, start, n, ids, doc_tokens)``; ``rows`` collects what is placed."""

    def __init__(self, first_sequence: int, size: int, linear: float, quadratic: float) -> None:
        self.next, self.size, self.linear, self.quadratic = first_sequence, size, linear, quadratic
        self.rows: list[tuple] = []

    def cost(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n

    def _emit(self, pieces: list[tuple]) -> None:
        total, cost, offset = sum(p[2] for p in pieces), sum(self.cost(p[2]) for p in pieces), 0
        for doc, start, n, ids, doc_tokens in pieces:
            self.rows.append((doc, start, n, zlib.crc32(ids), doc_tokens, self.next, offset, total, cost))
            offset += n
        self.next += 1

    def whole(self, piece: tuple) -> tuple | None:
        """Cut full sequences off a long document; what is left, if anything."""
        doc, start, n, ids, doc_tokens = piece
        at, view = 0, memoryview(ids)
        while n - at >= self.size:
            self._emit([(doc, start + at, self.size, view[4 * at : 4 * (at + self.size)], doc_tokens)])
            at += self.size
        return (doc, start + at, n - at, bytes(view[4 * at :]), doc_tokens) if at < n else None

    def _fill(self, bins: list[list], capacities: list[int], rest: list[tuple]) -> list[tuple]:
        """Cut ``rest`` into the gaps of ``bins``; what is left over."""
        rest = rest[::-1]
        for pieces, room in zip(bins, capacities, strict=True):
            while room and rest:
                doc, start, n, ids, doc_tokens = rest.pop()
                k = min(n, room)
                pieces.append((doc, start, k, ids[: 4 * k], doc_tokens))
                room -= k
                if k < n:
                    rest.append((doc, start + k, n - k, ids[4 * k :], doc_tokens))
        return rest[::-1]

    def block(self, items: list[tuple]) -> list[tuple]:
        """Fill as many sequences as the items' tokens allow; the pieces that are left over."""
        count = sum(p[2] for p in items) // self.size
        if not count:
            return items
        bins, room = [[] for _ in range(count)], [self.size] * count
        heap, rest = [(0.0, b) for b in range(count)], []
        for piece in sorted(items, key=lambda p: (-p[2], p[0], p[1])):
            n, seen = piece[2], []
            while heap and room[heap[0][1]] < n:
                seen.append(heapq.heappop(heap))
            if heap:
                cost, b = heapq.heappop(heap)
                bins[b].append(piece)
                room[b] -= n
                if room[b]:
                    heapq.heappush(heap, (cost + self.cost(n), b))
            else:
                rest.append(piece)
            for x in seen:
                heapq.heappush(heap, x)
        rest = self._fill(bins, room, rest)
        for pieces in bins:
            self._emit(pieces)
        return rest

    def last(self, items: list[tuple]) -> None:
        """The end of a task: sequences of descending powers of two."""
        total = sum(p[2] for p in items)
        sizes = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
        bins: list[list] = [[] for _ in sizes]
        self._fill(bins, sizes, sorted(items, key=lambda p: (-p[2], p[0], p[1])))
        for pieces in bins:
            self._emit(pieces)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, block_sequences: int = 128, linear: float = 1.0, quadratic: float = 1.0 / 2048, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of all documents, each with its place in a sequence (``SCHEMA``).

    ``block_sequences`` bounds what a task holds: that many sequences' tokens.
    Null and empty texts have one token, the end id.  Documents longer than a
    sequence are cut; repeated rows are packed each for itself; an empty table
    gives no rows; further columns are ignored.  A task that runs again packs the
    same rows in the same way, and its number makes the sequence ids unique.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, end_id)
        packer = Packer(TaskContext.get().partitionId() << 33, size, linear, quadratic)
        items: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [[]] * 9
            packer.rows = []
            kinds = [pa.int64()] * 8 + [pa.float64()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    n = len(ids) // 4
                    piece = (doc, 0, n, ids, n)
                    if n >= size:
                        piece = packer.whole(piece)
                    if piece:
                        items.append(piece)
                        held += piece[2]
                    if held >= block_sequences * size:
                        items = packer.block(items)
                        held = sum(p[2] for p in items)
                if len(packer.rows) > 4096:
                    yield out()
        packer.last(packer.block(items))
        yield out()

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
