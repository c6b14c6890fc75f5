"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line or, with ``wrapped``, any run of words inside a paragraph that
is no longer than the template divided by the threshold.  A template matches a block when the block holds at least
``threshold`` of the template's distinct words.  Template words are ordered by
their document frequency in all documents, rarest first; a match must hold one
of the first ``n - ceil(threshold * n) + 1`` words (prefix filter), have enough
distinct words (length filter), and have enough template words left behind the
first one found (position filter).  What passes is compared word by word, so
the join is exact.  Templates are few and stay with every task; documents are
read where they lie and never shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import ALNUM, Words, blocks, word_hash, words

#: Fixed by the contract: phrases, and the labels they stand for.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public notices, whole paragraphs of licence texts and the short forms that texts and source files carry.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ],
    "bsd": [
        "Licensed under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "cc-by": ["Creative Commons Attribution License", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial License"],
    "cc-by-sa": ["Text is available under the Creative Commons Attribution-ShareAlike License"],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "This work is licensed under the GNU General Public License, version 3",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "lgpl": [
        "under the terms of the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https mozilla.org MPL 2.0",
    ],
    "public-domain": [
        "This work has been released into the public domain",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ],
}

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"


def template_words(templates: dict[str, list[str]]) -> list[tuple[str, frozenset[bytes], int]]:
    """Label, distinct words and number of words of each template."""
    out = []
    for label, texts in templates.items():
        for text in texts:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            found = words(data, np.array([0, len(data)]), ALNUM)
            out.append((label, frozenset(found.word(k) for k in range(len(found.starts))), len(found.starts)))
    return [(label, tokens, n) for label, tokens, n in out if tokens]


def frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many of all documents each word of the (small, fixed) vocabulary occurs."""
    vocabulary = sorted(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array([word_hash(w) for w in vocabulary], dtype=np.uint64)
        order = np.argsort(known)
        ranked = known[order]
        totals = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for _, data, offsets in blocks(batch.column(0)):
                found = words(data, offsets, ALNUM)
                at = np.minimum(np.searchsorted(ranked, found.hashes), len(ranked) - 1)
                hit = np.flatnonzero(ranked[at] == found.hashes)
                pairs = np.unique(found.text_of(hit) * len(ranked) + at[hit])
                totals += np.bincount(order[pairs % len(ranked)], minlength=len(ranked))
        yield pa.RecordBatch.from_pydict({"word": vocabulary, "n": totals}, pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # one row for each word of the vocabulary


class Index:
    """Templates with their words rarest first, and what each prefix word leads to."""

    def __init__(self, templates: list[tuple[str, frozenset[bytes], int]], counts: dict[bytes, int], threshold: float) -> None:
        self.templates, self.needed, self.bounds, self.leads = [], [], [], {}
        for t, (label, tokens, n) in enumerate(templates):
            order = sorted(tokens, key=lambda w: (counts.get(w, 0), w))
            needed = max(1, math.ceil(threshold * len(order) - 1e-9))
            self.templates.append((label, order))
            self.needed.append(needed)
            self.bounds.append(math.ceil(n / threshold - 1e-9))
            for place, word in enumerate(order[: len(order) - needed + 1]):
                self.leads.setdefault(word, []).append((t, place))

    def matches(self, block: set[bytes], found: set[bytes]) -> Iterator[tuple[str, float]]:
        """Templates that ``block`` holds; ``found``: its prefix words."""
        least: dict[int, int] = {}
        for word in found:
            for t, place in self.leads[word]:
                least[t] = min(place, least.get(t, place))
        for t, place in least.items():
            label, order = self.templates[t]
            if len(block) < self.needed[t] or len(order) - place < self.needed[t]:
                continue
            common = sum(w in block for w in order)
            if common >= self.needed[t]:
                yield label, common / len(order)


def most_in_run(at: list[int], said: list[bytes], bound: int) -> int:
    """The most distinct words of ``said``, which stand at ``at``, in a run of ``bound`` words."""
    most, lo, held = 0, 0, Counter()
    for hi, place in enumerate(at):
        held[said[hi]] += 1
        while at[lo] <= place - bound:
            held[said[lo]] -= 1
            if not held[said[lo]]:
                del held[said[lo]]
            lo += 1
        most = max(most, len(held))
    return most


def runs(index: Index, found: Words, breaks: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, str, float, int]]:
    """Text, label, share and first word of the paragraph for each template in a run of words; ``hits``: prefix words.

    Prefix words that stand within a run's length of each other are looked at
    together.  Of the template's words, rarest first, those in front of the first of
    them and the other prefix words that are not among them are not here, so what
    can still be found is known from their places; of the block, no more words than
    stand around them.  Where that is too little, no word is compared.
    """
    line, of = np.searchsorted(breaks, found.starts), found.text_of(np.arange(len(found.starts)))
    first = np.append(np.flatnonzero(np.concatenate([[True], (np.diff(line) > 1) | (np.diff(of) > 0)])), len(line))
    places: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for k in hits.tolist():
        for t, place in index.leads.get(found.word(k), ()):
            p = int(np.searchsorted(first, k, "right")) - 1
            places.setdefault((p, t), []).append((k, place))
    for (p, t), at in places.items():
        label, order = index.templates[t]
        bound, tokens, needed = index.bounds[t], set(order), index.needed[t]
        start, end = int(first[p]), int(first[p + 1])
        if end - start < needed:
            continue
        # Every run that matches holds a prefix word: look at the words around them, each once.
        near: dict[int, bytes] = {}
        done, lo = start, 0
        while lo < len(at):
            hi = lo + 1
            while hi < len(at) and at[hi][0] - at[hi - 1][0] < bound:
                hi += 1
            group = at[lo:hi]
            lo = hi
            seen = len({place for _, place in group})
            room = min(end, group[-1][0] + bound) - max(start, group[0][0] - bound + 1)
            behind = len(order) - 1 - (len(order) - needed)  # words behind the prefix
            if seen + min(behind, room - len(group)) < needed:
                continue
            for k, _ in group:
                for j in range(max(done, k - bound + 1), min(end, k + bound)):
                    if (word := found.word(j)) in tokens:
                        near[j] = word
                done = max(done, min(end, k + bound))
        common = most_in_run(list(near), list(near.values()), bound)
        if common >= needed:
            yield int(of[first[p]]), label, common / len(order), int(first[p])


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None, threshold: float = 0.85, text: str = "text", key: str = "doc_id", wrapped: bool = False) -> DataFrame:
    """One row per row of ``docs`` (``SCHEMA``).

    ``score`` is the largest share of a template found in a block, 1 where a
    phrase stands, 0 where nothing is found; ``n_blocks`` counts the lines that
    matched a template, with ``wrapped`` the paragraphs.  A paragraph ends at a line
    without words.  Null and empty texts have no words and no labels;
    repeated rows are scanned each for itself; an empty table gives no rows;
    other columns are ignored.
    """
    phrases = PHRASES if phrases is None else phrases
    wanted = template_words(TEMPLATES if templates is None else templates)
    vocabulary = {w for _, tokens, _ in wanted for w in tokens}
    counts = frequencies(docs, vocabulary, text) if vocabulary else {}
    spelled = [([w.encode() for w in p.split()], label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(wanted, counts, threshold)
        prefix = np.sort(np.array([word_hash(w) for w in index.leads], dtype=np.uint64))
        phrase_hashes = [np.array([word_hash(w) for w in p], dtype=np.uint64) for p, _ in spelled]
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for row, data, offsets in blocks(batch.column(1)):
                found = words(data, offsets, ALNUM)
                count = len(offsets) - 1
                n, first = np.diff(found.first), found.first
                base: list[list[tuple[int, str]]] = [[] for _ in range(count)]
                for (spelling, label), hashes in zip(spelled, phrase_hashes, strict=True):
                    m = len(hashes)
                    at = np.flatnonzero(found.hashes[: max(0, len(found.hashes) - m + 1)] == hashes[0])
                    for j in range(1, m):
                        at = at[found.hashes[at + j] == hashes[j]]
                    for k, d in zip(at, found.text_of(at), strict=True):
                        if k + m <= first[d + 1] and all(found.word(k + j) == w for j, w in enumerate(spelling)):
                            base[d].append((int(k - first[d]), label))
                extra: list[dict[str, float]] = [{} for _ in range(count)]
                matched = [0] * count
                paragraphs: list[set[int]] = [set() for _ in range(count)]
                if len(prefix) and len(found.hashes):
                    at = np.minimum(np.searchsorted(prefix, found.hashes), len(prefix) - 1)
                    hits = np.flatnonzero(prefix[at] == found.hashes)
                    breaks = np.flatnonzero(data == 10)
                    if wrapped:
                        for d, label, share, paragraph in runs(index, found, breaks, hits):
                            extra[d][label] = max(share, extra[d].get(label, 0.0))
                            paragraphs[d].add(paragraph)
                        matched = [len(p) for p in paragraphs]
                        hits = hits[:0]
                    lines = np.searchsorted(breaks, found.starts[hits])
                    docs_of = found.text_of(hits)
                    seen = None
                    for k, line, d in zip(hits, lines, docs_of, strict=True):
                        if (line, d) == seen:
                            continue
                        seen = (line, d)
                        lo = max(offsets[d], breaks[line - 1] + 1 if line else 0)
                        hi = min(offsets[d + 1], breaks[line] if line < len(breaks) else len(data))
                        a, b = np.searchsorted(found.starts, [lo, hi])
                        block = {found.word(j) for j in range(a, b)}
                        got = list(index.matches(block, block & index.leads.keys()))
                        matched[d] += bool(got)
                        for label, share in got:
                            extra[d][label] = max(share, extra[d].get(label, 0.0))
                for d in range(count):
                    places = [p for p, _ in base[d]]
                    own = sorted({label for _, label in base[d]})
                    every = sorted({*own, *extra[d]})
                    score = 1.0 if places else max(extra[d].values(), default=0.0)
                    rows.append((ids[row + d], int(n[d]), len(places), min(places, default=None), max(places, default=None), ",".join(own), ",".join(every), score, matched[d]))
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, SCHEMA)
