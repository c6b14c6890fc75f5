"""Deduplication, packing, sharding, quotations and the pipeline, against brute force."""

import hashlib
import random
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from recordloom.llm import components, packing, quotations, repeats, sharding, simhash

PATH = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, texts, ids=None):
    rows = [(k if ids is None else ids[k], t, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)


# ---- repeated strings


def removal(rows, width):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            if window in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def messy_texts(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéü") for _ in range(rng.randint(1, 6)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    base = " ".join(word() for _ in range(120))
    texts = [None, "", "short", "z" * 350, "z" * 120, "ab" * 200]
    texts += [f"{' '.join(word() for _ in range(rng.randint(0, 30)))} {rng.choice(passage)[rng.randint(0, 90):]} {' '.join(word() for _ in range(20))}" for _ in range(30)]
    texts += [base[: (k := rng.randint(1, len(base) - 2))] + word() + base[k + 1 :] for _ in range(25)] + [base] * 4
    return texts


@pytest.mark.parametrize(("split_over", "hot_rows"), [(4000, 20_000), (2, 20_000), (4000, 3)])
def test_repeats_agree_with_brute_force(spark, split_over, hot_rows, monkeypatch):
    texts = messy_texts()
    if hot_rows < 20_000:
        monkeypatch.setattr(repeats, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(repeats, "HOT_SHARE", 1)
        monkeypatch.setattr(repeats, "HOT_SALTS", 3)
    whole = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, t, w: whole(d, t, w, split_over))
    out = repeats.removal(docs(spark, texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == removal(list(enumerate(texts)), 100)


@pytest.mark.parametrize("seed", range(6))
def test_refinement_is_exact(seed):
    """Small alphabets, runs of one byte, periods and zeros, in small lots, against a table of all windows."""
    rng = random.Random(seed)
    alphabet = [b"a", b"ab", b"\0\1", b"abcd"][seed % 4]
    width, parts, shared = 32, [], bytes(rng.choice(alphabet) for _ in range(90))
    for _ in range(30):
        kind = rng.randrange(4)
        text = bytes(rng.choice(alphabet) for _ in range(rng.randint(32, 90)))
        parts.append([text, shared[: rng.randint(32, 90)], alphabet[:1] * rng.randint(32, 70), (text[: rng.randint(1, 9)] * 90)[:80]][kind])
    doc = np.array([rng.randrange(12) for _ in parts])
    lo = np.array([200 * k for k in range(len(parts))])
    n = np.array([len(x) - width + 1 for x in parts])
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, parts)])[:-1]
    places: dict[bytes, list] = {}
    for d, at, part in zip(doc.tolist(), lo.tolist(), parts, strict=True):
        for j in range(len(part) - width + 1):
            places.setdefault(part[j : j + width], []).append((d, at + j))
    want = {(d, b) for where in places.values() for d, at in sorted(where)[1:] for b in range(at, at + width)}
    order = repeats.suffix_order
    for lot in (1 << 17, 5):
        repeats.suffix_order = lambda *a, lot=lot: order(*a, lot=lot)
        try:
            got = repeats.refine(doc, lo, n, data, offsets, width)
        finally:
            repeats.suffix_order = order
        assert {(d, b) for d, x, y in zip(*(v.tolist() for v in got), strict=True) for b in range(x, y)} == want


def test_repeats_of_one_row_given_twice(spark):
    text = " ".join(f"word{k}" for k in range(60))
    got = [r.n_removed for r in repeats.removal(docs(spark, [text, text, None], [1, 1, None])).collect()]
    assert got == [0, 0]
    assert repeats.removal(docs(spark, [text]).limit(0)).count() == 0


def test_long_text_in_pieces():
    """Pieces of a long text find the same windows as the whole."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000, dtype=np.uint8)
    column = repeats.pa.array([data.tobytes()], repeats.pa.binary())
    windows = set()
    for own, at, piece, offsets in repeats.segments(column, np.array([7]), 100, most=700):
        text, lo, n, *_ = repeats.runs(piece, offsets)
        windows |= {int(at[0] + a + j) for a, m in zip(lo, n, strict=True) for j in range(m)}
        assert own.tolist() == [7]
    assert windows == set(range(4901))


def test_cut_texts_stay_texts(spark):
    texts = ["é" * 200 + "a", "é" * 200 + "b", "x"]
    out = repeats.remove_repeats(docs(spark, texts))
    assert out.columns == ["doc_id", "text", "spans"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[2] == "x"
    assert set(got[1]) <= {"é", "b"}
    assert len(got[1]) < 60


# ---- fingerprints


def brute_classes(fps):
    ids = sorted(fps)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x1c", "\0").split()
    words = [w.replace("\0", "\x1c") for w in words]
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_agrees_with_brute_force(spark):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 500)}" for _ in range(400)]
    texts = [None, "", "\n ", "One", "one", "one two", "É A\x1cb"] + [" ".join(w if rng.random() > 0.003 else "zz" for w in base) for _ in range(40)] + [" ".join(f"v{rng.randint(0, 500)}" for _ in range(50)) for _ in range(10)]
    out = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = {k: brute_fingerprint(t) for k, t in enumerate(texts)}
    assert {k: int(r.fingerprint, 16) for k, r in out.items()} == fps
    assert {k: r.component_id for k, r in out.items()} == brute_classes(fps)
    left = simhash.one_of_each(docs(spark, texts))
    assert left.columns == ["doc_id", "text", "spans"]
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(brute_classes(fps).values()))
    assert simhash.near_duplicates(docs(spark, texts).limit(0)).count() == 0


def test_near_copies_come_from_the_gray_index(spark, monkeypatch):
    """What fingerprints tell apart is settled before any other key is asked."""
    asked, alike = [], simhash.alike
    monkeypatch.setattr(simhash, "alike", lambda pairs, *rest: asked.append(pairs.count()) or alike(pairs, *rest))
    base = " ".join(f"word{k}" for k in range(600))
    left = simhash.one_of_near_copies(docs(spark, [base, f"{base} more", f"less {base}", "something else altogether"]))
    assert sorted(r.doc_id for r in left.collect()) == [0, 3]
    assert len(asked) == 2 and asked[0] >= 2 and asked[1] == 0


@pytest.mark.parametrize("block", [512, 3])
def test_one_of_near_copies(spark, block, monkeypatch):
    """Texts of 64 to 250 words with one to six words changed, against brute force over all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(4)
    texts = []
    for n in (64, 90, 120, 180, 250):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
        texts.append(" ".join(base))
        for changed in range(1, 7):
            at = set(rng.sample(range(n), changed))
            texts.append(" ".join("zz" if k in at else w for k, w in enumerate(base)))
        # A chain: each is a near copy of the one before it, the ends are not of each other.
        texts += [" ".join(base[k:] + [f"c{n}x{j}" for j in range(k)]) for k in range(4, n // 2, 4)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    parent = list(range(len(texts)))
    for y in range(len(texts)):
        for x in range(y):
            if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) and parent[x] != parent[y]:
                low, high = sorted((parent[x], parent[y]))
                parent = [low if p == high else p for p in parent]
    left = simhash.one_of_near_copies(docs(spark, texts))
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(parent))
    assert len(set(parent)) < len(texts) // 2


@pytest.mark.parametrize("across", [False, True])
def test_links_inside_a_key_are_whole(across):
    """What joins the labels, against all pairs."""
    for seed in range(20):
        rng = random.Random(seed)
        sets = [np.array(sorted(rng.sample(range(24), rng.randint(8, 20))), dtype=np.uint64) for _ in range(40)]
        label, block = np.array([rng.randrange(1, 30) for _ in sets]), np.array([rng.randrange(2) for _ in sets])
        got = simhash.joining(np.arange(40) * 10, label.copy(), block, sets, 0.8, across)

        def classes(links, label=label):
            parent = {int(x): int(x) for x in label}
            find = lambda x: x if parent[x] == x else find(parent[x])
            for a, b in links:
                parent[find(int(label[b]))] = find(int(label[a]))
            return {frozenset(y for y in parent if find(y) == x) for x in map(find, parent)}

        alike = lambda i, j: len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
        want = [(i, j) for i in range(40) for j in range(i) if alike(i, j) and (not across or block[i] != block[j])]
        assert classes([(a // 10, b // 10) for a, b in got]) == classes(want)
        assert all(alike(a // 10, b // 10) for a, b in got) and len(got) < 40


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_is_exact(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 4, dtype=np.uint64)
    fp = centres[rng.integers(0, 4, 600)]
    for _ in range(3):
        fp = fp ^ np.where(rng.random(600) < 0.7, np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64), np.uint64(0))
    fp = np.unique(fp)
    bucket = rng.integers(0, 3, len(fp))
    order = np.lexsort((fp, bucket))
    fp, bucket = fp[order], bucket[order]
    label = simhash.linked(bucket, fp, 3, chunk=7, frontier=64)
    near = (np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3) & (bucket[:, None] == bucket[None, :])
    want = np.arange(len(fp))
    while not np.array_equal(want, new := np.array([want[row].min() for row in near])):
        want = new
    assert np.array_equal(label, want)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (10, 9), (9, 8), (8, 7), (7, 6), (5, 5), (20, 21), (21, 20)] + [(100 + k, 101 + k) for k in range(30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {2: 1, 3: 1, 7: 6, 8: 6, 9: 6, 10: 6, 21: 20} | {101 + k: 100 for k in range(30)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- packing


def test_packing_is_exact(spark):
    rng = random.Random(3)
    texts = [None, "", "a  b\tc", "Don't 'tis 12 ΑΣ İ é é <|endoftext|> x", "x\x1cy　z"] + [" ".join(rng.choice(["the", "Packing,", "größe", "42", "###", "naïve!"]) for _ in range(rng.choice([3, 40, 700, 5000]))) for _ in range(60)]
    out = packing.pack(docs(spark, texts + texts[-2:], [*range(len(texts)), 900, 901]), PATH, size=256, block_sequences=8).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in enumerate(texts)}
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert {k for k in pieces if k < 900} == set(ids)
    for k, tokens in ids.items():
        own = sorted(pieces[k], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(q.length for q in own[:j]) for j in range(len(own))]
        assert sum(r.length for r in own) == len(tokens) == own[0].doc_tokens
        for r in own:
            assert zlib.crc32(np.array(tokens[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(q.length for q in own[:j]) for j in range(len(own))]
        total = sum(r.length for r in own)
        assert total == 256 or total & (total - 1) == 0
    assert packing.pack(docs(spark, texts).limit(0), PATH).count() == 0


def test_packing_balances_costs():
    packer = packing.Packer(0, 100, 1.0, 1.0)
    items = [(k, 0, n, b"\0" * 4 * n, n) for k, n in enumerate([60, 60, 40, 40, 50, 50, 30, 30, 20, 20])]
    assert packer.block(items) == []
    assert {r[7] for r in packer.rows} == {100}
    assert max(r[8] for r in packer.rows) <= 60 * 61 + 40 * 41


# ---- sharding


def test_sharding(spark, tmp_path):
    base = str(tmp_path / "store")
    rows = lambda a, b: spark.range(a, b).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("r").alias("run"), F.lit("s").alias("shard"))
    assert sharding.append(rows(0, 0), base) == 1
    assert sharding.read(spark, base).columns == ["id", "text", "run", "shard"] and sharding.read(spark, base).isEmpty()
    for k in range(4):
        assert sharding.append(rows(1000 * k, 1000 * (k + 1)).coalesce(1), base, shard_rows=100, small=1 << 12) == k + 2
    before = sharding.manifest(spark, base).count()
    assert before == 40
    version = sharding.compact(spark, base, target=1 << 16, small=1 << 12)
    after = sharding.manifest(spark, base)
    assert version == 6
    assert after.count() < before / 4
    assert after.agg(F.sum("n_rows")).first()[0] == 4000
    assert sharding.compact(spark, base, target=1 << 16, small=1 << 12) == version  # nothing left to merge
    got = sharding.read(spark, base)
    assert got.columns == ["id", "text", "run", "shard"]
    assert got.exceptAll(rows(0, 4000)).isEmpty()
    assert got.count() == 4000
    assert sharding.read(spark, base, 3).count() == 2000  # older versions stay readable
    with pytest.raises(RuntimeError):
        sharding._commit(spark, base, after, version, got.schema)
    assert sharding.vacuum(spark, base) >= before  # and the files without rows of the first arrival
    assert sharding.vacuum(spark, base) == 0
    assert sharding.read(spark, base).count() == 4000


def test_shards_with_clashing_columns_and_two_writers(spark, tmp_path):
    base = str(tmp_path / "store")
    rows = spark.range(400).select(F.col("id").alias("Run__"), F.lit("x").alias("shard__"), F.lit(None).cast("string").alias("run___"))
    for _ in range(2):
        sharding.append(rows.repartition(3), base, shard_rows=20, small=1 << 9)
        sharding.compact(spark, base, target=1 << 14, small=1 << 9)
    got = sharding.read(spark, base)
    assert got.columns == rows.columns and got.count() == 800 and got.distinct().count() == 400
    with pytest.raises(ValueError, match="columns differ"):
        sharding.append(spark.range(3), base)
    # Writers that start at once: each arrival is in the newest version, whoever comes first.
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: sharding.append(rows.where(F.col("Run__") < k), base), [10, 20, 30, 40]))
    assert sharding.read(spark, base).count() == 900
    assert not sharding._create_once(spark, f"{base}/versions/v{1:012d}", "late")


# ---- quotations


def test_parse_levels():
    own, quoted = quotations.parse("> > old\n> new\nOn Monday Li wrote:\n>>deep\n mine \n> new")
    assert own == "mine"
    assert quoted == [(2, "old"), (1, "new"), (2, "deep"), (1, "new")]


def test_reply_order(spark):
    rows = [
        (1, 0, "a", "Question one?\nSecond line"), (1, 1, "b", "> question  ONE?\n> Second line\nAnswer"), (1, 2, "c", "> > Question one?\n> Answer\nMore"), (1, 3, "d", "> Question one?\n> Second line\nOther branch"),
        (1, 4, "e", "> never said\nNew thread"), (1, 5, "f", None), (2, 0, "a", "Answer"), (2, 1, "b", "> Answer\nOk"), (None, 0, "a", "x"), (2, 1, "b", "> Answer\nOk"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotations.reply_order(table).collect()}
    assert {k: r.parent_turn for k, r in got.items()} == {(1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 4): None, (1, 5): None, (2, 0): None, (2, 1): 0}
    assert [t for _, t in sorted((r.reply_order, r.turn) for r in got.values() if r.conv_id == 1)] == [0, 1, 2, 3, 4, 5]
    assert (got[1, 2].depth, got[1, 2].root_turn, got[1, 2].text, got[1, 5].text) == (2, 0, "More", "")
    assert quotations.reply_order(table.limit(0)).count() == 0


def test_deeper_quotes_find_an_ancestor(spark):
    rows = [
        (1, 0, "a", "First words"), (1, 1, "b", "Second words\n> First words"), (1, 2, "a", "Inner reply trimmed\n> > First words"),
        (1, 3, "b", "Parent missing\n> not in the table\n> > Second words\n> > > First words"), (1, 4, "a", "Level one first\n> Second words\n> > First words\n> > Inner reply trimmed"),
    ]
    got = {r.turn: (r.parent_turn, r.depth) for r in quotations.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {0: (None, 0), 1: (0, 1), 2: (0, 1), 3: (1, 2), 4: (1, 2)}


@pytest.mark.parametrize("seed", range(2))
def test_threads_are_read_depth_first(spark, seed):
    """Random reply trees in one large conversation and some small ones, against recursion; parts are small, so groups are split."""
    rng = random.Random(seed)
    parents, rows = {}, []
    for conv, n in ((1, 150), (2, 1), (3, 12)):
        for t in range(n):
            p = None if t == 0 or rng.random() < 0.1 else (0 if rng.random() < 0.4 else rng.randrange(t))
            parents[conv, t] = p
            rows.append((conv, t, "r", f"common line\nmessage {t} of it" + ("" if p is None else f"\n> common line\n> message {p} of it"), "own", 1))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, own string, depth int")
    got = {(r.conv_id, r.turn): r for r in quotations.reply_order(table.repartition(3)).collect()}
    assert {k: r.parent_turn for k, r in got.items()} == parents

    def walk(conv, turn, depth):
        yield turn, depth
        for (c, t), p in parents.items():
            if c == conv and p == turn:
                yield from walk(conv, t, depth + 1)

    for conv in (1, 2, 3):
        want = [x for (c, t), p in parents.items() if c == conv and p is None for x in walk(conv, t, 0)]
        own = sorted((r.reply_order, r.turn, r.depth) for (c, _), r in got.items() if c == conv)
        assert own == [(k, *x) for k, x in enumerate(want, 1)]


def test_odd_messages(spark):
    """Nulls, repeats and a very long text."""
    long = "word " * 100_000
    rows = [(1, 1, None, None), (1, 1, None, None), (1, 2, "b", long), (1, 3, "c", "Yes\n> " + long), (None, None, None, "x"), (1, None, "d", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.parent_turn, len(r.text), r.reply_order) for r in quotations.reply_order(table).collect()}
    assert got == {1: (None, 0, 1), 2: (None, len(long) - 1, 2), 3: (2, 3, 3)}


# ---- pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.randint(0, 10**5)}" for _ in range(n))
    passage, item, copied = fresh(60), fresh(30), fresh(200)
    texts = [fresh(120), "too short", " ".join(["again and again"] * 40), copied, copied, fresh(80) + " " + passage, passage + " " + fresh(90), fresh(60) + " " + item + " " + fresh(30), None, fresh(70)]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(k, 1, 0) for k in (0, 3, 9)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    left, seen = table, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, left, str(tmp_path)).write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        assert left.columns == table.columns
        seen.append(sorted(r.doc_id for r in left.collect()))
    assert seen == [[0, 3, 4, 5, 6, 7, 9], [0, 3, 5, 6, 7, 9], [0, 3, 5, 6, 7, 9], [0, 3, 5, 6, 9]]
    final = {r.doc_id: r for r in left.collect()}
    assert final[0].text == texts[0]
    assert passage in final[5].text
    assert passage not in final[6].text
    assert final[6].n_chars == len(final[6].text)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r.doc_id for r in out.collect()}) == seen[-1]
