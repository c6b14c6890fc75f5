"""Empty tables, null ids and texts, a very long text and clashing columns, through every operator on documents."""

import weakref

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import decontamination, licenses, packing, quality_rules, quotations, repeats, sharding, simhash

SCHEMA = "doc_id long, text string, fp long, node long, bucket long, key string, words string, hashes string, row string, h long, shard string, run_ int"
TOKENS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{k % 977} licensed under cc by {k}" for k in range(12_000))


def docs(spark, rows):
    return spark.createDataFrame([(d, t, *[None] * 10) for d, t in rows], SCHEMA)


def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "repeats": lambda spark, d: repeats.removal(d),
    "packing": lambda spark, d: packing.pack(d, TOKENS),
    "simhash": lambda spark, d: simhash.near_duplicates(d),
    "quality": lambda spark, d: quality_rules.quality_rules(d, labels(spark)),
    "licenses": lambda spark, d: licenses.scan(d),
    "decontamination": lambda spark, d: decontamination.contaminated(d, benchmark(spark, [(1, "one two three four five six seven eight nine ten"), (2, None), (3, "")])),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    """Null and blank texts, a repeated row and a text of half a million characters all go through; ids that are there come back."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "short"), (4, "short"), (5, LONG), (6, "ä" * 3000)]
    got = {r.doc_id for r in OPERATORS[name](spark, docs(spark, rows)).select("doc_id").collect()}
    assert got == (set() if name == "decontamination" else {1, 2, 3, 4, 5, 6})


def test_long_text_counts(spark):
    (r,) = quality_rules.quality_rules(docs(spark, [(5, LONG)]), labels(spark)).collect()
    assert r.n_words == len(LONG.split()) and r.word_chars == len(LONG) - LONG.count(" ")
    (r,) = licenses.scan(docs(spark, [(5, LONG)])).collect()
    assert r.n_base == 12_000 and "cc-by" in r.base_labels.split(",") and r.first_word == 3
    pieces = packing.pack(docs(spark, [(5, LONG)]), TOKENS).agg(F.sum("length"), F.max("doc_tokens")).first()
    assert pieces[0] == pieces[1]


def test_benchmark_without_items(spark):
    rows = docs(spark, [(1, "one two three four five six seven eight nine ten"), (2, None)])
    assert decontamination.contaminated(rows, benchmark(spark)).count() == 0
    kept = decontamination.without_contaminated(rows, benchmark(spark, [(1, "one two three four five six seven eight nine ten")]))
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == rows.columns


def test_stages_keep_columns(spark):
    rows = docs(spark, [(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta"), (3, None)])
    one = simhash.one_of_each(rows)
    assert one.columns == rows.columns and sorted(r.doc_id for r in one.collect()) == [1, 3]
    good = quality_rules.keep_good(rows, labels(spark))
    assert good.columns == rows.columns and good.count() == 0
    assert repeats.remove_repeats(rows).columns == rows.columns


def test_messages_and_shards_without_rows(spark, tmp_path):
    assert quotations.reply_order(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    base = str(tmp_path / "shards")
    sharding.append(docs(spark, [(None, None), (1, "a"), (1, "a")]), base)
    sharding.compact(spark, base)
    assert sharding.read(spark, base).count() == 3 and sharding.read(spark, base).columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")


def test_a_worker_lets_an_encoder_go_for_the_next_stage():
    class Docs:
        def mapInArrow(self, run, schema):
            return run

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a text of its own. " * 20] * 2)], ["doc", "text"])
    for stage in (repeats.anchors(Docs(), 100), simhash.sketches(Docs(), 5)):
        encoder = weakref.ref(packing._encoder(TOKENS, 1))
        assert packing._encoder(TOKENS, 1) is encoder()
        assert sum(b.num_rows for b in stage(iter([batch])))
        assert encoder() is None
