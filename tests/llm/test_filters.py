"""URL filters, quality rules, main text, license scans and decontamination."""

import datetime as dt
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordloom.llm import decontamination, html_text, licenses, quality_rules, queries, url_filters

DOCS = "doc_id long, text string, extra string"
WORDS = [f"w{k}" for k in range(400)]


def docs(spark, texts, schema=DOCS):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], schema)


# ---- URL filters


def entries(spark, rows):
    return spark.createDataFrame([(s, p, a, d and dt.date.fromisoformat(d)) for s, p, a, d in rows], "scope string, pattern string, action string, listed_on date")


LIST = [("domain", "Example.com", "block", "2024-01-01"), ("domain", "example.com", "allow", "2024-06-01"), ("host", "a.example.com", "block", "2024-03-01"), ("path", "a.example.com/ok", "allow", "2024-03-01"), ("host", None, "block", "2024-01-01"), ("odd", "x", "block", "2024-01-01")]
CAPTURES = [
    (1, "http://example.com/x", "2023-12-31", "none"), (2, "http://example.com/x", "2024-01-01", "block"), (3, "http://b.example.com", "2024-05-31", "block"), (4, "http://b.example.com:80/", "2024-06-01", "allow"),
    (5, "http://A.example.com/x", "2024-07-01", "block"), (6, "http://a.example.com/ok/y?q=1", "2024-07-01", "allow"), (7, "http://a.example.com/okay", "2024-07-01", "block"), (8, "http://notexample.com/", "2024-07-01", "none"),
    (9, None, "2024-07-01", "none"), (10, "no url", "2024-07-01", "none"), (11, "http://example.com/", None, "none"), (12, "", "2024-07-01", "none"),
]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_url_filters(spark, broadcast_rows):
    rows = [(k, u, d and dt.date.fromisoformat(d), "clash") for k, u, d, _ in CAPTURES] * 2
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at date, key string")
    got = {r.page_id: r for r in url_filters.filter_urls(captures, entries(spark, LIST), broadcast_rows=broadcast_rows).collect()}
    assert {k: got[k].verdict for k in got} == {k: v for k, _, _, v in CAPTURES}
    assert all(r.n_captures == 2 for r in got.values())
    assert got[6].matched == "p:a.example.com/ok"


def test_url_filters_without_rows(spark):
    captures = spark.createDataFrame([(1, "http://a.b/", dt.date(2024, 1, 1))], "page_id long, url string, fetched_at date")
    assert [r.verdict for r in url_filters.filter_urls(captures, entries(spark, [])).collect()] == ["none"]
    assert url_filters.filter_urls(captures.limit(0), entries(spark, LIST)).count() == 0


def test_url_filters_case_and_slashes(spark):
    """Hosts in any case, paths as written; a final slash of a pattern, a very long URL and two actions on one date."""
    listed = [("path", "A.org/Docs", "block"), ("path", "a.org/pub/", "block"), ("path", "a.org/pub", "allow"), ("host", "B.org.", "block"), ("path", "c.org", "block"), ("domain", "d.org", "allow"), ("domain", "D.org", "block")]
    urls = {
        "http://a.org/Docs/x": "block", "http://a.org/docs/x": "none", "http://A.ORG/Docs/": "block", "http://a.org/pub": "block", "http://a.org/pub/x": "block",
        "http://a.org/public": "none", "http://b.org/": "block", "http://c.org/": "block", "http://x.d.org/" + "y/" * 2000: "block",
    }
    day = dt.date(2024, 1, 1)
    table = spark.createDataFrame([(k, u, day, "m", 1) for k, u in enumerate(urls)], "page_id long, url string, fetched_at date, matched string, rank int")
    got = {r.url: r.verdict for r in url_filters.filter_urls(table, entries(spark, [(*x, "2024-01-01") for x in listed])).collect()}
    assert got == urls


# ---- quality rules


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(inside)


def test_counts_agree_with_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one", "one two", "a b c a b c", "a a a a a", "\x0bx\x0cy\x1cz", "é*#  ü\n\n\né*#  ü", "x " * 5000]
    texts += [" ".join(rng.choice("abcd") + rng.choice(["", "\n", "*", " "]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = {r.doc_id: tuple(r[1:6]) for r in quality_rules.text_statistics(docs(spark, texts)).collect()}
    assert got == {k: counts(t) for k, t in enumerate(texts)}


def labelled(n=300):
    rng = random.Random(1)
    texts, good = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = [rng.choice(WORDS) for _ in range(80)]
        texts.append(" ".join(w + "###" if bad else w for w in words))
        good.append(int(not bad))
    return texts, good


def test_rules_learn_and_apply(spark):
    texts, good = labelled()
    labels = spark.createDataFrame([(k, g, 0) for k, g in enumerate(good)] + [(None, 1, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    table = docs(spark, texts)
    out = {r.doc_id: r for r in quality_rules.quality_rules(table, labels).collect()}
    assert all(out[k].kept == bool(g) for k, g in enumerate(good))
    kept = quality_rules.keep_good(table, labels)
    assert kept.columns == table.columns
    assert kept.count() == sum(good)


def test_rules_hold_out(spark):
    """Rules from one half judge the other half right."""
    texts, good = labelled(400)
    rows = [r.asDict() | {"good": good[r.doc_id]} for r in quality_rules.text_statistics(docs(spark, texts)).collect()]
    rules = quality_rules.learn_rules([r for r in rows if r["doc_id"] < 200])
    wrong = sum(any(x.holds(r) for x in rules) == bool(r["good"]) for r in rows if r["doc_id"] >= 200)
    assert rules
    assert wrong <= 2


@pytest.mark.parametrize(("sf", "recall"), [("sf0.01", 0.6), ("sf0.1", 0.9)])
def test_rules_on_the_given_tables(spark, sf, recall):
    """Learned from four fifths of the labels, the list judges the last fifth; what the column says is what the rules say."""
    read = lambda name: spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
    rows = quality_rules.labelled_sample(read("documents"), read("labels"), 20_000)
    hit = missed = wrong = 0
    for fold in range(5):
        rules = quality_rules.learn_rules([r for r in rows if r["doc_id"] // 8 % 5 != fold])
        for r in (r for r in rows if r["doc_id"] // 8 % 5 == fold):
            out = any(rule.holds(r) for rule in rules)
            hit, missed, wrong = hit + (out and not r["good"]), missed + (not out and not r["good"]), wrong + (out and bool(r["good"]))
    print(sf, "precision", hit / (hit + wrong), "recall", hit / (hit + missed))
    assert hit >= 0.95 * (hit + wrong) and hit >= recall * (hit + missed)
    rules = quality_rules.learn_rules(rows)
    assert rules
    judged = [r.asDict() for r in quality_rules.apply_rules(read("documents"), rules).collect()]
    first = lambda r: next((k for k, rule in enumerate(rules, 1) if rule.holds(r)), 0)
    assert all(r["rule"] == first(r) and r["kept"] == (not r["base_failed"] and not first(r)) for r in judged)
    assert any(r["rule"] and not r["base_failed"] for r in judged)


def test_few_labels_ask_for_pure_rules():
    assert quality_rules.evidence(5, 0, 0.15) > 10.83 > quality_rules.evidence(2, 0, 0.15)
    assert quality_rules.learn_rules([]) == []


def test_rules_without_labels(spark):
    table = docs(spark, [" ".join(WORDS[:60]), "short", " ".join(["same words here"] * 30), None])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_rules(table, labels).collect()}
    assert out == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False)}
    assert quality_rules.quality_rules(table.limit(0), labels).count() == 0


# ---- main text

PAGE = """<html><head><title>x</title></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div>{open}<h1>The title of it</h1><p>This is the first paragraph of the article and it is long enough to be taken for good text with many of the usual words in it.</p>
<p>Short&nbsp;one.<script>var a="</p>";</script></p><p>And this is another &amp; a &lt;b&gt; of the kind that the author likes to write on a day like this one, as it was meant to be.{close}
<form><p>Your name please and the address of the person that you are</p><input></form><aside><p>Sidebar text that is long and has the words of the language in it so it would count as good text.</p></aside>
<section id="comments"><article class="comment"><p>I think that this is the best article of all that I have read in the last year, and it is a good one.</p></article><article><p>Me too, and that is all that there is to say on this.</p></article></section><footer>&copy; 2020</footer></body>"""
TEXT = """The title of it
This is the first paragraph of the article and it is long enough to be taken for good text with many of the usual words in it.
Short one.
And this is another & a <b> of the kind that the author likes to write on a day like this one, as it was meant to be."""


@pytest.mark.parametrize(("start", "end"), [("<article>", "</article>"), ("<main><div>", "</div></main>"), ('<div id="content">', "</div>")])
def test_main_text(start, end):
    assert html_text.main_text(PAGE.replace("{open}", start).replace("{close}", end))[0] == TEXT


def test_unclosed_and_odd_markup():
    assert html_text.main_text('<div class="ad">buy<article><p>One two.<p>Three &eacute;')[0] == "One two.\nThree é"
    assert html_text.main_text("<article>a < b <p title='x>y'>c</p><!-- <p>no</p> --></article>")[0] == "a < b\nc"
    assert html_text.main_text("")[0] == ""
    assert html_text.main_text("<nav>" * 3000)[0] == ""
    assert html_text.main_text("<article><p>" + "of the word " * 30_000 + "</p></article>")[0] == ("of the word " * 30_000).strip()


@pytest.mark.parametrize(("taken", "precision", "recall"), [("article|main", 0.95, 0.95), ("article|main|footer|aside|header|section", 0.9, 0.95)])
def test_two_passes_without_marks(spark, taken, precision, recall):
    """The given pages without class, id, role and the elements that mark an article, against the same pages with them."""
    same = more = less = 0
    for (html,) in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        plain = re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", html)
        plain = re.sub(rf"<(/?)(?:{taken})\b", r"<\1div", plain)
        marked, bare = (Counter(html_text.main_text(x)[0].split("\n")) for x in (html, plain))
        same += sum(n * len(x) for x, n in (marked & bare).items())
        more += sum(n * len(x) for x, n in (bare - marked).items())
        less += sum(n * len(x) for x, n in (marked - bare).items())
    print(taken, "precision", same / (same + more), "recall", same / (same + less))
    assert same >= precision * (same + more) and same >= recall * (same + less)


def test_long_and_deep_pages():
    """Time grows with the page, not with its square."""
    prose = "<p>" + "It is one of the things that they have in the house of the man. " * 5 + "</p>"
    assert html_text.main_text(prose * 20_000)[0].count("\n") == 19_999
    deep = "<div>" * 20_000 + prose + "</section>" * 20_000 + "</span>" * 20_000 + "</div>" * 20_000 + prose
    assert html_text.main_text(deep)[0].count("It is one") == 10


def test_extract_pages(spark):
    rows = [(1, "u", "<article><p>Hello.</p></article>", "t"), (1, "u", "<article><p>Hello.</p></article>", "t"), (2, None, None, None), (None, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", "Hello.", 6), (1, "u", "Hello.", 6), (2, "", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


# ---- licenses


def test_license_base_and_templates(spark):
    texts = [
        None, "", "All rights reserved. Licensed under CC BY-NC 4.0.", "x\nReleased under the MIT License.\ny", "Licensed under the Apache License, Version 2.0.", "cc\nby and CC by", "CCBY cc-by",
        "This work is licensed under the GNU General Public License, version 3.", "words " * 20_000 + "all rights reserved", "Released under the terms of the license",
    ]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).collect()}
    assert [got[k].labels for k in range(len(texts))] == ["", "", "cc-by,cc-by-nc,reserved", "mit", "apache-2.0", "cc-by", "cc-by", "gpl", "reserved", ""]
    assert [got[k].base_labels for k in (2, 3, 7)] == ["cc-by,reserved", "", "gpl"]
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].n_words) == (2, 0, 5, 10)
    assert (got[5].n_base, got[5].first_word, got[5].last_word) == (2, 0, 3)
    assert (got[8].first_word, got[0].first_word, got[0].score, got[2].score) == (20_000, None, 0.0, 1.0)
    assert licenses.scan(docs(spark, texts).limit(0)).count() == 0


def test_wrapped_notices_and_long_lines(spark, tmp_path):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n{}of this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    spread = " ".join(w + " filler" * 40 for w in "this work has been released into the public domain".split())
    texts = [mit.format(""), mit.format(" * "), bsd, "x\n\n" + mit.format("\n"), spread, "much " * 300 + "this work has been released into the public domain" + " more" * 300]
    docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.labels, r.n_blocks) for r in queries.op10_license_scan(spark, str(tmp_path)).collect()}
    assert got == {0: ("mit", 1), 1: ("mit", 1), 2: ("bsd", 1), 3: ("", 0), 4: ("", 0), 5: ("public-domain", 1)}


def test_whole_licence_headers(spark):
    """Headers as files carry them: comment marks, wrapped lines, quotation marks, and prose beside them."""
    mit = """# Copyright (c) 2020 A. Person
#
# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction.
#
# THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
# IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
# FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
    bsd = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 * 1. Redistributions of source code must retain the above copyright
 *    notice, this list of conditions and the following disclaimer."""
    gpl = """   This program is distributed in the hope that it will be useful,
   but WITHOUT ANY WARRANTY; without even the implied warranty of
   MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
   GNU General Public License for more details."""
    prose = "The software that she wrote in the office was free of any notice, and the person who got a copy of it was granted nothing."
    got = {r.doc_id: r for r in licenses.scan(docs(spark, [mit, bsd, gpl, prose]), wrapped=True).collect()}
    assert [got[k].labels for k in range(4)] == ["mit", "bsd", "gpl", ""]


def test_license_join_is_exact(spark):
    rng = random.Random(7)
    vocabulary = [f"t{k}" for k in range(14)]
    templates = {f"l{k}": [" ".join(rng.sample(vocabulary, rng.randint(3, 8)))] for k in range(12)}
    texts = ["\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 14))) for _ in range(3)) for _ in range(120)]
    got = {r.doc_id: r.labels for r in licenses.scan(docs(spark, texts), templates, {}, threshold=0.75).collect()}
    for k, text in enumerate(texts):
        lines = [set(x.split()) for x in text.split("\n")]
        want = sorted(label for label, (t,) in templates.items() if any(len(b & set(t.split())) >= 0.75 * len(set(t.split())) for b in lines))
        assert got[k] == ",".join(want), k


# ---- decontamination


def test_decontamination(spark):
    rng = random.Random(2)
    item = [rng.choice(WORDS) for _ in range(30)]
    other = [rng.choice(WORDS) for _ in range(30)]
    noise = lambda n: [f"n{rng.randint(0, 10**6)}" for _ in range(n)]
    swapped = [w if k not in (4, 12, 20) else "zz" for k, w in enumerate(item)]
    texts = [" ".join(noise(50)), " ".join(noise(20) + item + noise(20)), " ".join(noise(5) + swapped), "; ".join(x.upper() for x in item), " ".join(item[:8] + noise(30)), None, "", " ".join(noise(3) + item + noise(9) + item), "five tokens make one item", "a text, Too SHORT to tell"]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, None), (4, "Five tokens make one item!"), (5, "too short")], "item_id long, text string")
    table = docs(spark, texts)
    found = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(table, bench).collect()}
    assert set(found) == {(1, 1), (2, 1), (3, 1), (7, 1), (8, 4), (9, 5)}
    assert (found[1, 1].n_match, found[1, 1].first_word, found[1, 1].last_word) == (30, 20, 49)
    assert found[2, 1].n_match == 23  # the stretch after the first substitution
    kept = decontamination.without_contaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4, 5, 6, 9]  # two words alone remove nothing
    blocks = decontamination.contaminated(table, bench, bound=60)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(found)
    assert decontamination.contaminated(table, bench.limit(0)).count() == 0
    assert decontamination.contaminated(table.limit(0), bench).count() == 0


def test_masks_survive_each_substitution():
    """An item of 15 words is found whichever one of its words is changed."""
    words = [f"w{k}" for k in range(15)]
    bench = decontamination.Benchmark.of([(1, " ".join(words))])
    for k in range(15):
        text = " ".join("zz" if j == k else w for j, w in enumerate(words)).encode()
        data, offsets = decontamination.np.frombuffer(text, dtype="u1"), decontamination.np.array([0, len(text)])
        assert list(decontamination.hits(bench, data, offsets)), k


def documented_overlap(equal, need):
    """Brute force: some stretch has ``need`` matches and at most one mismatch in five."""
    return any(sum(equal[a:b]) >= need and 5 * (b - a - sum(equal[a:b])) <= b - a for a in range(len(equal)) for b in range(a + 1, len(equal) + 1))


def test_each_documented_overlap_is_found():
    """Items of 1 to 20 words with up to three words changed, at every place, at the production parameters."""
    for n in range(1, 21):
        words = [f"w{k}" for k in range(n)]
        bench = decontamination.Benchmark.of([(1, " ".join(words))])
        changes = [c for m in range(4) for c in itertools.combinations(range(n), m)]
        texts = [" ".join("zz" if k in c else w for k, w in enumerate(words)).encode() for c in changes]
        data, offsets = decontamination.np.frombuffer(b"".join(texts), dtype="u1"), decontamination.np.cumsum([0, *map(len, texts)])
        found = {row[0] for row in decontamination.hits(bench, data, offsets)}
        need = min(13, -(-4 * n // 5))
        assert found == {t for t, c in enumerate(changes) if documented_overlap([k not in c for k in range(n)], need)}, n


def test_masks_cover_every_stretch():
    """For each bound, all least stretches that fit into its items: no shorter one will do, and none has twice the bound's words."""
    longest = {4: 5, 3: 3, 2: 2, 1: 1}
    for bound, masks in decontamination.MASKS.items():
        for matches in range(bound, 2 * bound):
            for apart in range(matches // 4 + 1):
                n = matches + apart
                for c in itertools.combinations(range(1, n - 1), apart) if n <= longest.get(bound, n) else ():
                    row = "".join("0" if k in c else "1" for k in range(n))
                    assert any(all(row[a + j] == "1" for j, one in enumerate(m) if one == "1") for m in masks for a in range(n - len(m) + 1)), (bound, row)


def test_a_phrase_in_every_item_is_compared_in_lots(monkeypatch):
    """Small lots give what one lot gives, against brute force over all alignments."""
    rng = random.Random(8)
    intro = ["choose", "the", "one", "right", "answer", "now"]
    items = [(k, " ".join(intro + [rng.choice(WORDS[:60]) for _ in range(rng.randint(0, 20))])) for k in range(60)] + [(60, " ".join(intro * 9))]
    mine = [w.split() for _, w in items]
    texts = [" ".join(intro * 20 + mine[7] + intro), " ".join(mine[3][:15] + intro), "", " ".join(rng.choice(WORDS[:60]) for _ in range(300))]
    want = set()
    for t, text in enumerate(texts):
        said = text.split()
        for k, item in enumerate(mine):
            need = min(13, -(-4 * len(item) // 5))
            for start in range(-len(item) + 1, len(said)):
                equal = [0 <= start + j < len(said) and said[start + j] == w for j, w in enumerate(item)]
                lo, hi = max(0, -start), min(len(item), len(said) - start)
                if sum(equal) >= need and documented_overlap(equal[lo:hi], need):
                    want.add((t, k))
    raw = [x.encode() for x in texts]
    data, offsets = decontamination.np.frombuffer(b"".join(raw), dtype="u1"), decontamination.np.cumsum([0, *map(len, raw)])
    for lot, size in ((1 << 16, 1 << 22), (7, 50)):
        monkeypatch.setattr(decontamination, "LOT", lot)
        monkeypatch.setattr(decontamination, "LOT_WORDS", size)
        assert {row[:2] for row in decontamination.hits(decontamination.Benchmark.of(items), data, offsets)} == want


def test_columns_do_not_clash(spark):
    table = spark.createDataFrame([(1, "some text here", "a", "b", "c", "d")], "doc_id long, text string, n_words string, key string, words string, row string")
    assert quality_rules.text_statistics(table).count() == 1
    assert licenses.scan(table).count() == 1
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.keep_good(table, labels).columns == table.columns
    assert table.select(F.col("row")).count() == 1
