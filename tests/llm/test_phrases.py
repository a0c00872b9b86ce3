"""Collocations against a brute-force count."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tagstream.llm import phrases
from tests.llm.helpers import awkward_docs, docs_frame, empty_docs, table


def brute(rows, min_count=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    f[lang][tuple(words[at:at + size])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in cands.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    if 100 * a >= 50 * counts[part]:
                        gone.add(part)
        rows_ = []
        for p, a in cands.items():
            if p in gone:
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equal_to_brute_force_on_a_table(spark):
    docs = table("documents")
    rows = [(d["doc_id"], d["text"], d["lang"]) for d in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = brute([(r[2], r[1]) for r in rows])
    assert len(want) > 1000
    assert mined(phrases.collocations(df)) == want


@pytest.mark.parametrize("how", [{"block_phrases": 60, "block_words": 9}, {"block_phrases": 2, "max_blocks": 0}])
def test_many_blocks_and_the_way_without_tries(spark, how):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(25)] + ["new", "york", "City", "Été"]
    texts = []
    for _ in range(120):
        t = " ".join(rng.choice(words, 30))
        texts.append(t[:60] + ". New York City, " + t[60:] + "\nnew york city\tnew york")
    df = docs_frame(spark, texts).repartition(5)
    want = brute([("en", t) for t in texts])
    assert {r[2] for r in want} >= {"new york city"}
    assert mined(phrases.collocations(df, **how)) == want


def test_awkward_rows(spark):
    df = awkward_docs(spark)
    rows = [(r["lang"], r["text"]) for r in df.collect()]
    assert mined(phrases.collocations(df, min_count=2)) == brute(rows, 2)


def test_borders_ties_and_languages(spark):
    rows = [(1, "a b. c d", None), (2, "A B\x0bc d", "und"), (3, "a b", "en"), (4, "x a\x1fb x", "en")] * 10
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = mined(phrases.collocations(df))
    assert got == brute([(r[2], r[1]) for r in rows])
    assert [(r[0], r[1], r[2]) for r in got if r[0] == "und"] == [("und", 1, "a b"), ("und", 2, "c d")]


def test_no_rows(spark):
    assert mined(phrases.collocations(empty_docs(spark))) == []
    assert mined(phrases.collocations(docs_frame(spark, ["", None, "one two"]))) == []


def test_trie_finds_what_it_holds():
    rng = np.random.default_rng(1)
    for depth, size, m in ((2, 50, 900), (2, 400, 9000), (3, 40, 4000), (3, 600, 30_000), (3, 100_000, 3000)):
        rows = np.unique(rng.integers(1, size, (m, depth)), axis=0)
        trie = phrases.Trie(phrases.build_trie(rows), size)
        codes = np.concatenate([rows.ravel(), rng.integers(0, size, 5000)]).astype(np.int32)
        at, number = trie.find(codes, np.arange(len(codes)))
        index = {tuple(r): k for k, r in enumerate(rows.tolist())}
        want = {i: index[t] for i in range(len(codes) - depth + 1) if (t := tuple(codes[i:i + depth].tolist())) in index}
        assert dict(zip(at.tolist(), number.tolist())) == want


def test_score_is_exact_beyond_64_bits(spark):
    a, left, right = 9_000_000_001, 9_000_000_007, 9_000_000_011
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = df.select(phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 1_000_000 * a * a // (left * right)
