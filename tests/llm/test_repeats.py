"""Repeated passages against a count of all windows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tagstream.llm import repeats
from tests.llm.helpers import awkward_docs, docs_frame, empty_docs, table


def brute(texts, window=35):
    """(n_words, n_removed, kept_sha256) per text."""
    docs = [re.findall("[^ \t\n\x0b\x0c\r]+", t or "") for t in texts]
    seen = Counter(tuple(d[a:a + window]) for d in docs for a in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = np.zeros(len(d), bool)
        for a in range(len(d) - window + 1):
            if seen[tuple(d[a:a + window])] > 1:
                gone[a:a + window] = True
        kept = " ".join(w for w, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def removed(df, **how):
    return sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in repeats.remove_repeats(df, with_text=False, **how).collect()))


def expected(rows, window=35):
    return sorted((-1 if i is None else i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], window)))


def test_equal_to_brute_force_on_a_table(spark):
    rows = [(d["doc_id"], d["text"]) for d in table("documents")]
    want = expected(rows)
    assert sum(r[2] > 0 for r in want) > 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(df) == want


def made(seed, n, words, vocabulary):
    """Texts that share passages in different surroundings, with edits."""
    rng = np.random.default_rng(seed)
    pool = [f"w{k}" for k in range(vocabulary)]
    shared = [list(rng.choice(pool, int(rng.integers(20, 90)))) for _ in range(12)]
    texts = []
    for _ in range(n):
        t = list(rng.choice(pool, int(rng.integers(0, words))))
        for _ in range(int(rng.integers(0, 4))):
            p = list(shared[int(rng.integers(0, len(shared)))])
            if rng.random() < 0.4:
                p[int(rng.integers(0, len(p)))] = "edit"
            if rng.random() < 0.3:
                p = p[int(rng.integers(0, 30)):]
            at = int(rng.integers(0, len(t) + 1))
            t[at:at] = p
        texts.append(" \n".join(t))
    return texts


@pytest.mark.parametrize("how", [{}, {"hot": 3}, {"block_words": 150}, {"window": 5}, {"window": 9, "hot": 2, "block_words": 60}])
def test_passages_in_different_surroundings(spark, how):
    texts = made(2, 150, 80, 6 if how.get("window") == 5 else 400)
    df = docs_frame(spark, texts).repartition(5)
    rows = list(enumerate(texts))
    assert removed(df, **how) == expected(rows, how.get("window", 35))


def test_periodic_texts(spark):
    texts = ["a " * 200, "b c " * 60, "a " * 34, "a " * 35, "x " + "a " * 36, "b c " * 17 + "b", "lone " + "z " * 34,
             " ".join(f"n{k}" for k in range(100)), " ".join(f"n{k}" for k in range(40, 140))]
    df = docs_frame(spark, texts)
    assert removed(df) == expected(list(enumerate(texts)))


def test_awkward_rows(spark):
    df = awkward_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert removed(df) == expected(rows)
    assert repeats.remove_repeats(df).columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]


def test_one_text_in_a_third_of_the_rows(spark):
    texts = made(4, 60, 100, 3000)
    texts += [texts[0] + " " + " ".join(f"c{k}" for k in range(60))] * 30
    df = docs_frame(spark, texts).repartition(6)
    assert removed(df, hot=8) == expected(list(enumerate(texts)))


def test_no_rows(spark):
    assert removed(empty_docs(spark)) == []
    assert [r[1:3] for r in removed(docs_frame(spark, ["", None]))] == [(0, 0), (0, 0)]


def test_longest_matches_of_a_block():
    rng = np.random.default_rng(3)
    passages = [[b"%d" % x for x in rng.integers(0, 3, rng.integers(1, 30))] for _ in range(40)]
    block = repeats.Block(passages)
    suffixes = {s + k: p[k:] for p, s in zip(passages, block.starts.tolist()) for k in range(len(p))}
    for at, mine in suffixes.items():
        want = max(next((k for k, (x, y) in enumerate(zip(mine, other)) if x != y), min(len(mine), len(other)))
                   for b, other in suffixes.items() if b != at)
        assert block.match[at] == want


def test_bitmap_has_no_false_negatives(spark):
    rng = np.random.default_rng(1)
    anchors = rng.integers(-2 ** 63, 2 ** 63 - 1, 3000)
    df = spark.createDataFrame([(int(a), 1 + k % 2) for k, a in enumerate(anchors)], "anchor long, n long")
    marked = repeats.Marked(*repeats.mark_anchors(df))
    assert marked.test(anchors[1::2]).all()
    assert marked.test(anchors[::2]).mean() < 0.2
