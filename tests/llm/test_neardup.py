import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from tagstream.llm import neardup as N
from tagstream.llm.components import components
from tests.llm.helpers import SF, awkward_docs, by_id, docs_frame, empty_docs, table


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(docs, k):
    """doc_id -> (set size, smallest id reachable), by an inverted index."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(df, docs, k):
    got = by_id(df)
    want = brute(docs, k)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i][1]) for i, r in got.items())
    return want


def test_query_equals_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    want = check(E.queries()["op5_neardup"](spark, SF), docs, 2)
    assert len({c for _, c in want.values()}) < len(docs)


def variants(rnd, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_chains_boundaries_and_groups_equal_brute_force(spark):
    rnd = random.Random(11)
    texts = []
    for size, edits in ((40, 2), (80, 4), (120, 8), (200, 12), (60, 3)):
        base = [f"b{rnd.randrange(10**5)}" for _ in range(size)]
        texts += variants(rnd, base, 25, edits)
    words = [f"c{k}" for k in range(120)]  # a chain: each is near its neighbours only
    for k in range(12):
        words[8 * k:8 * k + 5] = [f"n{k}_{j}" for j in range(5)]
        texts.append(" ".join(words))
    texts += ["a b", "A B", "a  b", "b a", "solo", "SOLO", None, "", "  "]
    rnd.shuffle(texts)
    for k in (2, 5):
        check(N.groups(docs_frame(spark, texts), words=k), list(enumerate(texts)), k)


def test_exactly_the_limit_links():
    a, b = [f"x{k}" for k in range(9)], [f"x{k}" for k in range(8)]
    # 8 shingles against 7, 7 shared: 7/8
    assert len(shingles(" ".join(a), 2) & shingles(" ".join(b), 2)) * 100 >= 80 * 8
    assert N.max_difference(0.64) > N.max_difference(0.8) > 0


def test_sketch_estimates_high_similarity():
    rnd = random.Random(2)
    words = [f"v{k}" for k in range(400)]
    s = N.Shingler(2)
    sig_a = N.signature(s.hashes(" ".join(words)))
    for _ in range(20):
        other = list(words)
        for k in rnd.sample(range(400), 18):
            other[k] = f"z{rnd.random()}"
        sig_b = N.signature(s.hashes(" ".join(other)))
        differ = sum(bin((int(x) ^ int(y)) & (2**64 - 1)).count("1") for x, y in zip(N.odd_sketch(sig_a), N.odd_sketch(sig_b)))
        truth = len(shingles(" ".join(words), 2) & shingles(" ".join(other), 2)) / len(
            shingles(" ".join(words), 2) | shingles(" ".join(other), 2))
        assert truth < 0.8 or differ <= N.max_difference(N.SKETCH_FLOOR)


def test_fine_sketch_tells_linked_from_half_similar(spark):
    rng = np.random.default_rng(4)
    pairs = []
    for size in (5, 150, 900, 6000):
        for percent in (60, 80, 100):
            for _ in range(30):
                h = rng.integers(0, 2**64, size, dtype=np.uint64)
                both = -(-size * percent // 100)
                half = both + (size - both) // 2
                a, b = N.fine_sketch(h[:half]), N.fine_sketch(np.concatenate([h[:both], h[half:]]))
                pairs.append((size, percent, *([int(v) for v in part] for part in (*a, *b))))
    df = spark.createDataFrame(pairs, "size int, percent int, pa array<long>, fa array<long>, pb array<long>, fb array<long>")
    got = df.withColumn("close", N.finely_close("pa", "pb", "fa", "fb")).groupBy("size", "percent").agg(
        F.sum(F.col("close").cast("int")).alias("n")).collect()
    for r in got:
        if r["percent"] >= 80:
            assert r["n"] == 30, r
        elif r["size"] > 5:
            assert r["n"] == 0, r


def test_large_half_similar_group_keeps_its_links(spark):
    """A base with copies edited to very different degrees: most pairs are
    half similar, and every link counts."""
    rnd = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    texts = [t for edits in (1, 2, 3, 4, 5, 6, 7, 8, 9) for t in variants(rnd, base, 40, edits)]
    rnd.shuffle(texts)
    check(N.groups(docs_frame(spark, texts), words=5), list(enumerate(texts)), 5)


def test_components_of_paths_cycles_and_hubs(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200),
                                                                                    (300, 300), (None, 5)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = N.groups(docs, words=2).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "2", "3", "4", "5", "6", "7", "8", "None", "None"])
    ids = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert ids[6]["component_id"] == 5 and not ids[6]["kept"] and ids[5]["kept"]
    assert ids[1]["n_shingles"] == ids[2]["n_shingles"] == ids[3]["n_shingles"] == 0 and ids[1]["kept"]
    kept = N.keep_one(docs, words=2)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "None", "None"])
    assert N.groups(empty_docs(spark)).count() == 0 and N.keep_one(empty_docs(spark)).count() == 0


def test_rows_that_share_an_id_with_other_texts(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (2, "a b c d"), (3, "e f g h")], "doc_id long, text string")
    got = by_id(N.groups(df, words=2))
    assert len(got) == 3 and sorted(r["component_id"] for r in got.values()) in ([1, 1, 3], [1, 1, 2], [1, 2, 1])
