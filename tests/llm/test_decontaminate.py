import hashlib
import re

import __spark_entry__ as E
from tagstream.llm import decontaminate as D
from tests.llm.helpers import SF, awkward_docs, by_id, docs_frame, empty_docs, table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).update([] if item is None else [str(item)])
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def values(r):
    return (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])


def test_query_equals_brute_force(spark):
    got = by_id(E.queries()["op8_decontaminate"](spark, SF))
    docs = table("documents")
    want = brute([d["text"] for d in docs], [(b["item_id"], b["text"]) for b in table("benchmark")])
    assert {d["doc_id"]: w for d, w in zip(docs, want)} == {k: values(r) for k, r in got.items()}
    assert any(w[4] for w in want)


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_short_repeated_overlapping_and_null_items_in_any_slicing(spark):
    texts = ["A b a b a b", "x, A-B? y", None, "", "é É 7x", "one two three four five six seven eight nine ten "
             "eleven twelve thirteen fourteen fifteen", "b a"]
    items = [(1, "a b"), (1, "a b"), (2, "b a b"), (3, None), (4, "..."), (5, "É 7X"),
             (10, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen")]
    want = brute(texts, items)
    for size in (1, 5, 1000):
        got = by_id(D.decontamination(docs_frame(spark, texts), items_frame(spark, items), slice_chars=size))
        assert [values(got[k]) for k in range(len(texts))] == want
    assert got[1]["hit_spans"] == "3:6"
    kept = [r["doc_id"] for r in D.keep_clean(docs_frame(spark, texts), items_frame(spark, items)).collect()]
    assert sorted(kept) == [k for k, w in enumerate(want) if not w[4]]


def test_awkward_rows_and_empty_tables(spark):
    none = items_frame(spark, [])
    docs = awkward_docs(spark)
    assert D.decontamination(docs, none).where("contaminated or n_hit > 0").count() == 0
    clean = D.keep_clean(docs, items_frame(spark, [(1, "quick brown fox")]))
    assert clean.schema == docs.schema and clean.count() == 7
    assert D.decontamination(empty_docs(spark), none).count() == 0


def test_windows_of_items_without_an_id_are_hits(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    texts = [passage, "x " + passage + " y", "one two", "four five"]
    items = [(None, passage), (None, "four five"), (3, "one two three four five six seven eight nine ten eleven twelve")]
    want = brute(texts, items)
    assert [w[1:3] for w in want] == [(13, 1), (13, 1), (0, 0), (2, 0)]
    for size in (10, 10_000):
        got = by_id(D.decontamination(docs_frame(spark, texts), items_frame(spark, items), slice_chars=size))
        assert [values(got[k]) for k in range(4)] == want
    kept = D.keep_clean(docs_frame(spark, texts), items_frame(spark, items)).collect()
    assert [r["doc_id"] for r in kept] == [2]
