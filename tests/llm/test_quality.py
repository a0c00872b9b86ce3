import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tagstream.llm import quality as Q
from tests.llm.helpers import SF, awkward_docs, by_id, docs_frame, empty_docs, table

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    out, word = [], ""
    for c in text:
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def brute(text):
    words = split(text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if split(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x0b\x1c\u00a0", max_size=60))
def test_base_counts_equal_brute_force(text):
    assert Q.measure(text) == brute(text)


def test_query_counts_and_verdicts(spark):
    got = by_id(E.queries()["op10_quality"](spark, SF))
    docs = table("documents")
    assert len(got) == len(docs)
    refs = Q.language_references(spark.read.parquet(f"{SF}/documents.parquet"))
    sums = {}
    for d in docs:  # references by brute force
        m = Q.measure(d["text"] or "")
        if not Q.base_fails(m[0], m[4]):
            sums[d["lang"]] = sums.get(d["lang"], 0) + np.concatenate(Q.histograms(d["text"]))
    assert refs == {k: (v[:7].tolist(), v[7:].tolist()) for k, v in sums.items()}
    judge = Q.Judge(refs)
    for d in docs:
        r, m = got[d["doc_id"]], Q.measure(d["text"] or "")
        if len(d["text"]) < 3000:
            assert m == brute(d["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == m
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert r["kept"] == (not r["base_failed"] and judge.keeps(judge.distances(d["text"])))
    labels = {x["doc_id"]: x for x in table("labels")}
    good = [i for i, x in labels.items() if x["quality"] == 1 and not got[i]["base_failed"]]
    bad = [i for i, x in labels.items() if x["quality"] == 0]
    assert all(got[i]["kept"] for i in good)
    assert np.mean([got[i]["kept"] for i in bad]) < 0.35


def test_distance_is_that_of_the_definition():
    p, q = np.array([1, 3, 0]), np.array([[0.5, 0.25, 0.25]])
    a, b = p / 4, q[0]
    m = (a + b) / 2
    kl = lambda x: sum(u * np.log2(u / v) for u, v in zip(x, m) if u > 0)
    assert np.isclose(Q.js_distance(p, q)[0], np.sqrt((kl(a) + kl(b)) / 2))
    assert Q.js_distance(np.zeros(3), q)[0] == 0


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = Q.quality(docs).collect()
    assert len(rows) == 11
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 8))
    kept = Q.keep_good(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if r["kept"])
    assert Q.quality(empty_docs(spark)).count() == 0 and Q.keep_good(empty_docs(spark)).count() == 0
    plain = docs_frame(spark, ["alpha beta gamma " + " ".join(f"w{k}" for k in range(60))])
    assert [r["kept"] for r in Q.quality(plain.withColumn("lang", plain["source"])).collect()] == [True]


def test_bounds_follow_the_length(spark):
    refs = Q.language_references(spark.read.parquet(f"{SF}/documents.parquet"))
    judge = Q.Judge(refs)
    assert set(refs.spread) == {Q.LISTED} and 0.01 < refs.spread[Q.LISTED] < 0.015
    bounds = [judge.distances(" ".join(f"the of and river{k}" for k in range(n)))[2:] for n in (15, 40, 200, 2000)]
    assert all(a[0] > b[0] and a[1] >= b[1] for a, b in zip(bounds, bounds[1:]))
    # no function words: judged under 160 words too
    assert not judge.keeps(judge.distances(" ".join(f"river{'abcdefgh'[k % 8]}" for k in range(120))))
    # where the references are spread wider, the bound is wider
    refs.spread = {Q.LISTED: 0.05}
    assert np.isclose(Q.Judge(refs).floors[Q.LISTED], 0.06)


def test_kept_share_of_bad_documents_at_a_larger_size(spark):
    sf = "/root/testdata/sf0.1"
    got = by_id(Q.quality(spark.read.parquet(f"{sf}/documents.parquet")))
    labels = [x for x in table("labels", sf) if not got[x["doc_id"]]["base_failed"]]
    assert all(got[x["doc_id"]]["kept"] for x in labels if x["quality"] == 1)
    assert np.mean([got[x["doc_id"]]["kept"] for x in labels if x["quality"] == 0]) < 0.34


def test_languages_without_a_word_list_are_kept(spark):
    given = [(d["doc_id"], d["text"], d["lang"]) for d in table("documents")[:200]]
    letters = np.random.default_rng(7).integers(0x430, 0x450, (60, 220, 8))
    cyrillic = [" ".join("".join(map(chr, w[:3 + j % 6])) for j, w in enumerate(text)) for text in letters]
    junk = "| # $ % & < > * " * 40 + " ".join(f"|{k}#" for k in range(300))
    docs = given + [(f"{lang}{k}", t, lang) for k, t in enumerate(cyrillic) for lang in ("ru", None)]
    docs += [(f"junk-{lang}", junk, lang) for lang in ("ru", None, "en", "zz")]
    docs = spark.createDataFrame([(str(i), t, lang) for i, t, lang in docs], "doc_id string, text string, lang string")
    got = by_id(Q.quality(docs))
    assert all(got[f"{lang}{k}"]["kept"] for k in range(60) for lang in ("ru", None))
    assert not any(got[f"junk-{lang}"]["kept"] for lang in ("ru", None, "en"))  # zz has no other document
    assert set(by_id(Q.keep_good(docs))) == {i for i, r in got.items() if r["kept"]}
