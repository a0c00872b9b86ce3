import hashlib
import random
import time

import public_tokenizers
import tokenizers

import __spark_entry__ as E
from tagstream.llm import bpe
from tests.llm.helpers import SF, awkward_docs, by_id, empty_docs, table

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
LIB = tokenizers.Tokenizer.from_file(PATH)


def library(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_library(spark):
    got = by_id(E.queries()["op9_bpe"](spark, SF))
    docs = table("documents")
    assert len(got) == len(docs)
    for d in docs:
        ids, text = library(d["text"])
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(text))


def test_random_unicode_equals_the_library():
    merges = bpe.load_merges(PATH)
    codec = bpe.Codec(merges, bpe.Lexicon(bpe.compile_lexicon({b"the": merges.merge([b"the"])[0]})))
    rnd = random.Random(3)
    chars = [chr(c) for c in [*range(0, 0x250)] * 3 + [*range(0x250, 0xD800)] + [*range(0x1F300, 0x1F700)]]
    extra = [" ", "'s", "<|endoftext|>", "a", "B", "Σ", "İ", "é", "e\u0301", "'LL", "12", "\n", "\u00a0", "<|", "the "]
    for _ in range(1500):
        text = "".join(rnd.choice(chars) if rnd.random() < 0.5 else rnd.choice(extra)
                       for _ in range(rnd.randint(0, 30)))
        ids, decoded = codec.encode_all([text])[0]
        want, said = library(text)
        assert ids.decode() == " ".join(map(str, want)), text
        assert decoded.decode() == said == bpe.decode(want, merges)


def test_lexicon_finds_exactly_its_words():
    rnd = random.Random(9)
    words = {bytes(rnd.choices(b"abc", k=rnd.randint(1, 7))) for _ in range(600)}
    inside = set(list(words)[:300])
    data = bpe.compile_lexicon({w: [k, k + 1] for k, w in enumerate(sorted(inside))})
    lexicon = bpe.Lexicon(data)
    probe = sorted(words)
    found = lexicon.find(probe).tolist()
    assert [k >= 0 for k in found] == [w in inside for w in probe]
    order = {w: k for k, w in enumerate(sorted(inside))}
    assert all(lexicon.of(k) == [order[w], order[w] + 1] for w, k in zip(probe, found) if k >= 0)
    assert len(lexicon.ends) < sum(map(len, inside))  # suffixes are shared
    assert bpe.Lexicon(bpe.compile_lexicon({})).find([b"a"]).tolist() == [-1]


def test_cache_limit_and_lexicon_size_change_nothing(spark, monkeypatch):
    docs = awkward_docs(spark)
    want = sorted(bpe.encode(docs, PATH).collect(), key=str)
    assert sorted(bpe.encode(docs, PATH, n_words=3).collect(), key=str) == want
    merges = bpe.load_merges(PATH)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    codec = bpe.Codec(merges, bpe.Lexicon(bpe.compile_lexicon({})))
    texts = ["one two three four", "three two one", "", "four <|startoftext|> five"]
    assert [r[0].decode() for r in codec.encode_all(texts)] == [" ".join(map(str, library(t)[0])) for t in texts]


def test_awkward_rows(spark):
    rows = bpe.encode(awkward_docs(spark), PATH).collect()
    assert len(rows) == 11
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    (eight,) = [r for r in rows if r["doc_id"] == 8]
    assert eight["ids"] == library("mail a@b.co or 10.0.0.1 \u00e9\u00df\U0001f600 +1 (555) 123-4567")[0]
    assert bpe.encode(empty_docs(spark), PATH).count() == 0


def test_long_words_equal_the_library_in_little_time():
    rnd = random.Random(4)
    merges = bpe.load_merges(PATH)
    for n in (bpe.BATCH_SYMBOLS, bpe.BATCH_SYMBOLS + 1, 300, 20_000):
        for letters in ("a", "ab", "etaoinshrdlu", "\u00e9\u4e2d"):
            word = "".join(rnd.choices(letters, k=n))
            assert merges.merge([word.encode()]) == [library(word)[0]]
    word = "".join(rnd.choices("etaoinshrdlucmf", k=1_000_000))
    begin = time.process_time()
    got = merges.merge([word.encode()])[0]
    assert time.process_time() - begin < 20  # a quadratic merge takes half an hour
    assert got == library(word)[0]


def test_frequent_words_are_cut_by_their_count(spark):
    rows = [(b"w%d" % k, n) for k, n in enumerate([1, 1, 2, 2, 2, 5, 9, 4095, 4096, 5000, 9000, 20_000])]
    counts = spark.createDataFrame(rows, "word binary, n long")
    for most, want in ((100, 12), (11, 10), (9, 7), (7, 7), (5, 5), (4, 4), (3, 2), (2, 2), (1, 1), (0, 0)):
        assert bpe.frequent_words(counts, most).count() == want
    assert bpe.frequent_words(counts.limit(0), 5).count() == 0
