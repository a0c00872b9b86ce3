import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import zstandard

import __spark_entry__ as E
from tagstream.llm import sharding, token_files, warc
from tests.llm.helpers import SF, awkward_docs, by_id, docs_frame, empty_docs, table

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


# ------------------------------------------------------------ token files ----

def library(texts):
    lib = tokenizers.Tokenizer.from_file(PATH)
    return [[*lib.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def expected(docs):
    out, start = {}, 0
    for (i, _), ids in zip(docs, library([t for _, t in docs])):
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_token_query_equals_whole_text_encoding(spark):
    docs = sorted((d["doc_id"], d["text"]) for d in table("documents"))
    got = by_id(E.queries()["op6_token_files"](spark, SF))
    assert {k: (r["start"], r["n_tokens"], r["ids_crc32"]) for k, r in got.items()} == expected(docs)


def test_token_files_of_awkward_rows(spark):
    texts = ["a <|endoftext|> b", None, "", "x<|startoftext|>y\u00a0z", "É\u0301 <|x", " \n", "12 it's"]
    folder = token_files.write_tokens(docs_frame(spark, texts), PATH)
    got = by_id(token_files.read_tokens(spark, folder))
    assert {k: (r["start"], r["n_tokens"], r["ids_crc32"]) for k, r in got.items()} == expected(list(enumerate(texts)))
    rows = token_files.read_tokens(spark, token_files.write_tokens(awkward_docs(spark), PATH)).collect()
    assert len(rows) == 11 and sum(r["doc_id"] is None for r in rows) == 2
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))
    assert token_files.read_tokens(spark, token_files.write_tokens(empty_docs(spark), PATH)).count() == 0


# ---------------------------------------------------------------- sharding ----

def law(rows, n):
    """rows (doc_id, size) in order -> shard and slot by the law."""
    total, at, used, out = sum(s for _, s in rows), 0, {}, {}
    for i, s in rows:
        shard = min(n - 1, (2 * at + s) * n // (2 * total))
        used[shard] = used.get(shard, -1) + 1
        out[i], at = (shard, used[shard]), at + s
    return out


def test_shard_query_equals_the_law(spark):
    docs = sorted((d["doc_id"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode()))
                  for d in table("documents"))
    got = by_id(E.queries()["op7_sharding"](spark, SF))
    want = law([d[:2] for d in docs], 24)
    assert {i: (r["size"], r["text_crc32"]) for i, r in got.items()} == {i: (s, c) for i, s, c in docs}
    assert {i: (r["shard"], r["slot"]) for i, r in got.items()} == want
    sizes = np.zeros(24)
    for i, s, _ in docs:
        sizes[got[i]["shard"]] += s
    assert sizes.max() - sizes.min() <= 2 * max(s for _, s, _ in docs)
    assert {r["law"] for r in got.values()} == {"bytes"} and {r["grown_shard"] for r in got.values()} == {None}


def test_one_key_with_most_rows_is_split(spark):
    df = spark.range(4000).selectExpr("case when id % 3 > 0 then 7 when id = 0 then null else id end doc_id",
                                      "repeat('x', cast(id % 50 as int)) text")
    rows = sharding.shards(df, 8, n_ranges=16, sample_keys=400).collect()
    assert len(rows) == 4000
    sizes, slots = np.zeros(8), {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sizes.max() - sizes.min() <= 2 * 58
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(-1 if r["doc_id"] is None else r["doc_id"])
    ends = [(min(by_shard[k]), max(by_shard[k])) for k in sorted(by_shard)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_shards_of_awkward_rows(spark):
    rows = sharding.shards(awkward_docs(spark), 3).collect()
    assert len(rows) == 11 and {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {8}
    assert sharding.shards(empty_docs(spark)).count() == 0


# -------------------------------------------------------------------- WARC ----

def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def roles(rows):
    last = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(i, last.get(h, i))
    return [(i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
             *(("revisit", last[h]) if i is not None and last.get(h, i) != i else ("response", None)))
            for i, _, h in rows]


def said(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=str)


def test_warc_query_equals_brute_force(spark):
    rows = [(p["page_id"], p["url"], p["html"]) for p in table("pages")]
    assert said(E.queries()["op3_warc"](spark, SF)) == sorted(roles(rows), key=str)


def test_revisits_ties_nulls_and_empty_pages(spark):
    big, edge, small = "é" * 900, "z" * 1000, "z" * 999
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (2, "http://a/2", big), (9, None, big), (3, "u", edge),
            (4, "u", edge), (5, "u", small), (6, "u", small), (7, "u", None), (8, None, ""), (None, "u", edge)]
    folder = warc.write_archive(pages_frame(spark, rows))
    assert said(warc.read_records(spark, folder)) == sorted(roles(rows), key=str)
    assert warc.read_records(spark, warc.write_archive(pages_frame(spark, []))).count() == 0


def test_archive_layout_round_trip_and_damage():
    records = [warc.make_record(k, f"http://h/{k}", f"<p>page {k} of many pages</p>".encode() * 40, None)
               for k in range(80)]
    dictionary = zstandard.train_dictionary(4096, records).as_bytes()
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    data = warc.skippable(dictionary) + b"".join(writer.compress(r) for r in records)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    back = list(warc.read_archive(data))
    assert [f["WARC-Record-ID"] for f, _ in back] == [f"<urn:page:{k}>" for k in range(80)]
    assert all(b.endswith(f"<p>page {k} of many pages</p>".encode()) for k, (_, b) in enumerate(back))
    plain = warc.skippable(b"") + zstandard.compress(records[0])
    assert len(list(warc.read_archive(plain))) == 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.read_archive(data[8:]))
