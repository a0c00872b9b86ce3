"""Token ids in flat binary files.

Documents are range-partitioned and sorted by id; each partition writes one
file of unsigned ids (16 bit where the vocabulary allows, else 32) and one of
64-bit offsets, plus the 64-bit document ids.  Where a partition's ids begin in
the whole sequence comes from prefix sums over the partitions' totals.  Readers
memory-map the files.

Layout of a data set under its folder::

    <part>.ids   ids of the part's documents, little endian u2 or u4
    <part>.off   n + 1 offsets into the part's ids, i8
    <part>.doc   n document ids, i8 (the smallest i8 stands for null)
    manifest/    parquet: part, file, n_docs, n_tokens, bytes an id takes

Only files that the manifest names belong to the data set: a lost or
speculative attempt leaves unnamed files behind, never wrong rows.

Encoding uses the ``tokenizers`` library.  A text's tokens never cross ASCII
white space, so distinct words are encoded, many in one call, and their ids
joined; tests compare with whole-text encoding.

Defined cases: a null text is empty and has only the end id; a null document
id sorts first; repeated ids keep one entry per row, ordered by text; an empty
table gives an empty data set; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagstream.llm.common import (attempt_name, filesystem, input_tasks, make_folder, map_file, whole_text)
from tagstream.session import scratch_path

END_ID = 2
#: Words whose ids a task keeps at a time.
CACHE_WORDS = 600_000
NULL_ID = np.iinfo(np.int64).min
SLICE_ROWS = 128


#: The split pattern that ``LibraryEncoder`` can apply itself (a fixed value of
#: the tokenizer file), and its form for lower-cased ASCII without white space.
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class LibraryEncoder:
    """Ids of texts by the ``tokenizers`` library, results of words kept.

    Where the file splits by ``_PATTERN`` and marks word ends, words are cut
    into pieces that the library would cut them into, A-Z lower-cased as it
    does, so forms of a word are encoded once.  Pieces are encoded many in one
    text: a piece's last token, and no other, ends in the vocabulary's word-end
    suffix.  Other words, and other files' words, are encoded with a special
    token between them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items() if t.special}
        self.mark, self.mark_id = next(iter(special.items()))
        self.markers = [s.encode() for s in special]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.cuts = bool(suffix) and splits[0].get("pattern") == {"Regex": _PATTERN}
        self.ends = np.zeros(size, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the words known before the last change of generation

    def _cut(self, word: bytes) -> list[bytes] | None:
        """The pieces of a word, or None if they can't be told here."""
        if word.isalpha():
            return [word.lower()]
        if word.isascii():
            if b"<" in word and any(m in word for m in self.markers):
                return None
            return _ASCII_PIECES.findall(word.lower())
        # beyond ASCII, letters only, with or without one closing mark
        head, tail = (word[:-1], [word[-1:]]) if word[-1] in b".,;:!?" else (word, [])
        return [head.lower(), *tail] if head.decode("utf-8", "replace").isalpha() else None

    def _ids(self, words: list[bytes], between: str) -> np.ndarray:
        text = between.join([w.decode("utf-8", "surrogatepass") for w in words])
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _split(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data, size = ids.tobytes(), self.dtype.itemsize
        return [data[a:b] for a, b in zip((starts * size).tolist(), (ends * size).tolist())]

    def _marked(self, words: list[bytes]) -> list[bytes]:
        ids = self._ids(words, f" {self.mark} ")
        cuts = np.flatnonzero(ids == self.mark_id)
        return self._split(ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))

    def _spaced(self, pieces: list[bytes]) -> list[bytes]:
        ids = self._ids(pieces, " ")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces):  # some piece is not one word to the library
            return self._marked(pieces)
        return self._split(ids, np.append(0, ends[:-1]), ends)

    def learn(self, words: list[bytes]) -> None:
        known = self.known
        cut = {w: self._cut(w) for w in words} if self.cuts else dict.fromkeys(words)
        new = list({p for c in cut.values() if c for p in c}.difference(known))  # a piece is a word, too
        for at in range(0, len(new), 4096):
            some = new[at:at + 4096]
            known.update(zip(some, self._spaced(some)))
        rest = []
        for w, c in cut.items():
            if c is None:
                if b"<" in w and any(m in w for m in self.markers):
                    ids = self.tok.encode(w.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
                    known[w] = np.array(ids, self.dtype).tobytes()
                else:
                    rest.append(w)
            elif len(c) > 1 or c[0] != w:
                known[w] = b"".join([known[p] for p in c])
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            known.update(zip(some, self._marked(some)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        known, older = self.known, self.older
        new = [w for w in {w for ws in words for w in ws} if w not in known]
        if new:
            if known and len(known) + len(new) > CACHE_WORDS:
                self.known, self.older = {}, known
                return self.encode_all(texts)
            known.update((w, older[w]) for w in new if w in older)
            self.learn([w for w in new if w not in known])
        get = known.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


@lru_cache(maxsize=1)
def load_encoder(path: str) -> LibraryEncoder:
    """One per Python worker; later tasks in it reuse what is known."""
    return LibraryEncoder(path)


_MANIFEST = "part int, file string, n_docs long, n_tokens long, width int"


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id") -> str:
    """Encode every text, append ``end_id``, write the files; the folder."""
    folder = make_folder(scratch_path(docs.sparkSession, "tokens"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc = None
        lengths: list[int] = []
        ids_of: list[int] = []
        name = attempt_name("part", "")
        store, path = filesystem(folder)
        out = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                if out is None:
                    enc, out = load_encoder(tokenizer_path), store.open_output_stream(f"{path}/{name}.ids")
                    end = np.array([end_id], enc.dtype).tobytes()
                some = batch.slice(at, SLICE_ROWS)
                coded = enc.encode_all(some.column(1).to_pylist())
                for data in coded:
                    out.write(data)
                    out.write(end)
                lengths += [len(d) // enc.dtype.itemsize + 1 for d in coded]
                ids_of += [NULL_ID if i is None else i for i in some.column(0).to_pylist()]
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<i8")
        for suffix, data in ((".off", offsets), (".doc", np.array(ids_of, "<i8"))):
            with store.open_output_stream(f"{path}/{name}{suffix}") as f:
                f.write(data.tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name],
            "n_docs": [len(lengths)], "n_tokens": [int(offsets[-1])],
            "width": pa.array([enc.dtype.itemsize], pa.int32())})

    rows.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with each part's ``base``: the ids of all parts before
    it.  One row per part, so one task sums them."""
    m = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32
    of its ids as little-endian unsigned 32-bit integers."""
    todo = parts(spark, folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                dtype = np.dtype(f"<u{r['width']}")
                ids = np.frombuffer(map_file(f"{folder}/{r['file']}.ids"), dtype)
                off = np.frombuffer(map_file(f"{folder}/{r['file']}.off"), "<i8")
                doc = np.frombuffer(map_file(f"{folder}/{r['file']}.doc"), "<i8")
                for at in range(0, len(doc), 4096):
                    bounds = off[at:at + 4097]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes())
                           for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    some = doc[at:at + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, mask=some == NULL_ID), pa.array(bounds[:-1] + r["base"]),
                         pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return input_tasks(todo, todo.count()).mapInArrow(run, schema)
