"""Phrase collocation mining with double-array tries over numpy positions.

Everything is per language.  The levels follow the Apriori principle, a phrase
is no more frequent than any part of it:

1. all words are counted; those seen ``min_count`` times or more get dense
   codes (one per language and word), and every text is written once as a
   sequence of codes, 0 for rarer words and for borders of pieces and texts;
2. per length, *candidates* are listed: adjacent pairs of coded words, then
   triples both of whose pairs are frequent, whose tallies over the shards
   reach ``min_count``.  A shard's tally stops at ``min_count``, so tallies
   are small numbers that tell candidates from others without loss, but not
   how frequent they are;
3. the candidates are compiled into double-array tries (``base``, ``check``,
   the accepted phrase), files of the shared folder with at most
   ``block_phrases`` phrases each.  Tasks map one block at a time, advance the
   trie states of all text positions at once, level by level, drop the
   positions that fell off, and bincount the accepting states; the shards'
   counts are summed.

Memory: a task holds one block of one trie, one chunk of ``CHUNK`` positions,
and 4 bytes per coded word.  A block's size is fixed, so a larger corpus has
more blocks, not larger ones; every task reads all of them, which pays up to
``max_blocks``.  Beyond it the same counts come from the tallies without their
stop (a plain aggregate, exact as well).  Nothing that grows comes to the
driver: the counts of blocks and the names of their files do.

Scores are whole numbers of exact decimals (``a`` below 10^15).

Defined cases: a null text is empty; a null language is ``und`` and joins rows
of that name; repeated rows count each; texts without words and empty tables
give no rows; ties are ordered by the phrase's bytes; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagstream.llm.common import attempt_name, filesystem, make_folder, map_file, per_block, whole_text
from tagstream.session import materialize, scratch_path

#: Positions that a task handles at a time.
CHUNK = 1 << 19
#: Distinct words or phrases that a counting task gathers before it hands them on.
GATHER = 3 << 17
BLOCK_PHRASES = 400_000
MAX_BLOCKS = 512
#: Words of one vocabulary file.
BLOCK_WORDS = 400_000
#: Multipliers that deal first pairs of codes to blocks (in SQL and numpy alike).
_DEAL = (40_503, 30_011)

#: Bits of a phrase's number inside a slice of counts.
_SLICE = 12
#: Bits of a trie's digit, and children of the nodes that are placed at once.
_DIGIT, _FEW = 8, 12

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_BREAK = bytes(0x2E if b in _PIECE_ENDS else b for b in range(256))
_BREAK = b"."  # ends pieces, so it is no part of any word


def tokens(text: str) -> list[bytes]:
    """Words of a text in order, A-Z lower-cased, with ``.`` for every end
    of a piece."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_TO_BREAK)
    return data.replace(_BREAK, b" . ").split()


# --------------------------------------------------------------- words ----

def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) over all texts; tasks count before the shuffle."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush():
            for lang, c in counts.items():
                c.pop(_BREAK, None)
                words, ns = list(c), list(c.values())
                for at in range(0, len(words), 20_000):
                    some = words[at:at + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()),
                         pa.array(ns[at:at + 20_000], pa.int64())], schema=schema)
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(lang, Counter()).update(tokens(text.as_py()))
                if sum(map(len, counts.values())) > GATHER // 2:
                    yield from flush()
        yield from flush()

    parts = _rows(docs).mapInArrow(run, "lang string, word binary, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("f"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))


def vocabulary(counts: DataFrame, min_count: int, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, list[str]]:
    """Frequent words with dense codes from 1 (lang, word, f, code), and the
    URIs of the Arrow files that hold them for look-up."""
    spark = counts.sparkSession
    words = counts.where(F.col("f") >= min_count)
    n_blocks = max(1, -(-words.count() // block_words))
    blocks = words.withColumn("block", F.pmod(F.crc32("word"), F.lit(n_blocks)).cast("int"))
    coded = materialize(_numbered(blocks, ["lang", "word"], "code", 1), "phrase-words")
    folder = make_folder(scratch_path(spark, "phrase-vocabulary"))
    schema = pa.schema([("key", pa.large_binary()), ("code", pa.int32())])

    def write(table: pa.Table):
        key = pc.binary_join_element_wise(
            table["lang"].cast(pa.large_binary()), table["word"].cast(pa.large_binary()), pa.scalar(b"\t", pa.large_binary()))
        name = attempt_name("words", ".arrow")
        store, path = filesystem(folder)
        with store.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_file(f, schema) as out:
            out.write_table(pa.Table.from_arrays([key.combine_chunks(), table["code"].cast(pa.int32())], schema=schema))
        return name

    files = per_block(coded.select("block", "code", "lang", "word"), n_blocks, ["code"], write)
    return coded.select("lang", "word", "f", "code"), [f"{folder}/{name}" for _, name in files]


def _numbered(rows: DataFrame, order: list[str], name: str, first: int) -> DataFrame:
    """Rows with a dense number: blocks (column ``block``, of bounded size)
    number their own rows, after the sizes of the blocks before."""
    spark = rows.sparkSession
    sizes = sorted((r["block"], r["count"]) for r in rows.groupBy("block").count().collect())
    starts, at = [], first
    for block, size in sizes:
        starts.append((block, at))
        at += size
    if at >= 1 << 31:
        raise ValueError("more than 2^31 frequent words or phrases")
    inside = F.row_number().over(Window.partitionBy("block").orderBy(*order))
    begin = F.broadcast(spark.createDataFrame(starts, "block int, _start long"))  # one row per block
    return rows.withColumn("_in", inside).join(begin, "block").withColumn(
        name, (F.col("_start") + F.col("_in") - 1).cast("int")).drop("_in", "_start")


class Vocabulary:
    """Codes of words per language, from mapped files.  A vocabulary of one
    file is held as a dictionary; of a larger one only the words of the texts
    at hand are looked up, one file in memory at a time."""

    def __init__(self, files: list[str]):
        self.files, self.all = files, None
        if len(files) == 1:
            table = self._table(files[0])
            self.all = {}
            for key, code in zip(table["key"], table["code"].to_pylist()):
                lang, word = key.as_py().rsplit(b"\t", 1)
                self.all.setdefault(lang.decode(), {})[word] = code

    @staticmethod
    def _table(uri: str) -> pa.Table:
        return pa.ipc.open_file(pa.BufferReader(map_file(uri))).read_all()

    def codes(self, lang: str, texts: list[list[bytes]]) -> dict[bytes, int]:
        """A dictionary that has all coded words of the texts."""
        if self.all is not None:
            return self.all.get(lang, {})
        words = list({w for t in texts for w in t})
        keys = pa.array([lang.encode() + b"\t" + w for w in words], pa.large_binary())
        known = {}
        for uri in self.files:
            table = self._table(uri)
            at = pc.index_in(keys, value_set=table["key"].combine_chunks())
            hit = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            codes = table["code"].to_numpy()[at.drop_null().to_numpy()]
            known.update(zip((words[k] for k in hit.tolist()), codes.tolist()))
        return known


def code_texts(docs: DataFrame, files: list[str]) -> DataFrame:
    """The corpus as rows of code sequences (``codes``: little-endian int32,
    0 between pieces and texts and for rare words), in a table of the shared
    folder."""
    def run(batches):
        vocabulary = None
        held: dict[str, list[list[bytes]]] = {}
        size = 0

        def flush():
            for lang, texts in held.items():
                code = vocabulary.codes(lang, texts).get
                n = sum(map(len, texts)) + len(texts)
                # a text's end is a border, as the borders of pieces
                arr = np.fromiter((code(w, 0) for t in texts for w in (*t, _BREAK)), "<i4", n)
                # runs of zeros say no more than one does
                arr = arr[np.concatenate([[True], (arr[1:] > 0) | (arr[:-1] > 0)])] if len(arr) else arr
                yield pa.RecordBatch.from_arrays([pa.array([arr.tobytes()], pa.binary())], names=["codes"])
            held.clear()

        for batch in batches:
            vocabulary = vocabulary or Vocabulary(files)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens(text.as_py())
                held.setdefault(lang, []).append(words)
                size += len(words)
                if size > CHUNK // 2:
                    yield from flush()
                    size = 0
        yield from flush()

    return materialize(_rows(docs).mapInArrow(run, "codes binary"), "phrase-codes")


# ---------------------------------------------------------------- tries ----

def build_trie(phrases: np.ndarray) -> bytes:
    """A double-array trie of distinct phrases (rows of codes, sorted) as one
    flat file: the symbols that occur, ``base``, ``check`` and the row number
    that a state accepts.

    The symbols that occur are numbered, and a number is spelt in digits of
    ``_DIGIT`` bits, so that no node has many children and frequent words'
    nodes don't crowd each other out.  State 0 is the root.  A node takes a
    base at which all its children's slots are free.  Nodes of more than
    ``_FEW`` children come first, largest first: a few random bases are tried
    before the array grows.  The others propose random bases in rounds, those
    of one size all at once, where the first claim to a slot holds."""
    m, depth = phrases.shape
    symbols = np.unique(phrases)
    digits = max(1, -(-(len(symbols) - 1).bit_length() // _DIGIT))
    local = np.searchsorted(symbols, phrases).astype(np.int64)
    shifts = _DIGIT * np.arange(digits - 1, -1, -1)
    spelt = (local[:, :, None] >> shifts & ((1 << _DIGIT) - 1)).reshape(m, depth * digits)
    firsts, new = [np.zeros(1, np.int64)], np.zeros(m, bool)  # per level, the first row of each prefix
    for level in range(depth * digits):
        new[1:] |= spelt[1:, level] != spelt[:-1, level]
        new[:1] = True
        firsts.append(np.flatnonzero(new))
    n_nodes = sum(map(len, firsts))
    room = 4 * n_nodes + (1 << _DIGIT)
    array = _Slots(room)
    rng = np.random.default_rng(m)
    slots = np.zeros(1, np.int64)
    for level in range(depth * digits):
        rows = firsts[level + 1]
        parent = np.searchsorted(firsts[level], rows, side="right") - 1
        symbol = spelt[rows, level]
        starts = np.searchsorted(parent, np.arange(len(slots)))
        counts = np.diff(np.append(starts, len(rows)))
        chosen = np.zeros(len(counts), np.int64)
        for node in np.argsort(-counts, kind="stable")[:int((counts > _FEW).sum())].tolist():
            kids = symbol[starts[node]:starts[node] + counts[node]]
            chosen[node] = array.place(rng, kids, slots[node])
        for size in range(_FEW, 0, -1):
            left = np.flatnonzero(counts == size)
            while len(left):
                kids = symbol[starts[left][:, None] + np.arange(size)]
                ok, bases = array.propose(rng, kids, slots[left])
                chosen[left[ok]] = bases[ok]
                left = left[~ok]
        array.base[slots] = chosen
        slots = chosen[parent] + symbol
    end = array.end()
    accept = np.full(end, -1, np.int32)
    accept[slots] = np.arange(m)
    arrays = [symbols, array.base[:end], array.check[:end], accept]
    head = np.array([depth, digits, *map(len, arrays)], "<i4")
    return b"".join([head.tobytes(), *(a.astype("<i4").tobytes() for a in arrays)])


class _Slots:
    """The growing arrays of a trie under construction."""

    def __init__(self, room: int):
        self.room = room  # where random bases lie, at least
        self.top = 1  # slots from here on are free
        self.base = np.zeros(room + (2 << _DIGIT), np.int32)
        self.check = np.full(len(self.base), -1, np.int32)
        self.check[0] = -2  # the root is nobody's child
        self.owner = np.zeros(len(self.base), np.int64)

    def _reach(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, len(self.base) * 3 // 2) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
            self.owner = np.concatenate([self.owner, np.zeros(more, np.int64)])

    def place(self, rng, kids: np.ndarray, parent: int) -> int:
        """A base for one node of many children; grows if need be."""
        tries = rng.integers(0, self.top, 24)
        good = np.flatnonzero((self.check[tries[:, None] + kids] == -1).all(axis=1))
        at = int(tries[good[0]]) if len(good) else self.top
        self._reach(at + (2 << _DIGIT))
        self.check[at + kids] = parent
        self.top = max(self.top, at + int(kids[-1]) + 1)
        return at

    def propose(self, rng, kids: np.ndarray, parents: np.ndarray):
        """Random bases for nodes (rows of ``kids``): which of them hold."""
        top = max(self.room, self.top)
        self._reach(top + (2 << _DIGIT))
        bases = rng.integers(1, top, len(kids))
        slot = bases[:, None] + kids
        mine = np.broadcast_to(np.arange(len(kids))[:, None], slot.shape)
        self.owner[slot[::-1]] = mine[::-1]
        ok = ((self.check[slot] == -1) & (self.owner[slot] == mine)).all(axis=1)
        self.check[slot[ok]] = parents[ok][:, None]
        if ok.any():
            self.top = max(self.top, int(slot[ok].max()) + 1)
        return ok, bases

    def end(self) -> int:
        """Slots in use, and as many as any base may point past them."""
        used = int(np.flatnonzero(self.check != -1)[-1]) + 1
        end = max(used, int(self.base.max())) + (1 << _DIGIT)
        self._reach(end)
        return end


class Trie:
    """A mapped trie.  ``n_codes``: the largest code of the vocabulary."""

    def __init__(self, buffer, n_codes: int):
        flat = np.frombuffer(buffer, "<i4")
        self.depth, self.digits = flat[:2].tolist()
        ends = 6 + np.cumsum([0, *flat[2:6]])
        symbols, self.base, self.check, self.accept = (flat[a:b] for a, b in zip(ends, ends[1:]))
        self.local = np.full(n_codes + 1, -1, np.int32)
        self.local[symbols] = np.arange(len(symbols))

    def find(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions of ``at`` where a phrase begins, and its number.
        All states advance together, one level after the other."""
        state = np.zeros(len(at), np.int32)
        for level in range(self.depth):
            inside = at + level < len(codes)
            at, state = at[inside], state[inside]
            symbol = self.local[codes[at + level]]
            alive = symbol >= 0
            for k in range(self.digits - 1, -1, -1):
                at, state, symbol = at[alive], state[alive], symbol[alive]
                target = self.base[state] + (symbol >> _DIGIT * k & ((1 << _DIGIT) - 1))
                alive = self.check[target] == state
                state = target
            at, state = at[alive], state[alive]
        return at, self.accept[state]


def compile_tries(cands: DataFrame, depth: int,
                  block_phrases: int) -> tuple[DataFrame, list[tuple[int, int, str]], int]:
    """Number the candidate phrases (columns c1, c2 and so on) and write
    their tries: the table with ``id``, (block, first id, URI) of each trie,
    and the number of blocks that pairs are dealt to."""
    spark = cands.sparkSession
    cols = [f"c{k + 1}" for k in range(depth)]
    n_blocks = max(1, -(-cands.count() // block_phrases))
    deal = (F.col("c1").cast("long") * _DEAL[0] + F.col("c2").cast("long") * _DEAL[1]) % n_blocks
    cands = materialize(_numbered(cands.withColumn("block", deal.cast("int")), cols, "id", 0), f"phrases-{depth}")
    folder = make_folder(scratch_path(spark, f"phrase-tries-{depth}"))

    def write(table: pa.Table):
        name = attempt_name("block", ".trie")
        store, path = filesystem(folder)
        data = build_trie(np.stack([table[c].to_numpy() for c in cols], axis=1))
        with store.open_output_stream(f"{path}/{name}") as f:
            f.write(data)
        return name

    files = dict(per_block(cands.select("block", *cols), n_blocks, cols, write))
    first = {r["block"]: r["first"] for r in cands.groupBy("block").agg(F.min("id").alias("first")).collect()}
    return cands, [(b, first[b], f"{folder}/{files[b]}") for b in sorted(files)], n_blocks


def find_all(codes: np.ndarray, tries, n_blocks: int, n_codes: int) -> np.ndarray:
    """Id of the phrase at each position, or -1; one block at a time."""
    ids = np.full(len(codes), -1, np.int64)
    at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0)) if len(codes) > 1 else np.zeros(0, np.int64)
    if n_blocks > 1:
        dealt = (codes[at].astype(np.int64) * _DEAL[0] + codes[at + 1].astype(np.int64) * _DEAL[1]) % n_blocks
    for block, first, uri in tries:
        hit, number = load_trie(uri, n_codes).find(codes, at if n_blocks == 1 else at[dealt == block])
        ids[hit] = number.astype(np.int64) + first
    return ids


@lru_cache(maxsize=1)
def load_trie(uri: str, n_codes: int) -> Trie:
    """The last trie used stays with the worker (the only one, if one)."""
    return Trie(map_file(uri), n_codes)


# ------------------------------------------------------------- counting ----

class _Tally:
    """Counts of 64-bit keys, gathered over chunks, in sorted arrays."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts.astype(np.int64)))
        self.size += len(keys)
        if self.size > 2 * GATHER and len(self.parts) > 1:
            self.parts = [self.take()]
            self.size = len(self.parts[0][0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts]) if self.parts else np.zeros(0, np.int64)
        counts = np.concatenate([c for _, c in self.parts]) if self.parts else np.zeros(0, np.int64)
        self.parts, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        return keys[cuts], np.add.reduceat(counts[order], cuts) if len(cuts) else counts


def _tally(coded: DataFrame, keys_of, stop: int | None) -> DataFrame:
    """(key, n): keys that ``keys_of(codes)`` finds, counted over shards.  A
    shard's counts stop at ``stop``."""
    def run(batches):
        tally = _Tally()

        def flush():
            keys, counts = tally.take()
            if stop:
                counts = np.minimum(counts, stop)
            for at in range(0, len(keys), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 50_000]), pa.array(counts[at:at + 50_000])],
                                                 names=["key", "n"])

        for batch in batches:
            for row in batch.column(0):
                tally.add(keys_of(np.frombuffer(row.as_buffer(), "<i4")))
                if tally.size > GATHER:
                    yield from flush()
        yield from flush()

    return coded.select("codes").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _pairs(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.int64)
    return (c[:-1] << 32 | c[1:])[(c[:-1] > 0) & (c[1:] > 0)]


def _split(key: str):
    return F.shiftright(key, 32).cast("int"), F.col(key).bitwiseAND((1 << 32) - 1).cast("int")


def _trie_counts(coded: DataFrame, cands: DataFrame, tries, n_blocks: int, n_codes: int) -> DataFrame:
    """The candidates with ``f``: accepting states counted by shard, summed."""
    def keys_of(codes):
        ids = find_all(codes, tries, n_blocks, n_codes)
        ids = ids[ids >= 0]
        if not len(ids):
            return ids
        low = int(ids.min())
        seen = np.bincount(ids - low)
        hit = np.flatnonzero(seen)
        return hit + low, seen[hit]

    def run(batches):
        tally = _Tally()

        def flush():
            keys, counts = tally.take()
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(keys >> _SLICE) > 0])) if len(keys) else []
            rows = [(int(k[0] >> _SLICE), (k & ((1 << _SLICE) - 1)).astype("<u2").tobytes(), c.astype("<i8").tobytes())
                    for k, c in zip(np.split(keys, cuts[1:]), np.split(counts, cuts[1:])) if len(k)]
            for at in range(0, len(rows), 100):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 100]), types)],
                                                 names=["slice", "ids", "counts"])

        types = [pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for row in batch.column(0):
                got = keys_of(np.frombuffer(row.as_buffer(), "<i4"))
                if len(got):
                    tally.add(*got)
                if tally.size > GATHER:
                    yield from flush()
        yield from flush()

    def add_up(batches):
        at, total = None, np.zeros(1 << _SLICE, np.int64)

        def done():
            ids = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(ids + (at << _SLICE)), pa.array(total[ids])], names=["id", "f"])

        for batch in batches:
            for part, ids, counts in zip(*(batch.column(k) for k in range(3))):
                if part.as_py() != at:
                    if at is not None:
                        yield done()
                    at = part.as_py()
                    total[:] = 0
                total[np.frombuffer(ids.as_buffer(), "<u2")] += np.frombuffer(counts.as_buffer(), "<i8")
        if at is not None:
            yield done()

    # shards hand on one row per slice of 2^_SLICE phrases; slices are added up apart
    shards = coded.select("codes").mapInArrow(run, "slice long, ids binary, counts binary")
    sums = shards.repartition("slice").sortWithinPartitions("slice").mapInArrow(add_up, "id long, f long")
    return cands.drop("block").join(sums, "id").drop("id")


def frequent_phrases(coded: DataFrame, n_codes: int, min_count: int, block_phrases: int = BLOCK_PHRASES,
                     max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Pairs (c1, c2, f) and triples (c1, c2, c3, f) of codes that occur
    ``min_count`` times or more, with their counts."""
    c1, c2 = _split("key")
    pairs = materialize(_tally(coded, _pairs, min_count).where(F.col("n") >= min_count)
                        .select(c1.alias("c1"), c2.alias("c2")), "phrase-pairs")
    if pairs.count() > block_phrases * max_blocks:
        return _summed_phrases(coded, min_count)
    cand2, tries2, n2 = compile_tries(pairs, 2, block_phrases)

    def triples(codes):
        ids = find_all(codes, tries2, n2, n_codes)
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0)) if len(ids) else np.zeros(0, np.int64)
        return ids[at] << 32 | codes[at + 2].astype(np.int64)

    pid, c3 = _split("key")
    found = _tally(coded, triples, min_count).where(F.col("n") >= min_count).select(pid.alias("id"), c3.alias("c3"))
    trip = materialize(found.join(cand2.select("id", "c1", "c2"), "id").select("c1", "c2", "c3"), "phrase-triples")
    f2 = materialize(_trie_counts(coded, cand2, tries2, n2, n_codes), "phrase-f2")
    if trip.count() > block_phrases * max_blocks:
        return f2, _summed_phrases(coded, min_count)[1]
    cand3, tries3, n3 = compile_tries(trip, 3, block_phrases)
    f3 = materialize(_trie_counts(coded, cand3, tries3, n3, n_codes), "phrase-f3")
    return f2, f3


def _summed_phrases(coded: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """The same tables without tries, by one aggregate per length: the way
    for more candidates than ``max_blocks`` blocks hold."""
    c1, c2 = _split("key")
    f2 = _tally(coded, _pairs, None).where(F.col("n") >= min_count).select(
        c1.alias("c1"), c2.alias("c2"), F.col("n").alias("f"))

    def run(batches):
        for batch in batches:
            for row in batch.column(0):
                c = np.frombuffer(row.as_buffer(), "<i4")
                at = np.flatnonzero((c[:-2] > 0) & (c[1:-1] > 0) & (c[2:] > 0))
                yield pa.RecordBatch.from_arrays([pa.array(c[at + k]) for k in range(3)], names=["c1", "c2", "c3"])

    f3 = coded.select("codes").mapInArrow(run, "c1 int, c2 int, c3 int").groupBy("c1", "c2", "c3").agg(
        F.count(F.lit(1)).alias("f")).where(F.col("f") >= min_count)
    return materialize(f2, "phrase-f2"), materialize(f3, "phrase-f3")


# ------------------------------------------------------------- operator ----

def _score(a, l, r):
    """floor(1000000 * a * a / (l * r)), exactly."""
    wide = "decimal(15,0)"
    top = a.cast(wide) * a.cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, l.cast(wide) * r.cast(wide))


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, within_percent: int = 50,
                 block_phrases: int = BLOCK_PHRASES, max_blocks: int = MAX_BLOCKS,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per language, the ``top`` phrases of two or three words by score:
    lang, rank, phrase, a (its count), l and r (the counts of the parts of
    its weakest cut), n (all words of the language), score.

    A pair goes if a frequent triple that holds it has at least
    ``within_percent`` per cent of its count."""
    counts = materialize(word_counts(docs), "phrase-counts")
    total = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words, files = vocabulary(counts, min_count, block_words)
    n_codes = words.agg(F.max("code")).first()[0] or 0
    coded = code_texts(docs, files)
    f2, f3 = frequent_phrases(coded, n_codes, min_count, block_phrases, max_blocks)

    def word(k: int) -> DataFrame:
        return words.select(F.col("code").alias(f"c{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"),
                            *([F.col("lang")] if k == 1 else []))

    def pair(a: str, b: str, name: str) -> DataFrame:
        return f2.select(F.col("c1").alias(a), F.col("c2").alias(b), F.col("f").alias(name))

    inner = f3.select(F.explode(F.array(F.struct("c1", "c2"), F.struct(
        F.col("c2").alias("c1"), F.col("c3").alias("c2")))).alias("p"), "f")
    longest = inner.groupBy(F.col("p.c1").alias("c1"), F.col("p.c2").alias("c2")).agg(F.max("f").alias("m"))
    two = (f2.join(longest, ["c1", "c2"], "left")
           .where(F.col("m").isNull() | (100 * F.col("m") < within_percent * F.col("f")))
           .join(word(1), "c1").join(word(2), "c2"))
    two = two.select("lang", F.concat_ws(" ", F.col("w1").cast("string"), F.col("w2").cast("string")).alias("phrase"),
                     F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    three = (f3.join(word(1), "c1").join(word(2), "c2").join(word(3), "c3")
             .join(pair("c1", "c2", "f12"), ["c1", "c2"]).join(pair("c2", "c3", "f23"), ["c2", "c3"]))
    three = three.withColumn("s1", _score(F.col("f"), F.col("f1"), F.col("f23"))).withColumn(
        "s2", _score(F.col("f"), F.col("f12"), F.col("f3")))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", *[F.col(f"w{k}").cast("string") for k in (1, 2, 3)]).alias("phrase"),
                         F.col("f").alias("a"), F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                         F.least("s1", "s2").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
