"""Substring de-duplication by relative Lempel-Ziv parsing.

Every run of ``window`` words that begins at two places or more, of one or
more documents, is found, and the words that such runs cover are removed.

1. *Anchors.*  A window's anchor is its least run of ``ANCHOR_WORDS`` words by
   hash (the leftmost of equals), so equal windows have equal anchors at equal
   offsets.  Consecutive windows with one anchor make up a *passage*, on
   average about half as long again as a window.  Anchors are counted; those of
   at least two passages are marked in a bitmap of bounded size in the shared
   folder.  The bitmap only saves work: a mark too many costs time, not rows.
2. *Reference blocks.*  Passages with a marked anchor go to the block of their
   anchor, each distinct passage of a chunk once with its number of copies, so
   copies are collapsed before the shuffle.  A block holds whole groups of one
   anchor, up to ``BLOCK_WORDS`` words, and is indexed by a suffix array (over
   word numbers, by prefix doubling) with the longest match of every position
   elsewhere in the block.
3. *Parsing.*  Every passage is greedily factored against its block: the next
   factor is the longest match.  Factors of at least ``window`` words are
   duplicate spans.  A repeated window that is inside no factor straddles the
   end of one, so the windows around factor ends are checked too.  Passages
   with copies are duplicate as a whole.  Words are compared as bytes.
4. Spans go back to the places of their passages, and documents drop them.

Hot anchors (more than a 2^20th of all passages, and ``HOT`` at least), and
anchors whose distinct passages outgrow a block, are taken apart into windows,
which are counted by digest with partial sums, so no group meets in one task.
No step makes pairs.

Defined cases: a null or empty text has no words and the digest of the empty
text; texts shorter than a window keep all their words; repeated rows count
as documents of their own, and all their words go where they are long enough;
a null document id stays null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import arrow_map, attempt_name, filesystem, make_folder, map_file, per_block, whole_text
from tagstream.session import materialize, scratch_path

WINDOW = 35
ANCHOR_WORDS = 8
#: Words that a task handles at a time.
CHUNK_WORDS = 800_000
#: Words of a reference block.
BLOCK_WORDS = 1 << 20
#: Passages of an anchor from which on it may be hot.
HOT = 4096
#: Distinct anchors that a counting task gathers before it hands them on.
GATHER = 1 << 20
#: Bits of the anchor bitmap: per marked anchor, at most, and in one file (as powers of 2).
_BITS_EACH, _BITS_MOST, _BITS_FILE = 16, 33, 26
#: Hashes of words that a Python worker keeps.
CACHE_WORDS = 400_000

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))  # finalisers of a public hash
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """64-bit hashes of words, kept while they are few."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(words)
        known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in _MIX:
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


def find_passages(hashes: np.ndarray, ends: np.ndarray, window: int):
    """Passages of documents laid end to end (fewer than 2^24 words, ``ends``
    their ends): anchors (int64), first and last window of each."""
    none = np.zeros(0, np.int64)
    k = min(ANCHOR_WORDS, window)
    if len(hashes) < window:
        return none, none, none
    runs = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        runs = runs * _STEP + hashes[j:len(runs) + j]
    runs = _mixed(runs)
    key = (runs & ~np.uint64((1 << 24) - 1)) | np.arange(len(runs), dtype=np.uint64)
    span, width = window - k + 1, 1
    while width * 2 <= span:  # the least of `width` neighbours
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:width - span], key[span - width:])
    last = np.repeat(ends, np.diff(ends, prepend=0))[:len(key)]  # end of each position's document
    at = np.flatnonzero(np.arange(len(key)) + window <= last)
    if not len(at):
        return none, none, none
    anchor = (key[at] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    stop = np.append(new[1:], len(at)) - 1
    return runs[anchor[new]].view(np.int64), at[new], at[stop]


def _chunks(batches, columns: int):
    """(rows, words, ends): the other columns of up to ``CHUNK_WORDS`` words
    of whole texts, their words laid end to end, and where texts end."""
    rows, words, ends = [], [], []
    for batch in batches:
        others = list(zip(*[batch.column(c).to_pylist() for c in range(1, columns)])) or [()] * batch.num_rows
        for row, text in zip(others, batch.column(0)):
            mine = text.as_py().encode("utf-8", "surrogatepass").split()
            if words and len(words) + len(mine) > CHUNK_WORDS:
                yield rows, words, np.array(ends, np.int64)
                rows, words, ends = [], [], []
            rows.append(row)
            words += mine
            ends.append(len(words))
    if rows:
        yield rows, words, np.array(ends, np.int64)


def _parts(hasher: Hasher, words: list[bytes], ends: np.ndarray, window: int):
    """``find_passages``, for texts of 2^24 words or more by overlapping
    pieces.  A passage that two pieces meet in is cut there, which all its
    windows survive; the anchors of windows don't depend on the cut."""
    most = (1 << 24) - 1
    if len(words) <= most:
        return find_passages(hasher.of(words), ends, window)
    got = []
    for at in range(0, len(words) - window + 1, most - window + 1):
        piece = words[at:at + most]
        inside = np.clip(ends - at, 0, len(piece))
        a, b, c = find_passages(hasher.of(piece), np.unique(np.append(inside[inside > 0], len(piece))), window)
        got.append((a, b + at, c + at))
    return tuple(np.concatenate(x) for x in zip(*got))


# -------------------------------------------------------------- anchors ----

def anchor_counts(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, n): passages of each anchor; tasks count before the shuffle."""
    def run(batches):
        hasher, held, size = Hasher(), [], 0

        def flush():
            if held:
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                for at in range(0, len(keys), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 50_000]), pa.array(n[at:at + 50_000])],
                                                     names=["anchor", "n"])

        for _, words, ends in _chunks(batches, 1):
            anchors = _parts(hasher, words, ends, window)[0]
            held.append(anchors)
            size += len(anchors)
            if size > GATHER:
                yield from flush()
                held, size = [], 0
        yield from flush()

    return texts.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


class Marked:
    """The bitmap of anchors: one bit for the leading bits of the hash."""

    def __init__(self, bits: int, files: dict[int, str]):
        self.bits, self.files = bits, files
        self.maps: dict[int, np.ndarray] = {}

    def test(self, anchors: np.ndarray) -> np.ndarray:
        at = (anchors.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)
        part = at >> _BITS_FILE
        found = np.zeros(len(at), bool)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) > 0])) if len(at) else []
        for rows in np.split(order, cuts[1:] if len(cuts) else []):
            if not len(rows) or int(part[rows[0]]) not in self.files:
                continue
            k = int(part[rows[0]])
            if k not in self.maps:
                self.maps[k] = np.frombuffer(map_file(self.files[k]), np.uint8)
            inside = at[rows] & ((1 << _BITS_FILE) - 1)
            found[rows] = self.maps[k][inside >> 3] >> (inside & 7) & 1
        return found


def mark_anchors(counts: DataFrame) -> tuple[int, dict[int, str]]:
    """Bitmap of the anchors seen twice or more: its bits (as a power of 2)
    and its files."""
    twice = counts.where(F.col("n") > 1)
    bits = min(_BITS_MOST, max(16, int(twice.count() * _BITS_EACH).bit_length()))
    at = F.shiftrightunsigned("anchor", 64 - bits)
    folder = make_folder(scratch_path(counts.sparkSession, "repeat-anchors"))
    size = 1 << min(bits, _BITS_FILE)

    def write(table: pa.Table):
        inside = np.unique(table["at"].to_numpy() & ((1 << _BITS_FILE) - 1))
        flat = np.zeros(size, np.uint8)
        flat[inside] = 1
        name = attempt_name("anchors", ".bits")
        store, path = filesystem(folder)
        with store.open_output_stream(f"{path}/{name}") as f:
            f.write(np.packbits(flat, bitorder="little").tobytes())
        return name

    rows = twice.select(F.shiftright(at, _BITS_FILE).cast("int").alias("block"), at.alias("at"))
    files = per_block(rows, max(1, (1 << bits) >> _BITS_FILE), [], write)
    return bits, {b: f"{folder}/{name}" for b, name in files}


# ------------------------------------------------------------- passages ----

_PASSAGES = ("tkey long, start int, digest binary, anchor long, words binary, n long, "
             "window binary, at int")


def _passages(texts: DataFrame, id_type: str, marked: tuple[int, dict[int, str]], hot: np.ndarray, window: int) -> DataFrame:
    """Three kinds of rows: places (doc_id, tkey, start, digest); passages
    (digest, anchor, words, n); windows of hot anchors (digest, window, at, n)."""
    names = ["doc_id", *(f.strip().split(" ")[0] for f in _PASSAGES.split(","))]

    def run(batches):
        hasher, bitmap = Hasher(), Marked(*marked)
        types = None

        def out(size, **cols):
            return pa.RecordBatch.from_arrays(
                [cols[c] if c in cols and isinstance(cols[c], pa.Array) else pa.array(cols[c], t) if c in cols
                 else pa.nulls(size, t) for c, t in zip(names, types)], names=names)

        def watched():
            nonlocal types
            for batch in batches:
                if types is None:
                    types = [batch.schema.field(1).type, pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(),
                             pa.int64(), pa.binary(), pa.int32()]
                yield batch

        for rows, words, ends in _chunks(watched(), 3):
            anchors, first, last = _parts(hasher, words, ends, window)
            keep = bitmap.test(anchors)
            anchors, first, last = anchors[keep], first[keep], last[keep]
            if not len(anchors):
                continue
            text = np.searchsorted(ends, first, side="right")
            start = first - np.concatenate([[0], ends])[text]
            is_hot = np.isin(anchors, hot).tolist()
            known: dict[bytes, list] = {}
            digests = []
            for k, (a, b) in enumerate(zip(first.tolist(), (last + window).tolist())):
                body = b" ".join(words[a:b])
                digest = xxhash.xxh3_128_digest(body)
                digests.append(digest)
                if digest in known:
                    known[digest][2] += 1
                else:
                    known[digest] = [k, body, 1]
            for at in range(0, len(digests), 20_000):
                some = text[at:at + 20_000].tolist()
                yield out(len(some), doc_id=[rows[t][0] for t in some], tkey=[rows[t][1] for t in some],
                          start=start[at:at + 20_000].astype(np.int32), digest=digests[at:at + 20_000])
            plain = [(d, k, body, n) for d, (k, body, n) in known.items() if not is_hot[k]]
            for at in range(0, len(plain), 5_000):
                d, k, body, n = zip(*plain[at:at + 5_000])
                yield out(len(d), digest=d, anchor=anchors[list(k)], words=body, n=n)
            for d, (k, body, n) in known.items():
                if is_hot[k]:
                    found = _windows(body, window)
                    yield out(len(found), digest=[d] * len(found), window=found, at=list(range(len(found))),
                              n=[n] * len(found))

    return texts.select("text", "doc_id", "tkey").mapInArrow(run, f"doc_id {id_type}, {_PASSAGES}")


def _windows(body: bytes, window: int) -> list[bytes]:
    words = body.split(b" ")
    return [xxhash.xxh3_128_digest(b" ".join(words[a:a + window])) for a in range(len(words) - window + 1)]


# -------------------------------------------------------------- parsing ----

class Block:
    """A reference block: passages (lists of words) laid end to end, each
    followed by a mark of its own, under a suffix array."""

    def __init__(self, passages: list[list[bytes]]):
        number: dict[bytes, int] = {}
        for p in passages:
            for w in p:
                number.setdefault(w, len(number))
        sizes = np.array([len(p) for p in passages], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        self.ends = self.starts + sizes
        ids = np.empty(int((sizes + 1).sum()), np.int64)
        ids[self.ends] = len(number) + np.arange(len(passages))
        inside = np.ones(len(ids), bool)
        inside[self.ends] = False
        ids[inside] = np.fromiter((number[w] for p in passages for w in p), np.int64, int(sizes.sum()))
        self.match = self._longest(ids, int(sizes.max(initial=0)))
        self.match[self.ends] = 0

    @staticmethod
    def _longest(ids: np.ndarray, longest: int) -> np.ndarray:
        """Words that each position shares with its longest match elsewhere:
        its neighbours in suffix order hold it."""
        n = len(ids)
        levels = [ids]
        rank, step = ids, 1
        while step <= longest:  # then all suffixes differ, by their marks
            key = rank * (n + 1)
            key[:n - step] += rank[step:] + 1
            rank = np.unique(key, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(n - 1, 0), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            live = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[live] = levels[k][a[live]] == levels[k][b[live]]
            for x in (common, a, b):
                x[same] += 1 << k
        match = np.zeros(n, np.int64)
        match[order[:-1]] = common
        match[order[1:]] = np.maximum(match[order[1:]], common)
        return match

    def parse(self, window: int):
        """(passage, begin, end) arrays of duplicate spans: all passages are
        factored side by side, a factor each per round."""
        which, at = np.arange(len(self.starts)), self.starts.copy()
        found = []
        while len(which):
            size = np.maximum(self.match[at], 1)
            end = at + size
            hit = size >= window
            found.append((which[hit], at[hit], end[hit]))
            for back in range(1, min(window, int(size.max()))):  # windows that straddle the factor's end
                q = end - back
                ok = q > at
                w, q = which[ok], q[ok]
                ok = self.match[q] >= window
                found.append((w[ok], q[ok], (q + self.match[q])[ok]))
            go = end < self.ends[which]
            which, at = which[go], end[go]
        which, begin, end = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return which, begin - self.starts[which], end - self.starts[which]


def _merged(begin: np.ndarray, end: np.ndarray, group: np.ndarray):
    """Unions of spans per group, sorted."""
    order = np.lexsort((begin, group))
    group, begin, end = group[order], begin[order], end[order]
    if not len(group):
        return group, begin, end
    reach = end + group * (1 << 32)  # groups don't touch
    top = np.maximum.accumulate(reach)
    new = np.flatnonzero(np.concatenate([[True], begin[1:] + group[1:] * (1 << 32) > top[:-1]]))
    return group[new], begin[new], np.maximum.reduceat(end, new)


def _factored(passages: DataFrame, window: int, block_words: int) -> DataFrame:
    """Duplicate spans (digest, lo, hi) of passages, or windows (digest,
    window, at, n) of those whose anchor outgrows a block."""
    rows = passages.select("anchor", "digest", "words", "n").repartition("anchor").sortWithinPartitions("anchor", "digest")
    names = ["digest", "lo", "hi", "window", "at", "n"]
    types = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]

    def out(size, **cols):
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[c], t) if c in cols else pa.nulls(size, t) for c, t in zip(names, types)], names=names)

    def spans(block):
        """Of a list of [digest, words, n]; copies are duplicate as a whole."""
        if not block:
            return
        parsed = Block([p[1] for p in block])
        which, lo, hi = parsed.parse(window)
        whole = np.array([k for k, p in enumerate(block) if p[2] > 1], np.int64)
        sizes = np.array([len(p[1]) for p in block], np.int64)
        which, lo, hi = (np.concatenate(x) for x in ((which, whole), (lo, 0 * whole), (hi, sizes[whole])))
        which, lo, hi = _merged(lo, hi, which)
        yield out(len(which), digest=[block[k][0] for k in which.tolist()], lo=lo.astype(np.int32), hi=hi.astype(np.int32))

    def whole(copies):
        if copies:
            digests, sizes = zip(*copies)
            yield out(len(copies), digest=digests, lo=[0] * len(copies), hi=sizes)

    def windows(group):
        for digest, words, n in group:
            found = _windows(b" ".join(words), window)
            yield out(len(found), digest=[digest] * len(found), window=found, at=list(range(len(found))), n=[n] * len(found))

    def run(batches):
        block, block_size = [], 0  # groups of anchors that are complete
        copies = []  # anchors with one distinct passage need no index
        group, group_size, anchor, large = [], 0, None, False
        for batch in batches:
            for a, digest, words, n in zip(*[batch.column(c).to_pylist() for c in range(4)]):
                if a != anchor:
                    if large:
                        yield from windows(group)
                    else:
                        if block_size + group_size > block_words:
                            yield from spans(block)
                            block, block_size = [], 0
                        if len(group) == 1:
                            copies += [(p[0], len(p[1])) for p in group if p[2] > 1]
                        else:
                            block += group
                            block_size += group_size
                        if len(copies) >= 5_000:
                            yield from whole(copies)
                            copies = []
                    group, group_size, anchor, large = [], 0, a, False
                if group and group[-1][0] == digest:
                    group[-1][2] += n
                    continue
                if group_size > block_words:  # too large: nothing of it is kept
                    yield from windows(group)
                    group, group_size, large = [], 0, True
                group.append([digest, words.split(b" "), n])
                group_size += len(group[-1][1])
        if large:
            yield from windows(group)
            group = []
        yield from whole(copies)
        yield from spans(block)
        yield from spans(group)

    return rows.mapInArrow(run, "digest binary, lo int, hi int, window binary, at int, n long")


# ------------------------------------------------------------- operator ----

def duplicate_spans(docs: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, hot: int = HOT) -> DataFrame:
    """(doc_id, tkey, spans) of documents with repeated windows: word spans,
    packed as begin * 2^32 + length; ``tkey`` is the text's xxhash64."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = materialize(anchor_counts(docs, window), "repeat-anchor-counts")
    marked = mark_anchors(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(hot, total >> 20)  # so at most 2^20 anchors are hot
    hot_anchors = np.array([r["anchor"] for r in counts.where(F.col("n") > limit).select("anchor").collect()], np.int64)
    rows = materialize(_passages(docs, id_type, marked, hot_anchors, window), "repeat-passages", "zstd")
    parsed = materialize(_factored(rows.where(F.col("words").isNotNull()), window, block_words), "repeat-spans")

    single = rows.where(F.col("window").isNotNull()).select("digest", "window", "at", "n").unionByName(
        parsed.where(F.col("window").isNotNull()).select("digest", "window", "at", "n"))
    again = single.groupBy("window").agg(F.sum("n").alias("_n")).where(F.col("_n") > 1).select("window")
    single = single.join(again, "window", "left_semi").select(
        "digest", F.col("at").alias("lo"), (F.col("at") + window).alias("hi")).distinct()
    spans = parsed.where(F.col("lo").isNotNull()).select("digest", "lo", "hi").unionByName(single)

    places = rows.where(F.col("start").isNotNull()).select("doc_id", "tkey", "start", "digest")
    found = places.join(spans, "digest")
    begin = F.shiftleft((F.col("start") + F.col("lo")).cast("long"), 32)
    return found.groupBy("doc_id", "tkey").agg(F.collect_set(begin + F.col("hi") - F.col("lo")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                   hot: int = HOT, with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and the kept words
    joined by spaces (``kept_text``) where ``with_text``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumn("tkey", F.xxhash64("text"))
    spans = duplicate_spans(rows, window, block_words, hot).select(
        F.col("doc_id").alias("_id"), F.col("tkey").alias("_key"), "spans")
    rows = rows.join(spans, rows["doc_id"].eqNullSafe(spans["_id"]) & (rows["tkey"] == spans["_key"]), "left").select(
        "doc_id", "text", "spans")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def make():
        def fn(batch):
            n_words, n_removed, digests, texts = [], [], [], []
            for text, packed in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if packed.is_valid:
                    p = packed.values.to_numpy()
                    _, begin, end = _merged(p >> 32, (p >> 32) + (p & 0xFFFFFFFF), np.zeros(len(p), np.int64))
                    kept, at = [], 0
                    for a, b in zip(begin.tolist(), end.tolist()):
                        kept += words[at:a]
                        at = b
                    words = kept + words[at:]
                n_removed.append(n_words[-1] - len(words))
                body = b" ".join(words)
                digests.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    texts.append(body.decode("utf-8", "surrogatepass"))
            cols = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests)]
            return pa.RecordBatch.from_arrays(cols + [pa.array(texts, pa.string())] * with_text, names=names)
        return fn

    return arrow_map(rows, schema, make)
