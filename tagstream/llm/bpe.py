"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The words that are most frequent in the whole corpus are encoded once and
compiled into a minimal acyclic automaton (shared prefixes and suffixes).  The
numbers on a path's edges add up to the word's index in a table of ids, so the
automaton is a transducer from words to id sequences.  It is written to the
shared folder as flat arrays and memory-mapped by every task; tasks look up
all new words of a slice at once.  Words outside it are merged exactly, a
batch at a time, by rank.

The encoding equals that of the ``tokenizers`` library for files of this kind
(NFC, white space, lower case; split pattern; byte-level BPE with an
end-of-word suffix): tokens never cross ASCII white space, so a text's ids are
its words' ids in order.

Bounds: the lexicon holds at most ``LEXICON_WORDS`` words (it only affects
speed: other words are merged exactly); counting covers all texts.

Defined cases: a null text is the empty text and has no tokens; rows are
handled one by one, so ties and repeated rows agree; an empty table gives an
empty result and an empty lexicon; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import arrow_map, filesystem, make_folder, map_file, sha256_hex, whole_text
from tagstream.session import materialize, scratch_path

LEXICON_WORDS = 1 << 16
#: Words whose results a task keeps at a time.
CACHE_WORDS = 400_000
#: Distinct words that a counting task gathers before it hands them on.
COUNT_WORDS = 200_000
#: Longer words are merged one by one, by a heap.
BATCH_SYMBOLS = 40

_NONE = np.iinfo(np.int32).max
_EDGE_PUNCTUATION = b".,;:!?\"()[]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Merges:
    """Vocabulary and merge ranks of a tokenizer file; exact merging."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a BPE file with word ends")
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: normalisation {kinds} is not supported")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        tokens = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = t
        self.token_bytes = [t.encode() for t in tokens]
        self.id_bytes = [b"%d" % i for i in range(size)]
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        self.size = size
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.ranked = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranked]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it is no merge (-1: no symbol)."""
        key = left.astype(np.int64) * self.size + right
        key[right < 0] = -1
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranked[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece (UTF-8 bytes, not empty): the lowest-ranked pair
        is merged, leftmost first, until none is left."""
        out: list[list[int]] = [[]] * len(pieces)
        order = sorted(range(len(pieces)), key=[len(p) for p in pieces].__getitem__)
        at = 0
        while at < len(order):
            width = len(pieces[order[at]])
            if width > BATCH_SYMBOLS:
                out[order[at]] = self._merge_long(pieces[order[at]])
                at += 1
                continue
            limit = min(width + 2, BATCH_SYMBOLS)
            stop = at + 1
            while stop < len(order) and stop - at < 2048 and len(pieces[order[stop]]) <= limit:
                stop += 1
            rows = order[at:stop]
            for k, ids in zip(rows, self._merge_rows([pieces[k] for k in rows])):
                out[k] = ids
            at = stop
        return out

    def _merge_rows(self, pieces: list[bytes]) -> list[list[int]]:
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        width = int(lengths.max())
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.inner[flat]
        ids[np.arange(n), lengths - 1] = self.final[flat[np.cumsum(lengths) - 1]]
        result = np.full((n, width), -1, np.int32)
        live = np.arange(n)
        ranks = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while len(live):
            if not ranks.shape[1]:
                result[live, :ids.shape[1]] = ids
                break
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            go = best < _NONE
            if not go.all():
                result[live[~go], :ids.shape[1]] = ids[~go]
                live, ids, ranks, at, best = live[go], ids[go], ranks[go], at[go], best[go]
            m, cols = len(live), ids.shape[1]
            row = np.arange(m)
            ids[row, at] = self.merged[best]
            # drop the symbol after the merged one, and the pair that went
            keep = np.ones((m, cols), bool)
            keep[row, at + 1] = False
            ids = ids[keep].reshape(m, cols - 1)
            keep = np.ones((m, cols - 1), bool)
            keep[row, at] = False
            ranks = ranks[keep].reshape(m, cols - 2)
            if cols > 2:
                r = np.flatnonzero(at < cols - 2)
                a = at[r]
                ranks[r, a] = self.ranks(ids[r, a], ids[r, a + 1])
                r = np.flatnonzero(at > 0)
                a = at[r] - 1
                ranks[r, a] = self.ranks(ids[r, a], ids[r, a + 1])
        counts = np.concatenate([[0], np.cumsum((result >= 0).sum(axis=1))]).tolist()
        all_ids = result[result >= 0].tolist()
        return [all_ids[a:b] for a, b in zip(counts, counts[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """One long piece, by a heap of (rank, place) over linked symbols:
        n log n steps for n bytes."""
        flat = np.frombuffer(piece, np.uint8)
        start = self.inner[flat]
        start[-1] = self.final[flat[-1]]
        n, size = len(start), self.size
        of, left, right, merged = self.by_rank
        ranks = self.ranks(start[:-1], start[1:])
        at = np.flatnonzero(ranks < _NONE)
        ids = start.tolist()
        heap = (ranks[at].astype(np.int64) << 32 | at).tolist()  # rank first, then place
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            key = pop(heap)
            rank, k = key >> 32, key & 0xFFFFFFFF
            j = after[k]
            if ids[k] != left[rank] or j >= n or ids[j] != right[rank]:
                continue  # one of the two has been merged since
            ids[k] = new = merged[rank]
            ids[j] = -1
            j = after[k] = after[j]
            if j < n:
                before[j] = k
                r = of.get(new * size + ids[j])
                if r is not None:
                    push(heap, r << 32 | k)
            i = before[k]
            if i >= 0:
                r = of.get(ids[i] * size + new)
                if r is not None:
                    push(heap, r << 32 | i)
        return [x for x in ids if x >= 0]

    @cached_property
    def by_rank(self) -> tuple[dict[int, int], list[int], list[int], list[int]]:
        """For look-ups one by one: rank by pair; left, right and merged
        symbol by rank."""
        keys = np.empty_like(self.keys)
        keys[self.ranked] = self.keys
        return (dict(zip(self.keys.tolist(), self.ranked.tolist())), (keys // self.size).tolist(),
                (keys % self.size).tolist(), self.merged.tolist())

    def pieces(self, word: bytes) -> list[bytes | int]:
        """A word without ASCII white space, cut into pieces; special tokens
        come as their ids."""
        if word.isalpha():
            return [word.lower()]
        if word[:-1].isalpha() and word[-1] in b".,;:!?":
            return [word[:-1].lower(), word[-1:]]
        text = word.decode("utf-8", "surrogatepass")
        if self.special_split is None or "<" not in text:
            return self._cut(text)
        out: list[bytes | int] = []
        for part in self.special_split.split(text):
            out += [self.special[part]] if part in self.special else self._cut(part)
        return out

    def _cut(self, text: str) -> list[bytes]:
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in text):
                return self._cut_by_library(text)
            text = unicodedata.normalize("NFC", text)
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        return [p.encode("utf-8", "surrogatepass") for p in self.pattern.findall(text)]


    def _cut_by_library(self, text: str) -> list[bytes]:
        """Pieces of a text with characters newer than this Python's Unicode
        tables: the library's own tables decide."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        back = self.byte_of
        normal = self.library.normalizer.normalize_str(text)
        return [bytes(back[c] for c in p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]


# ------------------------------------------------------------- lexicon ----

def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Words (bytes, not empty) with their ids as one flat file: a minimal
    acyclic transducer, and the table of ids it indexes."""
    states: list[dict] = [{}]  # label -> state
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, label) of the last word's branch

    def settle(depth: int) -> None:
        """Replace the states below ``depth`` of the last branch by equal
        ones that are registered."""
        while len(path) > depth:
            parent, label = path.pop()
            child = states[parent][label]
            key = (final[child], tuple(states[child].items()))
            states[parent][label] = register.setdefault(key, child)

    ordered = sorted(words)
    last = b""
    for word in ordered:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        at = states[path[-1][0]][path[-1][1]] if path else 0
        for label in word[common:]:
            states.append({})
            final.append(False)
            states[at][label] = len(states) - 1
            path.append((at, label))
            at = len(states) - 1
        final[at] = True
        last = word
    settle(0)

    count: dict[int, int] = {}
    number: dict[int, int] = {}
    order: list[int] = []
    stack = [(0, False)]
    while stack:  # children first
        s, ready = stack.pop()
        if ready:
            count[s] = final[s] + sum(count[c] for c in states[s].values())
            order.append(s)
        elif s not in number:
            number[s] = len(number)
            stack.append((s, True))
            stack += [(c, False) for c in states[s].values() if c not in number]
    if len(number) >= 1 << 24:
        raise ValueError("too many states for 32-bit edge keys")
    edges = []
    for s in order:
        before = int(final[s])
        for label, child in sorted(states[s].items()):
            edges.append((number[s] << 8 | label, number[child], before))
            before += count[child]
    edges.sort()
    table = np.array(edges, np.int64).reshape(-1, 3)
    ends = np.zeros(len(number), np.uint32)
    ends[[number[s] for s in order if final[s]]] = 1
    ids = [words[w] for w in ordered]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.uint32)
    arrays = [table[:, 0], table[:, 1], table[:, 2], ends, offsets, np.array([i for x in ids for i in x], np.int64)]
    arrays = [a.astype("<u4") for a in arrays]
    return b"".join([np.array([len(a) for a in arrays], "<u4").tobytes(), *(a.tobytes() for a in arrays)])


class Lexicon:
    """A compiled lexicon over a mapped buffer."""

    def __init__(self, buffer):
        flat = np.frombuffer(buffer, "<u4")
        sizes = flat[:6]
        bounds = 6 + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.keys, self.targets, self.outputs, self.ends, self.offsets, self.ids = (
            flat[a:b] for a, b in zip(bounds, bounds[1:]))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, or -1."""
        found = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not words:
            return found
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint32)
        starts = np.cumsum(lengths) - lengths
        live = np.arange(len(words))
        state = np.zeros(len(words), np.uint32)
        index = np.zeros(len(words), np.int64)
        depth = 0
        while len(live):
            over = lengths[live] == depth
            hit = live[over]
            found[hit] = np.where(self.ends[state[hit]] == 1, index[hit], -1)
            live = live[~over]
            key = state[live] << np.uint32(8) | flat[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state[live] = self.targets[at]
            index[live] += self.outputs[at]
            depth += 1
        return found

    def of(self, index: int) -> list[int]:
        return self.ids[self.offsets[index]:self.offsets[index + 1]].tolist()


class Codec:
    """Encodes texts; results of words are kept up to ``CACHE_WORDS``."""

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        cut = {w: self.merges.pieces(w) for w in words}
        pieces = list({p for ps in cut.values() for p in ps if not isinstance(p, int)})
        found = self.lexicon.find(pieces)
        ids = {p: self.lexicon.of(k) for p, k in zip(pieces, found.tolist()) if k >= 0}
        rest = [p for p in pieces if p not in ids]
        ids.update(zip(rest, self.merges.merge(rest)))
        id_bytes, token_bytes, known = self.merges.id_bytes, self.merges.token_bytes, self.known
        for w, ps in cut.items():
            all_ids = [i for p in ps for i in ((p,) if isinstance(p, int) else ids[p])]
            known[w] = (b" ".join([id_bytes[i] for i in all_ids]), b" ".join([token_bytes[i] for i in all_ids]))

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(decimal ids joined by spaces, decoded text in UTF-8) per text."""
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        new = {w for ws in words for w in ws}
        if any(w not in self.known for w in new):
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known.clear()
            self.learn({w for w in new if w not in self.known})
        out = []
        for ws in words:
            got = [r for r in map(self.known.__getitem__, ws) if r[0]]
            out.append((b" ".join([r[0] for r in got]), b" ".join([r[1] for r in got])))
        return out


@lru_cache(maxsize=2)
def load_merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=1)
def load_codec(path: str, lexicon_uri: str) -> Codec:
    """One codec per Python worker; later tasks in it reuse what is known."""
    return Codec(load_merges(path), Lexicon(map_file(lexicon_uri)))


def decode(ids: list[int], merges: Merges) -> str:
    """Tokens joined by spaces, as files without a decoder are decoded."""
    return b" ".join([merges.token_bytes[i] for i in ids]).decode("utf-8")


# ----------------------------------------------------------- operators ----

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts: lower-cased words without edge punctuation.
    Tasks count before the shuffle and hand counts on when they hold
    ``COUNT_WORDS`` words."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        counts: Counter = Counter()

        def flush():
            merged: Counter = Counter()
            for w, n in counts.items():
                merged[w.lower().strip(_EDGE_PUNCTUATION)] += n
            counts.clear()
            merged.pop(b"", None)
            words, ns = list(merged), list(merged.values())
            for at in range(0, len(words), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + 10_000], pa.binary()),
                                                  pa.array(ns[at:at + 10_000], pa.int64())], schema=schema)

        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or "").encode("utf-8", "surrogatepass").split())
                if len(counts) > COUNT_WORDS:
                    yield from flush()
        yield from flush()

    parts = docs.select(whole_text().alias("text")).mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The words that occur ``cut`` times or more, for the least ``cut`` at
    which they are ``most`` at the most.  ``cut`` comes from a histogram of the
    counts, exact below 4,096 and by powers of two above: some 4,150 rows."""
    top = 4096
    step = F.when(F.col("n") < top, F.col("n")).otherwise(
        (top * F.pow(F.lit(2.0), F.floor(F.log2(F.col("n") / top)))).cast("long"))
    hist = sorted(((r["at"], r["k"]) for r in counts.groupBy(step.alias("at")).agg(F.count(F.lit(1)).alias("k")).collect()),
                  reverse=True)
    cut, words = None, 0
    for at, k in hist:
        words += k
        if words > most:
            break
        cut = at
    return counts.where(F.col("n") >= cut) if cut is not None else counts.limit(0)


def build_lexicon(docs: DataFrame, tokenizer_path: str, n_words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all texts, ``n_words`` at most
    (words seen once are left out); the URI of the file.  Only these words come
    to the driver, whatever the number of partitions."""
    merges = load_merges(tokenizer_path)
    counts = materialize(word_counts(docs).where(F.col("n") > 1), "word-counts")
    top = frequent_words(counts, n_words).select("word").collect()
    pieces = list({p for r in top for p in merges.pieces(bytes(r["word"])) if not isinstance(p, int)})
    data = compile_lexicon(dict(zip(pieces, merges.merge(pieces))))
    uri = make_folder(scratch_path(docs.sparkSession, "lexicon")) + "/words.fst"
    store, path = filesystem(uri)
    with store.open_output_stream(path) as f:
        f.write(data)
    return uri


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", with_ids: bool = True,
           n_words: int = LEXICON_WORDS) -> DataFrame:
    """Per row: id, n_tokens, digests of the ids and of the decoded text, and
    the ids themselves where ``with_ids``."""
    uri = build_lexicon(docs, tokenizer_path, n_words)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        out, names = out + ", ids array<int>", [*names, "ids"]

    def make():
        codec = load_codec(tokenizer_path, uri)

        def fn(batch):
            got = codec.encode_all(batch.column(1).to_pylist())
            cols = [batch.column(0), pa.array([i.count(b" ") + 1 if i else 0 for i, _ in got], pa.int64()),
                    pa.array([sha256_hex(i) for i, _ in got], pa.string()),
                    pa.array([sha256_hex(d) for _, d in got], pa.string())]
            if with_ids:
                cols.append(pa.array([np.array(i.split(), np.int32) for i, _ in got], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(cols, names=names)
        return fn

    return arrow_map(rows, out, make)
