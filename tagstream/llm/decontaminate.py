"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised (A-Z lowered, words joined by single spaces)
and cut into windows of 13 words (the whole item where it is shorter).  All
windows go into one automaton; each document is normalised the same way and
scanned once.  Matches are mapped back to words and, for the operator's
spans, to code points of the original text.

Tasks build the automaton from files of the shared folder; no benchmark text
passes the driver.  Beyond ``SLICE_CHARS`` characters the benchmark is cut into
slices, a file each, and a task holds the automaton of one slice at a time:
it gathers documents, scans them with one slice after the other and merges the
hits, so nothing is lost and memory stays flat.

Defined cases: null texts have no words and no hits; null benchmark texts and
items without words have no windows; windows of items with a null item_id count
as hits, but their items aren't counted or listed; repeated item rows count
once per item_id; each document row is judged on its own (ties, repeats); an empty
benchmark contaminates nothing; an empty table gives an empty result; the
filter carries all other columns untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import (SLICE_ROWS, attempt_name, filesystem, make_folder, map_file, per_block, sha256_hex,
                                  whole_text)
from tagstream.session import scratch_path

WINDOW = 13
#: Benchmark characters that one automaton takes.
SLICE_CHARS = 2_000_000
#: Bytes of text that a task gathers before it goes through several slices.
GATHER_CHARS = 32 << 20
#: A document is contaminated from one hit word in this many on.
ONE_IN = 20

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
                for c in range(256))
_WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def padded(words: list[bytes]) -> str:
    """Words with a space around each, one character for a byte."""
    return " " + b" ".join(words).decode("latin-1") + " "


def windows(text: str) -> list[tuple[str, int]]:
    """Distinct windows of an item and their lengths in words."""
    words = normal_words(text)
    if not words:
        return []
    size = min(WINDOW, len(words))
    return list({padded(words[k:k + size]): size for k in range(len(words) - size + 1)}.items())


def build_automaton(items: list[tuple[str, str]]) -> ahocorasick.Automaton:
    """Automaton over the windows of (item_id, text); the value of a window:
    its words and the items that hold it."""
    holders: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        for window, size in windows(text):
            of = holders.setdefault(window, (size, set()))[1]
            if item is not None:
                of.add(item)
    a = ahocorasick.Automaton()
    for window, (size, of) in holders.items():
        a.add_word(window, (size, len(window), tuple(sorted(of))))
    a.make_automaton()
    return a


@dataclass
class Hits:
    """What a scan found: word ranges (end exclusive) and items."""
    ranges: list[tuple[int, int]]
    items: set[str]

    def words(self) -> int:
        total = end = 0
        for a, b in sorted(self.ranges):
            total += max(0, b - max(a, end))
            end = max(end, b)
        return total


def scan(text: str, automaton: ahocorasick.Automaton, hits: Hits) -> None:
    """Adds the hits in padded words."""
    at = word = 0
    for last, (size, length, of) in automaton.iter(text):
        # the window's leading space is the separator before its first word
        start = last - length + 1
        if start >= at:
            word += text.count(" ", at, start)
        else:
            word -= text.count(" ", start, at)
        at = start
        hits.ranges.append((word, word + size))
        hits.items.update(of)


def char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Merged word ranges as code points of the original text."""
    bounds = [m.span() for m in _WORD.finditer(text)]
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        start, end = bounds[a][0], bounds[b - 1][1]
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def write_slices(benchmark: DataFrame, slice_chars: int = SLICE_CHARS) -> list[str]:
    """Benchmark texts in files of about ``slice_chars`` characters; their
    URIs.  Texts are dealt by their hash, so that equal ones lie together."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), whole_text().alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // slice_chars))
    rows = rows.where(F.col("text") != "").withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n)).cast("int"))
    folder = make_folder(scratch_path(benchmark.sparkSession, "benchmark"))

    def write(table: pa.Table) -> str:
        name = attempt_name("slice", ".arrow")
        store, path = filesystem(folder)
        table = table.select(["item", "text"])
        with store.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_file(f, table.schema) as out:
            out.write_table(table)
        return name

    return [f"{folder}/{name}" for _, name in per_block(rows, n, ["item", "text"], write)]


@lru_cache(maxsize=1)
def load_automaton(uri: str) -> ahocorasick.Automaton:
    """The automaton of a slice; a worker keeps the last one."""
    table = pa.ipc.open_file(pa.BufferReader(map_file(uri))).read_all()
    return build_automaton(list(zip(table["item"].to_pylist(), table["text"].to_pylist())))


def scan_all(rows: DataFrame, schema, uris: list[str], text_at: int, judge) -> DataFrame:
    """``judge(batch, texts, n_words, hits)`` over all rows: its record batch.
    Rows are gathered up to ``GATHER_CHARS`` characters of text where there are
    several slices, so that a slice's automaton is built once for all of them."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def flush():
            work = []
            for batch in held:
                texts = [t or "" for t in batch.column(text_at).to_pylist()]
                words = [normal_words(t) for t in texts]
                work.append((batch, texts, [len(w) for w in words], [padded(w) if w else "" for w in words],
                             [Hits([], set()) for _ in words]))
            for uri in uris:
                automaton = load_automaton(uri)
                if len(automaton):
                    for _, _, _, flat, hits in work:
                        for text, h in zip(flat, hits):
                            if text:
                                scan(text, automaton, h)
            for batch, texts, n_words, _, hits in work:
                yield judge(batch, texts, n_words, hits)

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                held.append(whole.slice(at, SLICE_ROWS))
                size += held[-1].column(text_at).nbytes
                if len(uris) < 2 or size > GATHER_CHARS:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return rows.mapInArrow(run, schema)


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and ONE_IN * n_hit >= n_words


def decontamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Per row: words, hit words, items found, their digest, the verdict, and
    ``hit_spans`` (merged passages as code points of the original)."""
    uris = write_slices(benchmark, slice_chars)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, "
           "contaminated boolean, hit_spans string")

    def judge(batch, texts, n_words, hits):
        n_hit = [h.words() for h in hits]
        spans = [",".join(f"{a}:{b}" for a, b in char_spans(t, h.ranges)) if h.ranges else "" for t, h in zip(texts, hits)]
        cols = [n_words, n_hit, [len(h.items) for h in hits],
                [sha256_hex(",".join(sorted(h.items)).encode()) for h in hits],
                [contaminated(n, k) for n, k in zip(n_words, n_hit)], spans]
        types = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"])

    return scan_all(rows, out, uris, 1, judge)


def keep_clean(docs: DataFrame, benchmark: DataFrame, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they
    were."""
    def judge(batch, texts, n_words, hits):
        return batch.filter(pa.array([not contaminated(n, h.words()) for n, h in zip(n_words, hits)], pa.bool_()))

    return scan_all(docs, docs.schema, write_slices(benchmark, slice_chars), docs.columns.index("text"), judge)
