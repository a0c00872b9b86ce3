"""Quality rules by distribution divergence.

Each document's character-class histogram and common-word histogram are
compared with those of its nearest language reference by Jensen-Shannon
distance.  References are summed over *all* documents of the language that
pass the base rules.  A document goes when it fails the base rules or lies too
far from every reference; how far is too far depends on its length.

Three passes read the texts: one sums the reference histograms (a few hundred
numbers per language come to the driver), one takes the spread of the distances
to them (a histogram for the languages with a word list and one for each other),
one judges each row.  None shuffles a text.

Defined cases: a null text is the empty text (no words, so it fails the base
rules); ties and repeated rows are judged alike, each row on its own; an empty
table gives an empty result; other columns are carried through a filter
untouched, whatever their names; a document is compared with the references of
all languages that have a word list, and where its own language has none, also
with that one's, by characters only; null counts as a language without a word
list, and a language's reference is no shelter for documents of others; without
any reference (no document passes the base rules) only the base rules decide.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import arrow_map, record_batch, whole_text

# Frequent function words per language.
COMMON_WORDS = {
    "en": "the of and to a in is that for it as with was on be by at or are an".split(),
    "de": "der die und das in den von zu mit ist nicht ein eine im auf für dem sich des auch".split(),
    "fr": "le la les de des et en un une du que qui pour dans est sur pas au par il".split(),
    "es": "el la los de y que en un una del se las por con para su no es al lo".split(),
}
#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest squared distance from the nearest reference that is kept: floor +
#: slope / length, up to a largest value.  A short text scatters more (its bins
#: hold few counts, and one address or key in it moves a share of 1 / length).
#: Chosen from the spread over all documents of the given tables.  Characters:
CHAR_FLOOR, CHAR_SLOPE, CHAR_MOST = 0.0145, 24, 0.30 ** 2
#: Common words (length in words):
WORD_FLOOR, WORD_SLOPE, WORD_MOST = 0.105, 3, 0.383 ** 2
#: The floor for characters is at least this many times the median squared
#: distance of all documents from their nearest references.
SPREAD = 1.2
SPREAD_BINS = 2000

SYMBOLS = re.compile(rb"[#*$%&|<>]")
SPACES = b" \t\n\x0b\x0c\r"

VOCAB = sorted({w for ws in COMMON_WORDS.values() for w in ws})
N_CLASSES = 8


def _class_table() -> np.ndarray:
    """UTF-8 byte -> character class: 0 lower, 1 upper, 2 digit, 3 space,
    4 sentence punctuation, 5 other ASCII, 6 other character (its lead byte);
    7 takes continuation bytes and is not part of the histogram."""
    table = np.full(256, 5)
    table[ord("a"):ord("z") + 1] = 0
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    table[list(SPACES)] = 3
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    table[0x80:0xC0] = 7
    table[0xC0:] = 6
    return np.eye(N_CLASSES, dtype=np.int64)[table]


CLASS_OF_BYTE = _class_table()
_WORD_ONLY = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
                   for c in range(256))
_VOCAB_INDEX = {w.encode(): i for i, w in enumerate(VOCAB)}


def repeat_words(words: list[bytes]) -> int:
    """Words lying in a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter([seen.setdefault(w, len(seen)) for w in words], np.int64, n)
    k = len(seen)
    if k < 1 << 21:
        keys = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:  # the product would not fit 63 bits: number the pairs first
        _, pair = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)
        keys = pair[:-1] * k + ids[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    starts = np.flatnonzero(np.isin(keys, twice))
    covered = np.zeros(n, bool)
    for at in range(3):
        covered[starts + at] = True
    return int(covered.sum())


def dup_lines(data: bytes) -> int:
    lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    spaces = sum(text.count(c) for c in SPACES.decode())
    return (len(words), len(text) - spaces, len(SYMBOLS.findall(data)), dup_lines(data), repeat_words(words))


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def char_histogram(data: bytes) -> np.ndarray:
    return (np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ CLASS_OF_BYTE)[:7]


def histograms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character-class counts and common-word counts (last bin: all others)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.translate(_WORD_ONLY).split()
    index = _VOCAB_INDEX
    found = [index[w] for w in words if w in index]
    counts = np.bincount(found, minlength=len(VOCAB) + 1) if found else np.zeros(len(VOCAB) + 1, np.int64)
    counts[-1] = len(words) - len(found)
    return char_histogram(data), counts


def js_distance(counts: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, in 0..1) of one histogram to each row
    of ``refs`` (probabilities).  An empty histogram has distance 0."""
    total = counts.sum()
    if total == 0:
        return np.zeros(len(refs))
    p = counts / total
    m = (p + refs) / 2

    def kl(a, b):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / b), 0.0).sum(axis=-1)

    return np.sqrt(np.clip((kl(p, m) + kl(refs, m)) / 2, 0, 1))


class References(dict):
    """Language -> summed histograms.  ``spread``: group of languages (see
    ``group_of``) -> median squared character distance of all its documents
    from their nearest references."""

    def __init__(self, *args):
        super().__init__(*args)
        self.spread: dict[str, float] = {}


#: The group of the languages with a word list.
LISTED = "en"


def group_of(lang: str) -> str:
    """Languages with a word list are compared as one group, others alone."""
    return LISTED if lang in COMMON_WORDS else lang


def language(name: str = "lang"):
    """The language column with null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def language_references(docs: DataFrame) -> References:
    """Summed histograms of all documents per language.  Each task returns
    small rows per language, so what reaches the driver is bounded by the word
    table and the number of languages, not by the corpus."""
    width = 7 + len(VOCAB) + 1
    schema = pa.schema([("lang", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])

    def make():
        def fn(batch):
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                if len(words) < MIN_WORDS or base_fails(len(words), repeat_words(words)):
                    continue
                sums[lang] = sums.get(lang, 0) + np.concatenate(histograms(text))
            langs = list(sums)
            rows, bins = np.nonzero(np.array([sums[k] for k in langs]).reshape(-1, width))
            counts = [int(sums[langs[r]][b]) for r, b in zip(rows, bins)]
            return record_batch(schema, [[langs[r] for r in rows], bins.astype(np.int32), counts])
        return fn

    rows = docs.select(whole_text().alias("text"), language().alias("lang"))
    parts = arrow_map(rows, "lang string, bin int, n long", make)
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect():  # at most langs x width rows
        out.setdefault(r["lang"], np.zeros(width, np.int64))[r["bin"]] = r["n"]
    refs = References({k: (v[:7].tolist(), v[7:].tolist()) for k, v in out.items() if v.any()})
    refs.spread = _spread(rows, refs) if refs else {}
    return refs


def _spread(rows: DataFrame, refs: References) -> dict[str, float]:
    """Median squared character distance of all documents with enough words,
    by group; at most ``SPREAD_BINS`` + 1 rows a group are gathered."""
    schema = pa.schema([("lang", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])

    def make():
        judge = Judge(refs)

        def fn(batch):
            counts: dict[tuple[str, int], int] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data, near = text.encode("utf-8", "surrogatepass"), judge.references_for(lang)
                if len(near) and len(data.split()) >= MIN_WORDS:
                    far = js_distance(char_histogram(data), near).min()
                    key = group_of(lang), int(far * far * SPREAD_BINS)
                    counts[key] = counts.get(key, 0) + 1
            return record_batch(schema, [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())])
        return fn

    parts = arrow_map(rows, "lang string, bin int, n long", make).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    bins: dict[str, list[tuple[int, int]]] = {}
    for r in parts.collect():
        bins.setdefault(r["lang"], []).append((r["bin"], r["n"]))
    out = {}
    for lang, found in bins.items():
        at, n = np.array(sorted(found)).T
        out[lang] = (float(at[np.searchsorted(np.cumsum(n), n.sum() / 2)]) + 0.5) / SPREAD_BINS
    return out


class Judge:
    """Verdict on one text under given references."""

    def __init__(self, refs: dict):
        norm = {k: [np.array(h, float) / max(1, sum(h)) for h in v] for k, v in refs.items()}
        listed = sorted(set(refs) & set(COMMON_WORDS))
        self.chars = np.array([norm[k][0] for k in listed]).reshape(-1, 7)
        self.words = np.array([norm[k][1] for k in listed]).reshape(-1, len(VOCAB) + 1)
        self.own = {k: np.vstack([self.chars, norm[k][0]]) for k in refs if k not in COMMON_WORDS}
        self.floors = {k: max(CHAR_FLOOR, SPREAD * v) for k, v in getattr(refs, "spread", {}).items()}

    def references_for(self, lang: str) -> np.ndarray:
        """The character references that a document of ``lang`` is held against."""
        return self.own.get(lang, self.chars)

    def distances(self, text: str, lang: str = LISTED) -> tuple[float, float, float, float]:
        """Distances by characters and by words, and the largest ones kept."""
        refs = self.references_for(lang)
        if not len(refs):
            return 0.0, 0.0, 1.0, 1.0
        chars, words = histograms(text)
        floor = self.floors.get(group_of(lang), CHAR_FLOOR)
        by_words = lang in COMMON_WORDS and len(self.words)
        return (float(js_distance(chars, refs).min()), float(js_distance(words, self.words).min()) if by_words else 0.0,
                min(max(CHAR_MOST, floor), floor + CHAR_SLOPE / max(1, chars.sum())) ** 0.5,
                min(WORD_MOST, WORD_FLOOR + WORD_SLOPE / max(1, words.sum())) ** 0.5)

    def keeps(self, far: tuple[float, float, float, float]) -> bool:
        return far[0] <= far[2] and far[1] <= far[3]


def quality(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, the base counts, both distances (rounded to 6 places),
    ``base_failed`` and ``kept``."""
    refs = language_references(docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text().alias("text"), language().alias("lang"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, char_distance double, word_distance double, base_failed boolean, kept boolean")

    def make():
        judge = Judge(refs)

        def fn(batch):
            cols: list[list] = [[] for _ in range(9)]
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                m = measure(text)
                failed = base_fails(m[0], m[4])
                far = judge.distances(text, lang)
                for c, v in zip(cols, (*m, round(far[0], 6), round(far[1], 6), failed,
                                       not failed and judge.keeps(far))):
                    c.append(v)
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols)], names=[
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "char_distance", "word_distance", "base_failed", "kept"])
        return fn

    return arrow_map(rows, out, make)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were."""
    refs = language_references(docs)
    at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    def make():
        judge = Judge(refs)

        def good(text, lang):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            return not base_fails(len(words), repeat_words(words)) and judge.keeps(
                judge.distances(text, "" if lang is None else str(lang)))

        def fn(batch):
            rows = zip(batch.column(at).to_pylist(), batch.column(lang_at).to_pylist())
            return batch.filter(pa.array([good(*r) for r in rows], pa.bool_()))
        return fn

    return arrow_map(docs, docs.schema, make)
