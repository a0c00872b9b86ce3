"""MinHash near-duplicates with odd sketches.

1. A text's set of hashed word shingles gets a MinHash signature (for the
   bands) and an odd sketch: a bitmap in which each (sample, value) of the
   signature flips one bit.  The XOR of two sketches keeps only the samples
   that differ, so its population count estimates high similarities closely.
2. Documents with equal sets form one class; only its smallest id, the
   representative, goes on.  Copies never make pairs.
3. Representatives that share a band bucket are candidates.  First each is
   compared with one partner, the smallest id in any of its buckets; what is
   linked already needs no further pairs.  Next, in buckets that still hold
   several components, members are compared with the bucket's smallest member;
   last, members outside its component with the members of other components, a
   pair only in the first bucket that both share.  Every pair must pass the
   sketch before full sets are compared, and only links on full sets count.
   In the last step, where a large group of half-similar texts would pass the
   first sketch in numbers that grow with its square, pairs must also pass a
   finer odd sketch of one-permutation MinHash samples (one minimum per bin of
   the hash range), which tells 0.8 from 0.7; it is built only for members of
   buckets still open.
4. Connected components of classes and links give the groups.

Copies are classes and near copies are linked through the smallest member, so
linked groups make no pairs among themselves.  The last step compares the members
of a bucket that are not yet in its component with the others of the bucket: for
groups of half-similar, unlinked texts that is a comparison of each such pair by
sketch.  Sets of candidates are fetched by join, never collected.

Recall: with 36 bands of 5 rows a pair at similarity 0.8 shares a bucket with
probability 1 - (1 - 0.8^5)^36 > 0.999999.  The sketch passes pairs whose
estimate is at least ``SKETCH_FLOOR`` (five standard errors of its samples under
0.8, about 4.1 with the collisions of its bitmap: a simulated pair at exactly 0.8
fails 3 times in 100,000), the finer one those of at least ``FINE_FLOOR`` (about
4.5 standard errors).  Such a pair is lost unless others link it.

Defined cases: null texts and texts without words have the empty set and are
linked with nothing; a text with fewer words than a shingle has one shingle of
all its words; rows that share an id are one document (where their texts
differ, the one with the largest set digest counts); rows without an id are
linked with nothing; ties go to the smallest id; an
empty table gives an empty result; other columns are ignored or, in the
filter, carried untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import arrow_map, whole_text
from tagstream.llm.components import components
from tagstream.session import materialize

BANDS, ROWS = 36, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Least similarity estimate that is compared on full sets.
SKETCH_FLOOR = 0.64
#: The finer sketch: bins of the hash range with one minimum each, and bits.
FINE_BINS, FINE_BITS = 1024, 2048
#: Least estimate of it, five standard errors under 0.8: where at most a third
#: of the bins are filled (nearly every shingle is a sample), and elsewhere.
FINE_FLOOR_SPARSE, FINE_FLOOR = 0.75, 0.73
#: Words whose hashes a task keeps at a time.
CACHE_WORDS = 1_000_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mix(np.arange(1, SAMPLES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_OFFSETS = _mix(np.arange(SAMPLES + 1, 2 * SAMPLES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


class Shingler:
    """Hashed shingle sets; word hashes are kept from text to text."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles."""
        ws = text.encode("utf-8", "surrogatepass").lower().split()
        if not ws:
            return np.zeros(0, _U)
        known = self.known
        try:
            ids = [known[w] for w in ws]
        except KeyError:
            if len(known) > CACHE_WORDS:
                known.clear()
            for w in ws:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            ids = [known[w] for w in ws]
        h = np.array(ids, _U)
        k = min(self.words, len(ws))
        n = len(h) - k + 1
        out = np.full(n, k, _U)
        for at in range(k):
            out = _mix(out + h[at:at + n])
        return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One minimum per sample over a non-empty set."""
    out = np.full(SAMPLES, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(hashes), 512):
        some = hashes[at:at + 512]
        values = np.multiply.outer(_SEEDS, some)
        values += _OFFSETS[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band, different between bands."""
    key = np.arange(1, BANDS + 1, dtype=_U)
    for column in sig.reshape(BANDS, ROWS).T:
        key = _mix(key + column)
    return key.view(np.int64)


def odd_sketch(sig: np.ndarray) -> np.ndarray:
    """Parity bitmap of (sample, value) as ``SKETCH_BITS / 64`` words."""
    return _bitmap(np.bincount((_mix(sig ^ _SEEDS) % _U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1)


def fine_sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmap of the minimum in each bin, and the bitmap of bins that
    are not empty, of a non-empty set."""
    x = np.sort(_mix(hashes ^ _OFFSETS[0]))
    bins, at = np.unique(x // _U(2 ** 64 // FINE_BINS), return_index=True)
    bit = (_mix(x[at] + _SEEDS[0]) % _U(FINE_BITS)).astype(np.int64)
    return (_bitmap(np.bincount(bit, minlength=FINE_BITS) & 1),
            _bitmap(np.bincount(bins.astype(np.int64), minlength=FINE_BINS)))


def _bitmap(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def max_difference(floor: float) -> int:
    """Bits that may differ at an estimated similarity of at least ``floor``:
    of 2(1 - J) x samples flips, this many bits are odd on average."""
    flips = 2 * SAMPLES * (1 - floor)
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips))


def features(docs: DataFrame, words: int, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, set digest (two words), bands, sketch per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text().alias("text"))
    out = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def make():
        shingler = Shingler(words)

        def fn(batch):
            cols: list[list] = [[] for _ in range(5)]
            for text in batch.column(1).to_pylist():
                h = shingler.hashes(text)
                if len(h):
                    digest = set_digest(h)
                    sig = signature(h)
                    row = (len(h), int(digest[0]), int(digest[1]), band_keys(sig), odd_sketch(sig))
                else:
                    row = (0, None, None, None, None)
                for c, v in zip(cols, row):
                    c.append(v)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:]))], schema=schema)
        return fn

    return arrow_map(rows, out, make)


def set_digest(hashes: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)


def one_per_id(rows: DataFrame) -> DataFrame:
    """One feature row per id (rows without an id all stay)."""
    named = rows.where("doc_id is not null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows
    rest = [c for c in rows.columns if c != "doc_id"]
    order = ["d1", "d2", *(c for c in rest if c not in ("d1", "d2"))]
    best = named.groupBy("doc_id").agg(F.max(F.struct(*order)).alias("r")).select("doc_id", "r.*")
    return materialize(best.select(rows.columns).unionByName(rows.where("doc_id is null")), "dup-one")


def of_sets(wanted: DataFrame, docs: DataFrame, words: int, id_col: str, names: list[str], derive) -> DataFrame:
    """``derive``'s long arrays of the full shingle sets of ``wanted`` (id and
    set digest d1, d2): the texts are fetched by a semi join, their sets built
    again.  Columns doc_id and ``names``."""
    texts = docs.join(wanted.select(F.col("id").alias("_w")), docs[id_col] == F.col("_w"), "left_semi")
    rows = texts.select(F.col(id_col).cast("long").alias("doc_id"), whole_text().alias("text"))
    arrays = pa.list_(pa.int64())

    def make():
        shingler = Shingler(words)

        def fn(batch):
            sets = [shingler.hashes(t) for t in batch.column(1).to_pylist()]
            digests = [set_digest(h) for h in sets]
            made = list(zip(*(derive(h) for h in sets)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(d[0]) for d in digests], pa.int64()),
                 pa.array([int(d[1]) for d in digests], pa.int64()), *(pa.array(m, arrays) for m in made)],
                names=["doc_id", "d1", "d2", *names])
        return fn

    out = arrow_map(rows, "doc_id long, d1 long, d2 long, " + ", ".join(f"{n} array<long>" for n in names), make)
    out = out.join(wanted.select(F.col("id").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"], "left_semi")
    return out.dropDuplicates(["doc_id"]).select("doc_id", *names)


def differing_bits(a: str, b: str):
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))


def _count(a: str, b: str, op):
    """Bits set in two bitmaps of longs combined by ``op``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(op(x, y))), F.lit(0), lambda n, x: n + x)


def finely_close(parity_a: str, parity_b: str, bins_a: str, bins_b: str):
    """Do the finer sketches estimate a similarity of the floor or more?

    The odd bits give the number of samples that differ; with the numbers of
    bins that either or both sets fill, that gives the share of equal ones."""
    odd = _count(parity_a, parity_b, lambda x, y: x.bitwiseXOR(y))
    filled = _count(bins_a, bins_b, lambda x, y: x.bitwiseOR(y))
    samples = filled + _count(bins_a, bins_b, lambda x, y: x.bitwiseAND(y))
    # equal = (samples - differing) / 2 >= floor * filled, as a bound of odd bits
    floor = F.when(filled <= FINE_BINS // 3, FINE_FLOOR_SPARSE).otherwise(FINE_FLOOR)
    most = samples - 2 * floor * filled
    return (most >= 0) & (odd <= FINE_BITS / 2 * (1 - F.pow(F.lit(1 - 2 / FINE_BITS), most)))


def close_sizes(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b"))
    both = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    union = F.size("items_a") + F.size("items_b") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def _links(pairs: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int, id_col: str,
           name: str) -> DataFrame:
    """Verify candidate pairs on the full sets of their documents."""
    pairs = materialize(pairs, f"{name}-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = wanted.join(reps.select("id", "d1", "d2"), "id")
    sets = of_sets(wanted, docs, words, id_col, ["items"], lambda h: (h.view(np.int64),))
    sets = materialize(sets, f"{name}-sets")
    return materialize(verified(pairs, sets, percent), f"{name}-links")


def groups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col), F.col("text"))
    rows = one_per_id(materialize(features(docs, words, id_col), "dup-features"))
    full = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = full.join(classes.where("n > 1"), ["d1", "d2"]).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    reps = full.join(copies.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_anti")
    reps = materialize(reps.select(F.col("doc_id").alias("id"), "n_shingles", "d1", "d2", "bands", "sketch"),
                       "dup-reps")
    copies = materialize(copies, "dup-copies")

    keyed = reps.select(F.posexplode("bands").alias("band", "key"), "id")
    buckets = materialize(keyed.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("last"))
                          .where(F.col("last") != F.col("center")).select("key", "center"), "dup-buckets")
    facts = reps.select("id", "n_shingles", "sketch", "bands")
    # each member sees its bucket's smallest member and that one's sketch
    centers = buckets.join(facts.select(F.col("id").alias("center"), F.col("n_shingles").alias("nb"),
                                        F.col("sketch").alias("sb")), "center")
    in_buckets = materialize(keyed.join(centers, "key"), "dup-members")

    fa = facts.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    near = close_sizes("na", "nb", percent) & (differing_bits("sa", "sb") <= max_difference(SKETCH_FLOOR))

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Links among (a, b, nb, sb): the sketch decides inside the join."""
        return _links(pairs.join(fa, "a").where(near).select("a", "b"), reps, docs, words, percent, id_col, name)

    def as_edges(label: DataFrame) -> DataFrame:
        return label.select(F.col("vertex").alias("a"), F.col("component").alias("b"))

    # one partner for each: the smallest id in any of its buckets
    partners = in_buckets.where(F.col("id") != F.col("center")).groupBy("id").agg(
        F.min(F.struct("center", "nb", "sb")).alias("partner"))
    partners = materialize(partners.select(F.col("id").alias("a"), F.col("partner.center").alias("b"),
                                           "partner.nb", "partner.sb"), "dup-partners")
    found = materialize(components(linked(partners, "dup-first")), "dup-found-1")

    # the smallest member of buckets that are still in several parts
    def parts(label: DataFrame) -> DataFrame:
        own = label.select(F.col("vertex").alias("id"), "component")
        of_center = label.select(F.col("vertex").alias("center"), F.col("component").alias("center_component"))
        part = in_buckets.join(own, "id", "left").join(of_center, "center", "left")
        return part.withColumn("component", F.coalesce("component", "id")).withColumn(
            "center_component", F.coalesce("center_component", "center"))

    stars = parts(found).where("component <> center_component").groupBy(
        F.col("id").alias("a"), F.col("center").alias("b")).agg(F.min(F.struct("nb", "sb")).alias("f"))
    stars = stars.select("a", "b", "f.nb", "f.sb").join(partners.select("a", "b"), ["a", "b"], "left_anti")
    stars = linked(stars, "dup-star")
    found = materialize(components(as_edges(found).unionByName(stars)), "dup-found-2")

    # what lies outside the smallest member's component, with the others
    part = parts(found).withColumn("outside", F.col("component") != F.col("center_component"))
    open_keys = part.where("outside").select("key").distinct()
    members = part.drop("nb", "sb").join(open_keys, "key", "left_semi")
    wanted = members.select("id").distinct().join(reps.select("id", "d1", "d2"), "id")
    fine = of_sets(wanted, docs, words, id_col, ["parity", "bins"], fine_sketch).withColumnRenamed("doc_id", "id")
    members = materialize(members.join(facts.join(fine, "id"), "id"), "dup-open")
    x = members.select("key", "band", "center", F.col("id").alias("a"), F.col("component").alias("ca"),
                       F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"),
                       F.col("bands").alias("ba"), F.col("parity").alias("pa"),
                       F.col("bins").alias("fa")).where("outside")
    y = members.select(F.col("key").alias("_k"), F.col("id").alias("b"), F.col("component").alias("cb"),
                       F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"), F.col("bands").alias("bb"),
                       F.col("parity").alias("pb"), F.col("bins").alias("fb"), F.col("outside").alias("ob"))
    # band keys differ between bands: equal keys among the bands before this
    # one mean that the pair is met there
    first = ~F.arrays_overlap(F.slice("ba", F.lit(1), F.col("band")), F.slice("bb", F.lit(1), F.col("band")))
    rest = x.join(y, (x["key"] == y["_k"]) & (F.col("ca") != F.col("cb")) & (F.col("b") != F.col("center"))
                  & (~F.col("ob") | (F.col("a") < F.col("b"))) & near & first
                  & finely_close("pa", "pb", "fa", "fb")).select("a", "b").distinct()
    more = _links(rest, reps, docs, words, percent, id_col, "dup-rest")

    edges = as_edges(found).unionByName(more)
    label = components(edges.unionByName(copies)).select(F.col("vertex").alias("doc_id"), "component")
    out = rows.select("doc_id", "n_shingles").join(label, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that a smaller id of their group
    stands for."""
    gone = groups(docs, words, percent, id_col).where("not kept").select(F.col("doc_id").alias("_gone"))
    gone = materialize(gone, "dup-gone")
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")
