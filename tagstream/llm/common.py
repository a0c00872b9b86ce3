"""Helpers shared by the operators: sliced Arrow maps, shared files, digests."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a Python task turns into Python objects at a time.
SLICE_ROWS = 128


def arrow_map(df: DataFrame, schema: T.StructType | str,
              make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]]) -> DataFrame:
    """``mapInArrow`` in slices of ``SLICE_ROWS`` rows.

    ``make()`` runs once per task and returns the function applied to each
    slice, so per-task set-up (an automaton, a tokenizer) happens once and the
    Python objects alive at a time are bounded by one slice, not by an Arrow
    batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                if fn is None:
                    fn = make()
                out = fn(batch.slice(at, SLICE_ROWS))
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of Python columns (lists or arrays) under ``schema``."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)


def whole_text(name: str = "text"):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# ---------------------------------------------------------------- files ----

def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named by URI or plain path, and the path
    in it.  Works for any store that pyarrow reaches (file, hdfs, s3, gs)."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return pafs.LocalFileSystem(), urlparse(uri).path
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def attempt_name(stem: str, suffix: str) -> str:
    """A file name no other task attempt uses.  Readers take names from the
    manifest that the successful attempt returned, so files of lost or
    speculative attempts are never read."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def map_file(uri: str):
    """The bytes of a shared file: memory-mapped where the store is mounted,
    read into memory otherwise."""
    store, path = filesystem(uri)
    if isinstance(store, pafs.LocalFileSystem):
        return pa.memory_map(path, "r").read_buffer()
    with store.open_input_file(path) as f:  # as the bytes are, whatever the name's ending
        return f.read_buffer()


def make_folder(uri: str) -> str:
    store, path = filesystem(uri)
    store.create_dir(path, recursive=True)
    return uri.rstrip("/")


def input_tasks(df: DataFrame, rows: int) -> DataFrame:
    """One row per task, for small frames whose every row is a file."""
    return df.repartition(max(1, rows))


def per_block(rows: DataFrame, n_blocks: int, order: list[str], write: Callable[[pa.Table], str]) -> list[tuple[int, str]]:
    """Call ``write(table)`` with the rows of every block (column ``block``,
    of bounded size), sorted, in a task; the (block, file name) pairs.  Only
    the names that successful attempts return count."""
    names = rows.columns
    dealt = rows.repartition(n_blocks, "block").sortWithinPartitions("block", *order)

    def run(batches):
        held, block = [], None

        def done():
            return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                               "file": [write(pa.Table.from_batches(held))]})

        for batch in batches:
            ids = batch.column(names.index("block")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and ids[a] != block:
                    yield done()
                    held = []
                block = int(ids[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    return sorted((r["block"], r["file"]) for r in dealt.mapInArrow(run, "block int, file string").collect())
