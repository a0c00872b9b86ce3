"""Follow files that grow: appended lines arrive once.

``growing_lines`` is a Python streaming source whose offsets are (file, byte).
A poll lists the files and finds how far whole lines reach; a batch's partitions
are byte ranges, and tasks read the lines that begin inside theirs.  No line
passes the driver.

- A line counts once its newline is written; a file's last, unfinished line
  waits.
- ``max_lines`` caps the lines of a batch over all files, in name order.
- A restarted query goes on at its checkpoint's offset: the engine plans the
  last batch of its log once more, which tells the reader where it stands.
- A file that shrank, or whose first bytes differ from those it had, was
  written anew: it is read from its begin (its generation in the offset grows).
- An offset has one entry per file.  For many files that don't grow,
  ``read_text_stream`` is the source to use.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that a range holds at most (plus the rest of its last line).
RANGE_BYTES = 64 << 20
_BLOCK = 1 << 20
#: First bytes by which a file is known again.
_HEAD = 64


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def list_files(path: str) -> list[tuple[str, int]]:
    """(name, bytes) of a file, or of the files of a folder without those
    whose names begin with ``.`` or ``_``, in name order.  A path that does
    not exist yet has none."""
    store, at = _store(path)
    info = store.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [(info.base_name, info.size)]
    if info.type == pafs.FileType.NotFound:
        return []
    found = store.get_file_info(pafs.FileSelector(at))
    return sorted((f.base_name, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._")


def _open(path: str, name: str):
    store, at = _store(path)
    if store.get_file_info(at).type != pafs.FileType.File:
        at = f"{at.rstrip('/')}/{name}"
    return store.open_input_file(at)


def _head(f, size: int) -> int:
    f.seek(0)
    return zlib.crc32(f.read(min(_HEAD, size)))


def _whole_lines(f, begin: int, size: int, most: int | None) -> tuple[int, int]:
    """(end, lines): where the whole lines from ``begin`` end, at most
    ``most`` of them.  Without a cap only the file's last block is read and
    the lines aren't counted."""
    if most is None:
        at = size
        while at > begin:
            low = max(begin, at - _BLOCK)
            f.seek(low)
            cut = f.read(at - low).rfind(b"\n")
            if cut >= 0:
                return low + cut + 1, 0
            at = low
        return begin, 0
    at, end, lines = begin, begin, 0
    while at < size and lines < most:
        f.seek(at)
        block = f.read(min(_BLOCK, size - at))
        n = block.count(b"\n")
        if lines + n > most:
            cut = -1
            for _ in range(most - lines):
                cut = block.index(b"\n", cut + 1)
            return at + cut + 1, most
        if n:
            end, lines = at + block.rfind(b"\n") + 1, lines + n
        at += len(block)
    return end, lines


class ByteRange(InputPartition):
    """The lines of a file that begin in [begin, end); whole lines reach to
    ``stop``.  ``at_line``: a line begins at ``begin``."""

    def __init__(self, file: str, gen: int, begin: int, end: int, stop: int, at_line: bool):
        self.file, self.gen, self.begin, self.end, self.stop, self.at_line = file, gen, begin, end, stop, at_line


class RangeReader(DataSourceStreamReader):
    """Polls the files on the driver; tasks read byte ranges."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.most = int(options["max_lines"]) if options.get("max_lines") else None
        self.range_bytes = int(options.get("range_bytes") or RANGE_BYTES)
        self.position: dict | None = None  # the offset that was handed out last

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """As far as whole lines reach, at most ``max_lines`` further."""
        end, left = dict(self.position or {}), self.most
        for name, size in list_files(self.path):
            if left == 0:
                break
            at = json.loads(end[name]) if name in end else {"byte": 0, "head": 0, "gen": 0}
            with _open(self.path, name) as f:
                if size < at["byte"] or (at["byte"] and _head(f, at["byte"]) != at["head"]):
                    at = {"byte": 0, "head": 0, "gen": at["gen"] + 1}
                stop, lines = _whole_lines(f, at["byte"], size, left)
                if stop > at["byte"]:
                    end[name] = json.dumps({"byte": stop, "head": _head(f, stop), "gen": at["gen"]})
            if left is not None:
                left -= lines
        self.position = end
        return end

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        if self.position is None:  # restarted: the engine plans the last batch of its log again
            self.position = end
        out = []
        for name in sorted(end):
            to = json.loads(end[name])
            at = json.loads(start[name]) if name in start else {"byte": 0, "gen": 0}
            begin = at["byte"] if at["gen"] == to["gen"] else 0
            out += [ByteRange(name, to["gen"], low, min(low + self.range_bytes, to["byte"]), to["byte"], low == begin)
                    for low in range(begin, to["byte"], self.range_bytes)]
        return out

    def commit(self, end: dict) -> None:
        if self.position is None:
            self.position = end

    def read(self, r: ByteRange) -> Iterator[pa.RecordBatch]:
        at, values, size = [], [], 0

        def out():
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([r.file] * n, pa.string()), pa.array([r.gen] * n, pa.int32()), pa.array(at, pa.int64()),
                 pa.array(values, pa.string())], names=["file", "gen", "byte", "value"])

        with _open(self.path, r.file) as f:
            for byte, line in _lines(f, r.begin, r.end, r.stop, r.at_line):
                at.append(byte)
                values.append(line.decode("utf-8", "replace"))
                size += len(line)
                if len(at) >= 10_000 or size > 8 << 20:
                    yield out()
                    at, values, size = [], [], 0
        if at:
            yield out()


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "file string, gen int, byte long, value string"

    def streamReader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def _lines(f, begin: int, end: int, stop: int, at_line: bool) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that begin in [begin, end); all whole lines
    end by ``stop``."""
    at, rest = begin, b""
    if not at_line:  # the line that runs into the range belongs to the one before
        at -= 1
        skip = True
    else:
        skip = False
    first = at
    while at < stop:
        f.seek(at)
        block = f.read(min(_BLOCK, stop - at))
        if not block:
            raise EOFError(f"file ends at byte {at}, before {stop}: it was cut while it was read")
        at += len(block)
        parts = (rest + block).split(b"\n")
        rest = parts.pop()
        for line in parts:
            if skip:
                skip = False
            elif first >= end:
                return
            else:
                yield first, line
            first += len(line) + 1
        if not skip and first >= end:
            return


def follow_lines(spark: SparkSession, path: str, max_lines: int | None = None,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Stream of the lines appended to a file, or to the files of a folder:
    file, gen (times the file was written anew), byte (where the line begins),
    value.  Bytes that aren't UTF-8 are replaced."""
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format("growing_lines").option("path", path).option("range_bytes", range_bytes)
    if max_lines:
        reader = reader.option("max_lines", max_lines)
    return reader.load()


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over growing files until all that is there has been read,
    batch after batch, and return all output so far.  (A trigger that stops at
    the end of input would read one capped batch only.)  A later call with the
    same checkpoint goes on where this one stopped."""
    from tagstream.streaming.runner import run_to_files

    return run_to_files(stream, path, checkpoint, trigger={"processingTime": "0 seconds"})
