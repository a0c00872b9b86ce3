"""Dictionary-compressed WARC archives.

Every archive file starts with a skippable frame that holds a Zstandard
dictionary built from archived records; after it, each record is a frame of its
own, compressed with that dictionary, so any record can be read alone.

Records with equal payloads of at least ``MIN_REVISIT_BYTES`` are stored once:
the one with the largest page id is the response, the others revisit it.
Groups are found on (digest, id) alone; a payload is shuffled only if Spark
must join it with a table of groups too large to broadcast.

The dictionary is built from a bounded, documented sample of records
(``SAMPLE_RECORDS`` of the smallest id hashes, at most ``SAMPLE_BYTES``); it
affects size only.  Where there are too few records to build one, files have a
skippable frame of length zero.

Only files that the manifest names belong to the archive, so a lost or
speculative task leaves no wrong record.

Defined cases: a null page is an empty payload; a null url is an empty target;
rows that share an id and a payload agree (all responses or all revisits);
a null id never is revisited and its record stays a response; an empty table
gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import attempt_name, filesystem, input_tasks, make_folder, map_file
from tagstream.session import materialize, scratch_path

MIN_REVISIT_BYTES = 1000
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
WARC_DATE = "2000-01-01T00:00:00Z"
# The frame's magic number and the profile of equal payloads.
SKIPPABLE_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, n_records long"


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def digest_text(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def make_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, which states the
    payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_uri(page_id)), ("WARC-Date", WARC_DATE),
              ("WARC-Target-URI", "".join(c for c in url if c not in "\r\n")),
              ("WARC-Payload-Digest", digest_text(hashlib.sha1(payload).digest()))]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_uri(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, rest[:size]


def skippable(data: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE_MAGIC, len(data)) + data


def read_archive(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive file, from its bytes alone."""
    view = memoryview(data)
    magic, size = struct.unpack_from("<II", view)
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    at = 8 + size
    dictionary = zstandard.ZstdCompressionDict(bytes(view[8:at])) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        d = reader.decompressobj()
        out = []
        start = at
        while not d.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            out.append(d.decompress(view[at:at + (1 << 16)]))
            at += 1 << 16
        at = min(at, len(view)) - len(d.unused_data)
        if at <= start:
            raise ValueError("empty frame")
        yield parse_record(b"".join(out))


def build_dictionary(pages: DataFrame) -> bytes:
    """Dictionary of a bounded sample; empty where it can't be built."""
    share = SAMPLE_BYTES // SAMPLE_RECORDS
    # ids first (a narrow scan), then only their rows; long pages give their
    # first part to the sample, the archive takes all of every page
    ids = pages.where("page_id is not null").select("page_id").orderBy(F.xxhash64("page_id")).limit(SAMPLE_RECORDS)
    chosen = pages.where(F.col("page_id").isin([r[0] for r in ids.collect()]))
    some = chosen.select("page_id", "url", F.expr(f"left(html, {share})").alias("html")).limit(SAMPLE_RECORDS)
    samples = [make_record(r["page_id"], r["url"] or "", (r["html"] or "").encode(), None) for r in some.collect()]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES) -> str:
    """Write all pages; the archive's folder."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    dictionary = build_dictionary(rows)
    folder = make_folder(scratch_path(spark, "warc"))
    keyed = rows.where(F.octet_length("html") >= min_revisit).select(
        F.sha1(F.col("html").cast("binary")).alias("digest"), "page_id")
    groups = keyed.where("page_id is not null").groupBy("digest").agg(
        F.max("page_id").alias("response"), F.min("page_id").alias("least")).where("least <> response")
    groups = materialize(groups.select("digest", "response"), "warc-groups")
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_revisit,
                                            F.sha1(F.col("html").cast("binary"))))
    rows = rows.join(groups, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("response") != F.col("page_id"), F.col("response")).alias("refers_to"))

    def run(batches):
        out, n = None, 0
        name = attempt_name("part", ".warc.zst")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                if out is None:
                    store, path = filesystem(folder)
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(skippable(dictionary))
                    used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
                    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=used)
                for r in batch.slice(at, 64).to_pylist():
                    record = make_record(r["page_id"], r["url"] or "", r["html"].encode("utf-8", "surrogatepass"),
                                         r["refers_to"])
                    out.write(writer.compress(record))
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n]})

    rows.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Per record, from the files: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url."""
    files = spark.read.parquet(f"{folder}/manifest")
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url string")
    fields_schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                               ("payload_digest", pa.string()), ("record_type", pa.string()),
                               ("refers_to", pa.int64()), ("url", pa.string())])

    def page_of(uri: str) -> int | None:
        number = uri.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def row(fields: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(head.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
        stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
        if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).digest()) != (size, stated):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
        to = fields.get("WARC-Refers-To")
        return (page_of(fields["WARC-Record-ID"]), size, stated.hex(), fields["WARC-Type"],
                page_of(to) if to else None, fields["WARC-Target-URI"])

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for fields, block in read_archive(map_file(f"{folder}/{name}")):
                    rows.append(row(fields, block))
                    if len(rows) == 2048:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), fields_schema)], schema=fields_schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), fields_schema)], schema=fields_schema)

    return input_tasks(files.select("file"), files.count()).mapInArrow(run, schema)
