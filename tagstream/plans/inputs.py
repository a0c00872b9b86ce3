"""Derived inputs: the driver tables re-shaped into the wire formats the
operators consume (line protocol, log lines, JSON messages, text lines).

Every row of the source table is carried through; a deterministic rule
corrupts some rows so the reject paths see real traffic.  The rules are
functions of ``event_id`` only, so the oracle SQL rebuilds the same inputs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.scalars import epoch_ms_to_ts, ts_to_epoch_ms
from tagstream.sources.tables import deal_text, events_as_readings, read_table, spread
from tagstream.sources.text import split_lines


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_readings(events(spark, sf))


def sensor_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``ts_ms|sensor|value|unit`` per event (value with 3 decimals)."""
    return sensor_lines_from(events(spark, sf))


def sensor_lines_from(e: DataFrame) -> DataFrame:
    """``sensor_lines`` over any events DataFrame (batch or stream)."""
    ms = ts_to_epoch_ms("ts").cast("string")
    val = F.format_string("%.3f", F.col("value"))
    unit = F.concat(F.lit("u_"), F.col("event_type"))
    i = F.col("event_id")
    line = (F.when(i % 17 == 0, F.concat_ws("|", ms, "event_type", F.lit("n/a"), unit))
            .when(i % 29 == 0, F.concat_ws("|", ms, "event_type", val, unit, F.lit("x")))
            .when(i % 31 == 0, F.concat_ws("|", F.concat(F.lit("T"), ms), "event_type", val, unit))
            .otherwise(F.concat_ws("|", ms, "event_type", val, unit)))
    return e.select(F.col("event_id").alias("seq"), line.alias("value"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``LEVEL | ts_ms | Message no. <id>`` per event."""
    return log_lines_from(events(spark, sf))


def log_lines_from(e: DataFrame) -> DataFrame:
    """``log_lines`` over any events DataFrame (batch or stream)."""
    ms = ts_to_epoch_ms("ts").cast("string")
    level = (F.when(F.col("event_type") == "error", "ERROR")
             .when(F.col("event_type") == "signup", "WARN").otherwise("INFO"))
    msg = F.concat(F.lit("Message no. "), F.col("event_id").cast("string"))
    i = F.col("event_id")
    line = (F.when(i % 17 == 0, F.concat_ws(" | ", level, F.lit("x"), msg))
            .when(i % 29 == 0, F.concat_ws(" | ", level, ms))
            .otherwise(F.concat_ws(" | ", level, ms, msg)))
    return e.select(F.col("event_id").alias("seq"), line.alias("value"))


def json_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON readings in the two producer shapes (by user parity), with some
    malformed messages."""
    return json_messages_from(events(spark, sf))


def json_messages_from(e: DataFrame) -> DataFrame:
    """``json_messages`` over any events DataFrame (batch or stream)."""
    ms = ts_to_epoch_ms("ts")
    area = F.concat(F.lit("line_"), (F.col("user_id") % 2 + 1).cast("string"))
    shape_a = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), area.alias("area"),
                                 F.col("value"), ms.alias("timestamp")))
    shape_b = F.to_json(F.struct(ms.alias("timestamp"), F.upper("event_type").alias("sensor"),
                                 F.col("value"), F.lit(1).alias("count")))
    msg = (F.when(F.col("event_id") % 19 == 0,
                  F.concat(F.lit("{bad "), F.col("event_id").cast("string")))
           .when(F.col("user_id") % 2 == 0, shape_a).otherwise(shape_b))
    return e.select(F.col("event_id").alias("seq"), msg.alias("value"))


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document: ``doc_id, line_no, line``."""
    return split_lines(spread(read_table(spark, sf, "documents").select("doc_id", "text")), "text", "doc_id")


def doc_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts (``doc_id, text``).  Tokenising whole texts
    gives the same tokens as tokenising their lines (a newline is
    whitespace) without exploding lines first."""
    return spread(read_table(spark, sf, "documents").select("doc_id", "text"))


def write_growing(lines: DataFrame, folder: str) -> None:
    """Write lines (columns file_no, ord, value) to the files of a folder that
    a stream follows: a task writes a file's lines in order and puts the file in
    place of its shorter former self, so a retried task changes nothing."""
    from tagstream.sources.growing import _store

    def run(batches):
        out, at, temp = None, None, None

        def done():
            out.close()
            store.move(temp, f"{root}/part-{at:05d}.log")

        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != at:
                    if out is not None:
                        done()
                    at, temp = number, f"{root}/.{number}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                out.write(value.encode("utf-8") + b"\n")
        if out is not None:
            done()
        yield from ()

    rows = lines.repartition("file_no").sortWithinPartitions("file_no", "ord").select("file_no", "value")
    rows.mapInArrow(run, "done int").write.format("noop").mode("overwrite").save()


def with_arrival(df: DataFrame, ts_ms: str, seq: str) -> DataFrame:
    """Adds ``ingest_ts``: rows arrive up to 96 seconds after their event
    time, by a fixed rule on ``seq`` (a live stream stamps the clock)."""
    return df.withColumn("ingest_ts", epoch_ms_to_ts(F.col(ts_ms) + F.col(seq) % 97 * 1000))


def doc_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_texts`` with ``ingest_ts``: one document arrives each second."""
    return doc_texts(spark, sf).withColumn("ingest_ts", epoch_ms_to_ts(F.col("doc_id") * 1000))


def dealt_arrivals(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """``doc_arrivals`` in tasks of bounded text, and how many they are."""
    docs, tasks = deal_text(read_table(spark, sf, "documents").select("doc_id", "text"), "text")
    return docs.withColumn("ingest_ts", epoch_ms_to_ts(F.col("doc_id") * 1000)), tasks
