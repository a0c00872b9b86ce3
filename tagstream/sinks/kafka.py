"""Kafka adapter: JSON encode/decode of message values.

The Kafka connector is not bundled with PySpark; ``read``/``write`` need the
``spark-sql-kafka`` package on the classpath.  Decoding and encoding work on
any DataFrame with Kafka's columns (``key, value, topic, partition, offset,
timestamp``), so they are tested with a file source of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
         group_id: str | None = None, stream: bool = True) -> DataFrame:
    """Subscribe to a topic; ``starting`` is ``earliest`` or ``latest``.
    Offsets are tracked in the stream's checkpoint, not by the group."""
    r = spark.readStream if stream else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load()


def values(kafka_df: DataFrame) -> DataFrame:
    """UTF-8 message values as ``value`` with the offset as ``seq``."""
    return kafka_df.select(F.col("value").cast("string").alias("value"),
                           F.col("offset").cast("long").alias("seq"),
                           F.col("partition"), F.col("timestamp").alias("kafka_ts"))


def encode(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows -> ``key, value`` with value the JSON of all columns."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Publish ``key, value`` rows (batch or stream)."""
    if df.isStreaming:
        return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None
