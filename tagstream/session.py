"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tagstream", cpus: int | str = "*",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session with the settings the library is tuned for.

    On a cluster, submit with the cluster's own master and leave these to
    ``spark-defaults.conf``; the values here only suit ``local[N]`` runs.
    """
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def recommended_conf(input_bytes: int, total_cores: int,
                     input_per_partition: int = 1 << 30,
                     advisory_partition_bytes: int = 256 << 20,
                     max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes`` on a
    cluster with ``total_cores`` executor cores.

    The initial shuffle partition count is ~1 GB of *input* per partition
    (shuffles carry far less after pruning and map-side partial
    aggregation), at least three per core, capped at ``max_partitions`` so
    map-output tracking stays small.  AQE then coalesces partitions to
    ~256 MB and splits skewed ones at runtime.  Scans split files at 256 MB.
    At 100 TB on 8,000 cores: 100,000 initial partitions."""
    parts = max(total_cores * 3, -(-int(input_bytes) // input_per_partition))
    parts = min(parts, max(max_partitions, total_cores * 3))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(advisory_partition_bytes * 2),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables: the
    session's ``spark.checkpoint.dir`` (or the context's checkpoint folder).

    Where none is set, a ``local[N]`` session -- one machine, one process --
    gets a folder in its warehouse; on a cluster that is an error, since a
    folder of one machine is not shared."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{spark.sparkContext.applicationId}"
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/tagstream/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``, in whatever store it lies?  Errors of
    the store are raised, not taken for an absent path."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` as parquet under the shared folder and read it back.

    Used before multi-pass algorithms over an expensive derived input (e.g.
    metrics computed from whole texts): the source is read and the
    derivation runs once, later passes read the small columnar result, and
    the lineage is cut (a lost executor recomputes from the files, not from
    the raw input)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)
