"""Console output: grids for batch results, the console sink for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame


def show_grid(df: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows as a grid, values untruncated."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    """Print every micro-batch (development only)."""
    w = (df.writeStream.format("console").option("truncate", "false")
         .option("checkpointLocation", checkpoint).outputMode(mode))
    return w.trigger(**(trigger or {"availableNow": True})).start()
