"""Report-line formatting (pipe-joined text lines) as Column expressions.

The line texts are fixed values: they must equal what the jobs print."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagstream.functions.scalars import hhmmss


def sensor_report_line(sensor="sensor", avg="avg_value", unit="unit",
                       count="cnt", ts="max_ts") -> Column:
    """``Sensor: s | Avg: 12.34 unit | Count: n | Window: HH:MM:SS``."""
    return F.format_string(
        "Sensor: %s | Avg: %.2f %s | Count: %d | Window: %s",
        F.col(sensor), F.col(avg), F.col(unit), F.col(count), hhmmss(F.col(ts)))


def area_report_line(area="area", sensor="first_sensor", avg="avg_value",
                     count="cnt", ts_ms="max_ts_ms") -> Column:
    """``area | sensor | Avg. Value: 12.34 | Count: n | Ts: ms``; pass an
    average already rounded to cents so the text is exact."""
    return F.format_string(
        "%s | %s | Avg. Value: %.2f | Count: %d | Ts: %d",
        F.col(area), F.col(sensor), F.col(avg), F.col(count), F.col(ts_ms))


def mean_report_line(ts_ms="max_ts_ms", sensor="sensor", avg="avg_value", count="cnt") -> Column:
    """``ms | Sensor: s | Avg Value: 12.34 | Count: n``; pass an average
    already rounded to cents so the text is exact."""
    return F.format_string("%d | Sensor: %s | Avg Value: %.2f | Count: %d", F.col(ts_ms), F.col(sensor),
                           F.col(avg), F.col(count))


def log_report_line(level="level", count="cnt", ts_ms="max_ts_ms") -> Column:
    """``LEVEL | Count: n | TS: ms``."""
    return F.format_string("%s | Count: %d | TS: %d", F.col(level), F.col(count), F.col(ts_ms))
