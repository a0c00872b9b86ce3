"""Scalar column helpers; all are native Spark expressions."""

from tagstream.functions.scalars import (
    EPOCH_NTZ,
    bit_to_bool,
    bool_to_number,
    clock_mod,
    epoch_ms_to_ts,
    exact_mean,
    fmt_decimals,
    hhmmss,
    mean_to_cents,
    micros,
    now_ms,
    safe_double,
    safe_long,
    trim_all,
    truncating_scale,
    ts_to_epoch_ms,
    whitespace_tokens,
)
from tagstream.functions.format import (area_report_line, log_report_line, mean_report_line,  # noqa: F401
                                         sensor_report_line)
