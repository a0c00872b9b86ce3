"""Keyed state on streams: running totals, ordered folds, arrival windows.

All of it is ``transformWithStateInPandas`` on the RocksDB state store: state
lies on the executors' disks, is checkpointed with the stream, and a batch
reads the state of the keys it has.  State is keyed by (key, bucket of the
order), so a hot key's rows are dealt over many tasks and a task sorts one
bucket of one micro-batch at a time; what buckets hold is put together when
the result is read.  (Names of columns that processors read must not begin
with an underscore: the rows' Python form renames those.)
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tagstream.operators.folds import compose, halving
from tagstream.operators.running import seq_bucket
from tagstream.streaming.runner import run_to_files, run_updates

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, with the changes
    of each batch (not the whole state) written to the checkpoint."""
    settings = {"spark.sql.streaming.stateStore.providerClass": _PROVIDER,
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ------------------------------------------------------- running totals ----

class RunningTotal(StatefulProcessor):
    """A row per reading with the total of its (key, bucket) so far."""

    def __init__(self, names: list[str]):
        self.names = names  # key, bucket, seq, value, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        k, bucket, seq, value, out = self.names
        total = self.total.get()[0] if self.total.exists() else 0.0
        batch = pd.concat(list(rows), ignore_index=True).sort_values(seq, kind="stable")
        run = batch[value].fillna(0.0).cumsum() + total
        self.total.update((float(run.iloc[-1]),))
        yield pd.DataFrame({k: key[0], bucket: key[1], seq: batch[seq], value: batch[value], out: run})

    def close(self) -> None:
        pass


def running_sum_batches(stream: DataFrame, key: str, seq: str, value: str, base: str, checkpoint: str,
                        width: int = 1 << 16, out: str = "running_total", trigger: dict | None = None) -> DataFrame:
    """Per-record running totals of a stream (a keyed reduce's output): one
    row ``key, seq, value, out`` per input row, in the order of ``seq``.

    State holds one total per (key, ``seq div width``).  Rows come out with
    the total inside their bucket; once the input is drained, the totals of
    earlier buckets (one row per bucket) are added.  ``seq`` must not go back
    from batch to batch, as in any log; null values add nothing."""
    rows = stream.select(stream[key].cast("string").alias(key), seq_bucket(stream[seq], width).alias("tg_bucket"),
                         stream[seq].cast("long").alias(seq), stream[value].cast("double").alias(value))
    schema = f"{key} string, tg_bucket long, {seq} long, {value} double, {out} double"
    totals = rows.groupBy(key, "tg_bucket").transformWithStateInPandas(
        RunningTotal([key, "tg_bucket", seq, value, out]), schema, "append", "none")
    with rocksdb_state(stream.sparkSession):
        done = run_to_files(totals, f"{base}/out", checkpoint, trigger=trigger)
    per_bucket = done.groupBy(key, "tg_bucket").agg(F.sum(value).alias("tg_sum"))
    before = Window.partitionBy(key).orderBy("tg_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(F.col(key).alias("tg_k"), F.col("tg_bucket").alias("tg_b"),
                                F.coalesce(F.sum("tg_sum").over(before), F.lit(0.0)).alias("tg_off"))
    joined = done.join(offsets, done[key].eqNullSafe(offsets["tg_k"]) & done["tg_bucket"].eqNullSafe(offsets["tg_b"]))
    return joined.select(key, seq, value, (F.col("tg_off") + F.col(out)).alias(out))


# --------------------------------------------------------- ordered folds ----

class AffineState(StatefulProcessor):
    """The compositions of the sub-buckets' affine maps of one key and span of
    time, continued from batch to batch: a row per sub-bucket that changed.
    With ``size_us`` (event time), readings of windows that the watermark has
    passed are dropped, and the state goes when it passes the span's end."""

    def __init__(self, keys: list[str], first: list[str], span_us: int, size_us: int | None):
        self.keys, self.first, self.span_us, self.size_us = keys, first, span_us, size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        heads = "".join(f", f{i} array<string>" for i in range(len(self.first)))
        self.state = handle.getValueState("maps", "ws array<long>, sub array<long>, a array<double>, add array<double>, "
                                          f"n array<long>, top array<long>, v array<double>{heads}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        if self.size_us is not None:
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            batch = batch[batch["tg_ws_us"] + self.size_us > passed]
            if not len(batch):
                return
        batch = batch.sort_values(["tg_ws_us", "tg_sub_us", "tg_top", "tg_seq"], kind="stable")
        stored = self.state.get() if self.state.exists() else None
        if stored is None and self.size_us is not None:
            self.handle.registerTimer((int(key[-1]) + self.span_us) // 1000)
        maps = {(r[0], r[1]): r for r in zip(*stored)} if stored is not None else {}
        ws, sub, top, a, add, v = (batch[c].to_numpy() for c in ("tg_ws_us", "tg_sub_us", "tg_top", "tg_a", "tg_add", "tg_v"))
        heads = [batch[c].to_numpy() for c in self.first]
        cuts = np.flatnonzero(np.concatenate([[True], (ws[1:] != ws[:-1]) | (sub[1:] != sub[:-1]), [True]]))
        changed = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = lo + np.flatnonzero(~np.isnan(v[lo:hi]))
            later = np.append(np.cumprod(a[at][::-1])[::-1][1:], 1.0) if len(at) else a[at]
            a_all, add_all, n = float(np.prod(a[at])), float((add[at] * later).sum()), len(at)
            head = (float(v[at[0]]), *[_text(h[at[0]]) for h in heads]) if n else (None,) * (1 + len(heads))
            highest = int(top[lo:hi].max())
            place = (int(ws[lo]), int(sub[lo]))
            old = maps.get(place)
            if old is not None:
                a_all, add_all, n, highest = old[2] * a_all, old[3] * a_all + add_all, old[4] + n, max(old[5], highest)
                head = tuple(old[6:]) if old[4] else head
            maps[place] = (*place, a_all, add_all, n, highest, *head)
            changed.append(maps[place])
        self.state.update(tuple(list(c) for c in zip(*maps.values())))
        cols = list(zip(*changed))
        yield pd.DataFrame({**{c: [k] * len(changed) for c, k in zip(self.keys, key)},
                            **dict(zip(["tg_ws_us", "tg_sub_us", "tg_a", "tg_add", "tg_n", "tg_top", "tg_v", *self.first], cols))})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def _text(x):
    return None if x is None or x != x else str(x)


def _micros(ts: Column, like) -> Column:
    """Epoch microseconds of a timestamp or timestamp_ntz, whatever the time zone."""
    if like.typeName() == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts)
    return F.unix_micros(ts)


def affine_fold_stream(stream: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str,
                       step: tuple[Column, Column], size: str, sub_bucket: str, base: str, checkpoint: str,
                       first: Sequence[str] = (), out: str = "fold", lateness: str | None = None,
                       trigger: dict | None = None, span: str = "1 day") -> DataFrame:
    """``operators.folds.affine_fold`` per key and tumbling window of a stream,
    continued across micro-batches: ``keys, window_start, fold, cnt, max_ts,
    first_<name>``.

    State is keyed by (keys, ``span`` of time) and holds a map per window and
    sub-bucket of the span; a group of a batch costs some milliseconds, so a span
    holds several windows, and a hot key wants a shorter one.  Readings of one
    batch are folded by ``(ts, seq)``, batches in arrival order.  With ``lateness``,
    windows that end at or before the watermark (largest time seen less
    ``lateness``) are final: their state goes, their results stay, and rows
    that arrive for them are dropped.  Rows without a time are in no window."""
    spark, keys, first = stream.sparkSession, list(keys), list(first)
    kind = stream.schema[ts].dataType
    a, b = step
    rows = stream.select(
        *[F.col(k).cast("string").alias(k) for k in keys], _micros(F.col(ts), kind).alias("tg_top"),
        F.col(seq).cast("long").alias("tg_seq"),
        F.when(F.col(value).isNotNull(), a).cast("double").alias("tg_a"),
        F.when(F.col(value).isNotNull(), b).cast("double").alias("tg_add"),
        F.col(value).cast("double").alias("tg_v"), *[F.col(c).cast("string").alias(f"tg_f_{c}") for c in first])
    group, places = [*keys, "tg_span_us"], ["tg_ws_us", "tg_sub_us"]
    rows = rows.where(F.col("tg_top").isNotNull())
    for name, of, width in (("tg_ws_us", "tg_top", size), ("tg_sub_us", "tg_top", sub_bucket), ("tg_span_us", "tg_ws_us", span)):
        rows = rows.withColumn(name, F.col(of) - F.pmod(F.col(of), F.lit(_interval_us(width))))
    until, mode = None, "none"
    cols = [*group, *places, "tg_top", "tg_seq", "tg_a", "tg_add", "tg_v", *[f"tg_f_{c}" for c in first]]
    if lateness is not None:
        rows = rows.withColumn("tg_ets", F.timestamp_micros("tg_top")).withWatermark("tg_ets", lateness)
        until, mode = _interval_us(size), "eventTime"
        cols.append("tg_ets")
    heads = [f"tg_f_{c}" for c in first]
    schema = ", ".join([*[f"{k} string" for k in keys], "tg_ws_us long", "tg_sub_us long", "tg_a double",
                        "tg_add double", "tg_n long", "tg_top long", "tg_v double", *[f"{h} string" for h in heads]])
    # a span ends where its last window does
    ends = _interval_us(span) + _interval_us(size)
    subs = rows.select(*cols).groupBy(*group).transformWithStateInPandas(
        AffineState(keys, heads, ends, until), schema, "update", mode)
    with rocksdb_state(spark):
        done = run_updates(subs, [*keys, *places], f"{base}/out", checkpoint, trigger)
    done = done.withColumn("tg_first", F.struct("tg_v", *heads)).withColumnRenamed("tg_top", "tg_max")
    g = compose(done, [*keys, "tg_ws_us"], [F.col("tg_sub_us")], out, "max_ts", first)

    def back(c: str) -> Column:
        if kind.typeName() == "timestamp_ntz":
            return F.timestamp_add("MICROSECOND", F.col(c), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
        return F.timestamp_micros(c)

    return g.select(*keys, back("tg_ws_us").alias("window_start"), out, "cnt", back("max_ts").alias("max_ts"),
                    *[f"first_{c}" for c in first])


def _interval_us(size: str) -> int:
    from tagstream.operators.windows import _seconds
    return int(_seconds(size) * 1_000_000)


def pairwise_avg_batches(stream: DataFrame, keys: list[str], ts: str, seq: str, value: str, unit: str, size: str,
                         sub_bucket: str, base: str, checkpoint: str, trigger: dict | None = None,
                         lateness: str | None = None) -> DataFrame:
    """The ordered ``acc = (acc + v) / 2`` window fold on a stream: ``keys,
    window_start, pairwise_avg, cnt, max_ts, first_unit``."""
    got = affine_fold_stream(stream, keys, ts, seq, value, halving(value), size, sub_bucket, base, checkpoint, [unit],
                             "pairwise_avg", lateness, trigger)
    return got.withColumnRenamed(f"first_{unit}", "first_unit")


# ------------------------------------------------------- arrival windows ----

class ArrivalWindow(StatefulProcessor):
    """Count, sum, largest time and first row of a key's processing-time
    window.  A timer closes the window at its end, whether or not rows come;
    rows that arrive in the gap before the next window belong to none."""

    def __init__(self, key: str, size_ms: int, slide_ms: int):
        self.key, self.size, self.slide = key, size_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "start long, cnt long, total double, top long, head string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now // self.slide * self.slide
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["tg_ts", "tg_seq"], kind="stable")
        old = self.state.get() if self.state.exists() else None
        if old is not None and old[0] != start:  # ended, but its timer has not fired yet
            self.handle.deleteTimer(old[0] + self.size)
            self.state.clear()
            yield self._row(key, old)
            old = None
        if now >= start + self.size:
            return
        n, total, top = len(batch), float(batch["tg_value"].fillna(0.0).sum()), int(batch["tg_ts"].max())
        if old is None:
            self.handle.registerTimer(start + self.size)
            self.state.update((start, n, total, top, _text(batch["tg_head"].iloc[0])))
        else:
            self.state.update((start, old[1] + n, old[2] + total, max(old[3], top), old[4]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            old = self.state.get()
            if old[0] + self.size <= expiredTimerInfo.getExpiryTimeInMs():
                yield self._row(key, old)
                self.state.clear()

    def _row(self, key, s) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]], "window_ms": [s[0]], "cnt": [s[1]], "total": [s[2]], "max_ts": [s[3]],
                             "first_head": [s[4]]})

    def close(self) -> None:
        pass


def arrival_windows(stream: DataFrame, key: str, ts: str, seq: str, value: str, head: str, size_ms: int,
                    slide_ms: int | None = None) -> DataFrame:
    """Tumbling processing-time windows of a live stream: key, window_ms (its
    begin), cnt, total of ``value``, max_ts of ``ts`` (a number), first_head.
    A window comes out once the clock passes its end, with or without new data
    (start the query inside ``rocksdb_state``, append mode).

    With a ``slide_ms`` above the size, windows begin every slide, and rows that
    arrive in the gap belong to none.  Rows of one window count in the order of
    their batches.  Results depend on arrival; ``windows.tumbling`` over an
    arrival-time column is the form that can be repeated."""
    rows = stream.select(F.col(key).cast("string").alias(key), F.col(ts).cast("long").alias("tg_ts"),
                         F.col(seq).cast("long").alias("tg_seq"), F.col(value).cast("double").alias("tg_value"),
                         F.col(head).cast("string").alias("tg_head"))
    return rows.groupBy(key).transformWithStateInPandas(
        ArrivalWindow(key, size_ms, max(size_ms, slide_ms or 0)), f"{key} string, window_ms long, cnt long, total double, max_ts long, first_head string", "append",
        "processingTime")
