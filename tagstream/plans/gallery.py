"""The query gallery: every operator bound to the driver's tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over whole tables.  Column
names match the oracle SQL in ``tagstream.plans.oracle``.  Numeric outputs
that two engines could round differently are made exact: sums of readings are
decimals with 6 places, means one division of them, and the pairwise fold is reported in fixed point (``*_milli``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream import schemas as S
from tagstream.functions import format as fmt
from tagstream.functions.scalars import (bit_to_bool, bool_to_number, clock_mod, epoch_ms_to_ts,
                                         exact_mean, hhmmss, mean_to_cents, micros, trim_all, truncating_scale, ts_to_epoch_ms)
from tagstream.operators import aggregate as agg
from tagstream.operators import folds as FO
from tagstream.operators import joins as J
from tagstream.operators import parse as P
from tagstream.operators import running as R
from tagstream.operators import tables as TB
from tagstream.operators import telemetry as TM
from tagstream.operators import text as TX
from tagstream.operators import topk as TK
from tagstream.operators import windows as W
from tagstream.plans import inputs as I
from tagstream.session import materialize, scratch_path
from tagstream.sinks import files as FS
from tagstream.sinks import kafka as KF
from tagstream.sinks.catalog import create_table
from tagstream.sources.growing import drain, follow_lines
from tagstream.sources.tables import events_as_readings, read_table, stream_table
from tagstream.sources.text import split_lines
from tagstream.streaming import dedupe as DD
from tagstream.streaming import runner as RN
from tagstream.streaming import stateful as ST

Query = Callable[[SparkSession, str], DataFrame]
GALLERY: dict[str, Query] = {}


def q(name: str):
    def deco(fn: Query) -> Query:
        GALLERY[name] = fn
        return fn
    return deco


def _with_mean(g: DataFrame) -> DataFrame:
    """Replace ``_sum`` (an exact decimal) by ``avg_value``, the mean."""
    cols = [c for c in g.columns if c != "_sum"]
    idx = cols.index("cnt")
    out = [F.col(c) for c in cols]
    out.insert(idx, exact_mean("_sum", "cnt").alias("avg_value"))
    return g.select(*out)


def _dec(c) -> F.Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


# --------------------------------------------------------------------------
# Windows
# --------------------------------------------------------------------------

@q("tumbling_avg")
def tumbling_avg(spark, sf):
    """W-02: mean per sensor and 1-hour tumbling window (flagship)."""
    r = I.readings(spark, sf)
    return _with_mean(W.tumbling(r, ["sensor"], "ts", "1 hour", [
        F.sum(micros("value")).alias("_sum"),
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
    ]))


@q("tumbling_pairwise_avg")
def tumbling_pairwise_avg(spark, sf):
    """W-01: the ordered ``(acc + v) / 2`` fold per sensor and hour."""
    r = I.readings(spark, sf)
    out = W.pairwise_avg(r, ["sensor"], "ts", "seq", "value", "1 hour", "10 seconds", unit="unit")
    return out.select("sensor", "window_start", "window_end",
                      F.floor(F.col("pairwise_avg") * 1000 + F.lit(0.3137)).cast("bigint")
                      .alias("pairwise_avg_milli"),
                      "max_ts", "cnt", "first_unit")


@q("tumbling_sum_count_avg")
def tumbling_sum_count_avg(spark, sf):
    """W-03: per sensor and 30-minute window: max ts, sum, count, mean."""
    r = I.readings(spark, sf)
    return _with_mean(W.tumbling(r, ["sensor"], "ts", "30 minutes", [
        F.max("ts").alias("max_ts"),
        F.sum(_dec("value")).cast("decimal(38,2)").alias("sum_value"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum(micros("value")).alias("_sum"),
    ]))


@q("tumbling_area_avg")
def tumbling_area_avg(spark, sf):
    """W-04 default: mean per area and hour."""
    r = I.readings(spark, sf)
    return _with_mean(W.tumbling(r, ["area"], "ts", "1 hour", [
        F.sum(micros("value")).alias("_sum"),
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
    ]))


@q("tumbling_first_over_count")
def tumbling_first_over_count(spark, sf):
    """W-04 compat: first value / count per area and hour."""
    r = I.readings(spark, sf)
    return W.first_over_count(r, ["area"], "ts", "seq", "value", "1 hour", first_cols=["sensor"])


@q("tumbling_count")
def tumbling_count(spark, sf):
    """W-05: per key and 6-hour window: sum of carried counts, max ts."""
    e = I.events(spark, sf)
    k = F.get_json_object("props", "$.k").cast("int")
    return W.tumbling(e.select("event_type", "ts", k.alias("k")), ["event_type"], "ts", "6 hours", [
        F.sum("k").alias("sum_k"),
        F.max("ts").alias("max_ts"),
    ])


@q("tumbling_log_levels")
def tumbling_log_levels(spark, sf):
    """W-06/W-07: parsed log lines per level and hour: max ts, first
    message, count."""
    logs = P.accepted(P.parse_log_lines(I.log_lines(spark, sf)))
    logs = logs.withColumn("ts", epoch_ms_to_ts("ts_ms"))
    return W.tumbling(logs, ["level"], "ts", "1 hour", [
        F.max("ts_ms").alias("max_ts_ms"),
        F.min_by("message", F.struct("ts", "seq")).alias("first_message"),
        F.count(F.lit(1)).alias("cnt"),
    ])


CLASS_RULES = [("purchase", "BUY"), ("click", "NAVIGATION"), ("view", "NAVIGATION")]


@q("tumbling_class_count")
def tumbling_class_count(spark, sf):
    """W-08: classify, then count per class and 10-minute window."""
    e = I.events(spark, sf)
    c = e.select(TX.classify("event_type", CLASS_RULES).alias("class"), "ts")
    return W.tumbling(c, ["class"], "ts", "10 minutes", [
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
    ])


@q("tumbling_word_count")
def tumbling_word_count(spark, sf):
    """W-10: count per word (event type) and 20-minute window."""
    e = I.events(spark, sf)
    return W.tumbling(e, ["event_type"], "ts", "20 minutes", [
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
    ])


@q("sliding_count")
def sliding_count(spark, sf):
    """W-11/W-14: 10-minute windows every 2 minutes, count per event type."""
    e = I.events(spark, sf)
    return W.sliding_count(e, ["event_type"], "ts", "10 minutes", "2 minutes")


@q("hopping_gapped")
def hopping_gapped(spark, sf):
    """W-12/W-13: 2-minute windows every 5 minutes (rows in gaps dropped)."""
    e = I.events(spark, sf)
    return W.hopping_gapped(e, ["event_type"], "ts", "2 minutes", "5 minutes", [
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
    ])


@q("ingest_mean_report")
def ingest_mean_report(spark, sf):
    """W-03/P-19: JSON readings in 30-minute windows of their arrival time
    per sensor: latest event time, count, mean as one report line."""
    r = P.accepted(P.parse_json_readings(I.json_messages(spark, sf)))
    g = W.tumbling(I.with_arrival(r, "ts_ms", "seq"), ["sensor"], "ingest_ts", "30 minutes", [
        F.max("ts_ms").alias("max_ts_ms"), F.sum(micros("value_num")).alias("_sum"),
        F.count(F.lit(1)).alias("cnt")])
    g = g.withColumn("avg_value", mean_to_cents("_sum", "cnt"))
    return g.select("sensor", "window_start", fmt.mean_report_line().alias("line"))


@q("ingest_log_report")
def ingest_log_report(spark, sf):
    """W-06/P-19: log lines in 30-minute windows of their arrival time per
    level: count and latest event time as one report line."""
    logs = P.accepted(P.parse_log_lines(I.log_lines(spark, sf)))
    g = W.tumbling(I.with_arrival(logs, "ts_ms", "seq"), ["level"], "ingest_ts", "30 minutes", [
        F.max("ts_ms").alias("max_ts_ms"), F.count(F.lit(1)).alias("cnt")])
    return g.select("level", "window_start", fmt.log_report_line().alias("line"))


@q("ingest_word_count")
def ingest_word_count(spark, sf):
    """W-09/W-10: count per word and 5-minute window of arrival time."""
    docs, _ = I.dealt_arrivals(spark, sf)
    return W.tumbling(_timed_words(docs), ["word"], "ingest_ts", "5 minutes", [
        F.sum("n").alias("cnt")])


@q("ingest_word_sliding")
def ingest_word_sliding(spark, sf):
    """W-11: count per word in 10-minute windows of arrival time every 5."""
    docs, tasks = I.dealt_arrivals(spark, sf)
    return W.sliding_count(_timed_words(docs), ["word"], "ingest_ts", "10 minutes", "5 minutes", tasks=tasks)


@q("event_time")
def event_time(spark, sf):
    """T-01: epoch-ms field -> event-time column."""
    e = I.events(spark, sf).select("event_id", ts_to_epoch_ms("ts").alias("ts_ms"))
    return W.event_time(e, "ts_ms", "ms", out="event_ts")


# --------------------------------------------------------------------------
# Reductions and running totals
# --------------------------------------------------------------------------

@q("keyed_sum")
def keyed_sum(spark, sf):
    """A-02: final sum per user."""
    e = I.events(spark, sf)
    out = agg.keyed_sum(e, ["user_id"], _dec("value"), out="total")
    return out.withColumn("total", F.col("total").cast("decimal(38,2)"))


@q("running_sum")
def running_sum(spark, sf):
    """A-01: running total per sensor in event order (one row per event)."""
    r = I.readings(spark, sf).select("seq", "sensor", "value")
    # Buckets of 65,536 events: a sensor with 3e11 rows has 5e6 bucket rows
    # to prefix in one task, which is cheap; beyond ~1e7 buckets per key pass
    # ``coarse`` to prefix the bucket offsets in blocks as well.
    out = R.running_sum(r, ["sensor"], _dec("value"), ["seq"], R.seq_bucket("seq", 1 << 16))
    return out.withColumn("running_total", F.col("running_total").cast("decimal(38,2)"))


@q("row_count")
def row_count(spark, sf):
    """A-05/S-11: row count of a table."""
    return agg.row_count(I.events(spark, sf))


@q("global_line_stats")
def global_line_stats(spark, sf):
    """A-04/P-17: average characters and words per line, line count."""
    return TX.global_line_stats(TX.line_metrics(I.doc_lines(spark, sf)))


@q("running_global_stats")
def running_global_stats(spark, sf):
    """A-04 running: after each line (document order), the running means."""
    # The prefix reads its input twice; read the texts once and keep the
    # four-number metrics per line.
    m = materialize(TX.line_metrics(I.doc_lines(spark, sf), keep=["doc_id", "line_no"]), "line_metrics")
    # Buckets: (document, block of 4096 lines); their offsets are summed one
    # level up over blocks of 4096 documents, so no task sees every bucket.
    bucket = F.struct("doc_id", F.floor(F.col("line_no") / 4096).alias("b"))
    out = R.running_global_means(m, {"chars": F.col("n_chars"), "words": F.col("n_words")},
                                 ["doc_id", "line_no"], bucket, count_col="n_lines",
                                 coarse=lambda b: F.floor(b["doc_id"] / 4096))
    return out.select("doc_id", "line_no", "n_lines", "avg_chars", "avg_words")


# --------------------------------------------------------------------------
# Text
# --------------------------------------------------------------------------

@q("text_lines")
def text_lines(spark, sf):
    """S-03: every line of every document."""
    return I.doc_lines(spark, sf)


@q("line_metrics")
def line_metrics(spark, sf):
    """P-16: characters and words per line."""
    return TX.line_metrics(I.doc_lines(spark, sf), keep=["doc_id", "line_no"])


@q("word_tokens")
def word_tokens(spark, sf):
    """P-10/P-12: lower-cased tokens longer than 2 characters, in place."""
    d = I.doc_lines(spark, sf)
    return TX.words(d, "line", keep=["doc_id", "line_no"], min_len=2, with_pos=True)


@q("word_count")
def word_count(spark, sf):
    """A-03/P-13: count of each token longer than 2 characters."""
    w = TX.words(I.doc_texts(spark, sf), "text", min_len=2)
    return TX.word_count(w)


def _words_with_ingest(spark, sf):
    return _timed_words(I.doc_arrivals(spark, sf))


def _timed_words(docs):
    return TX.words(docs, "text", keep=["doc_id", "ingest_ts"], min_len=2).select(
        "doc_id", "word", F.lit(1).alias("n"), "ingest_ts")


@q("words_with_ingest")
def words_with_ingest(spark, sf):
    """P-12: (word, 1, arrival time) of each token longer than 2 characters."""
    return _words_with_ingest(spark, sf)


STOP_WORDS = ["the", "and", "for", "that", "with"]


@q("stopword_filter")
def stopword_filter(spark, sf):
    """P-14: word counts with a stop list removed."""
    w = TX.words(I.doc_texts(spark, sf), "text", min_len=2)
    return TX.word_count(TX.drop_words(w, STOP_WORDS))


@q("classify_lines")
def classify_lines(spark, sf):
    """P-15: class of each line by ordered substring rules."""
    d = I.doc_lines(spark, sf)
    return d.select("doc_id", "line_no", TX.classify("line").alias("class"))


@q("distinct_lines")
def distinct_lines(spark, sf):
    """T-06: each distinct stripped, non-blank line once."""
    return TX.distinct_lines(I.doc_lines(spark, sf))


# --------------------------------------------------------------------------
# Parsing
# --------------------------------------------------------------------------

@q("parse_lines")
def parse_lines(spark, sf):
    """P-03/S-09: accepted sensor lines."""
    ok = P.accepted(P.parse_sensor_lines(I.sensor_lines(spark, sf)))
    return ok.select("seq", "ts_ms", "sensor", F.col("value_num").alias("value"), "unit", "n")


@q("parse_rejects")
def parse_rejects(spark, sf):
    """P-11: rejected sensor lines with the reason."""
    return P.rejected(P.parse_sensor_lines(I.sensor_lines(spark, sf)), keep=("seq",))


@q("parse_logs")
def parse_logs(spark, sf):
    """P-04: accepted log lines."""
    ok = P.accepted(P.parse_log_lines(I.log_lines(spark, sf)))
    return ok.select("seq", "level", "ts_ms", "message", "n")


@q("parse_rejects_logs")
def parse_rejects_logs(spark, sf):
    """P-11: rejected log lines with the reason."""
    return P.rejected(P.parse_log_lines(I.log_lines(spark, sf)), keep=("seq",))


@q("parse_rejects_json")
def parse_rejects_json(spark, sf):
    """P-11: rejected JSON messages with the reason."""
    return P.rejected(P.parse_json_readings(I.json_messages(spark, sf)), keep=("seq",))


@q("parse_json")
def parse_json(spark, sf):
    """P-05/P-06: JSON readings of both shapes in one schema."""
    ok = P.accepted(P.parse_json_readings(I.json_messages(spark, sf)))
    return ok.select("seq", "sensor", "area", F.col("value_num").alias("value"), "ts_ms", "count")


@q("format_report")
def format_report(spark, sf):
    """P-19: one text line per sensor and hour, mean rounded to cents from the
    exact decimal sum."""
    r = I.readings(spark, sf)
    g = W.tumbling(r, ["sensor"], "ts", "1 hour", [
        F.sum(micros("value")).alias("_sum"),
        F.count(F.lit(1)).alias("cnt"),
        F.max("ts").alias("max_ts"),
        F.first("unit").alias("unit"),
    ])
    g = g.withColumn("avg_value", mean_to_cents("_sum", "cnt"))
    return g.select("sensor", "window_start",
                    fmt.sensor_report_line("sensor", "avg_value", "unit", "cnt", "max_ts").alias("line"))


# --------------------------------------------------------------------------
# Projection, filter, recode
# --------------------------------------------------------------------------

@q("filter_project")
def filter_project(spark, sf):
    """P-01/P-02: threshold filter and narrow projection (pushed into the scan)."""
    e = I.events(spark, sf)
    return e.where(F.col("value") > 40).select("event_id", "user_id", "value")


@q("conditional_recode")
def conditional_recode(spark, sf):
    """P-09: rename one key value, keep the rest."""
    e = I.events(spark, sf)
    return e.select("event_id", F.when(F.col("event_type") == "signup", "register")
                    .otherwise(F.col("event_type")).alias("event_type"), "value")


@q("db_row_projection")
def db_row_projection(spark, sf):
    """P-08: parsed JSON reading -> sink row (area, sensor_id, raw value as
    avg_value, count 1, ts); a reading without an area keeps a null."""
    ok = P.accepted(P.parse_json_readings(I.json_messages(spark, sf)))
    return ok.select(
        "seq", "area", F.col("sensor").alias("sensor_id"),
        F.col("value_num").cast("double").alias("avg_value"),
        F.lit(1).alias("cnt"), F.col("ts_ms").cast("long").alias("ts"))


@q("encode_json")
def encode_json(spark, sf):
    """K-09: record -> JSON text (the producer's message value)."""
    r = I.readings(spark, sf)
    body = F.to_json(F.struct(F.col("sensor").alias("sensor_id"), "area", "value",
                              ts_to_epoch_ms("ts").alias("timestamp")))
    return r.select("seq", F.col("sensor").alias("key"), body.alias("value"))


# --------------------------------------------------------------------------
# Joins and top-k
# --------------------------------------------------------------------------


def _report_inputs(spark, sf):
    """readings := orders, oee := lineitem (many per order), locations :=
    supplier (keyed by supplier key)."""
    readings = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sensor"), F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("unit"), F.col("o_orderdate").alias("record_time"))
    oee = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sensor_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("up_time"), F.col("l_suppkey").alias("location"))
    locations = read_table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("location_code"), F.col("s_name").alias("site_name"),
        F.col("s_nationkey").alias("address_number"))
    return readings, oee, locations


@q("left_join_fanout")
def left_join_fanout(spark, sf):
    """J-01: readings LEFT JOIN oee -- every match kept, unmatched -> NULLs."""
    readings, oee, _ = _report_inputs(spark, sf)
    j = J.left_join(readings, oee, "sensor", "sensor_id", hot_right_keys=True)
    return j.select("sensor", "record_time", "value", "line", "up_time", "location")


@q("left_join_chain")
def left_join_chain(spark, sf):
    """J-02: oee LEFT JOIN locations LEFT JOIN nation (size-checked broadcasts)."""
    _, oee, locations = _report_inputs(spark, sf)
    nation = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = J.left_join(oee, locations, "location", "location_code", broadcast_max_rows=J.DIM_MAX_ROWS)
    j = J.left_join(j, nation, "address_number", "n_nationkey", broadcast_max_rows=J.DIM_MAX_ROWS)
    return j.select("sensor_id", "line", "location", "site_name", "address_number", "n_name")


@q("report_top6")
def report_top6(spark, sf):
    """J-03/O-02/S-10: the 3-table report, newest 6 rows."""
    readings, oee, locations = _report_inputs(spark, sf)
    out = J.latest_report(
        readings, oee, locations, "sensor", "sensor_id", "location", "location_code",
        reading_order=[F.col("record_time").desc(), F.col("sensor").desc()],
        tie_order=[F.col("line").asc_nulls_first()], n=6)
    return out.select("sensor", "location", "site_name", "address_number", "value", "unit",
                      "up_time", "record_time")


@q("top_words")
def top_words(spark, sf):
    """O-01: the 25 most frequent tokens (ties by word)."""
    wc = TX.word_count(TX.words(I.doc_texts(spark, sf), "text", min_len=2))
    return TK.top_n(wc, [F.col("cnt").desc(), F.col("word").asc()], 25)


@q("top_words_sql")
def top_words_sql(spark, sf):
    """O-03: the same leaderboard as SQL over a registered view."""
    wc = TX.word_count(TX.words(I.doc_texts(spark, sf), "text", min_len=2))
    return TK.sql_over_view(wc, "SELECT word, cnt FROM {view} ORDER BY cnt DESC, word ASC LIMIT 25")


@q("tail_n")
def tail_n(spark, sf):
    """O-04: the last 10 lines of the text (document order)."""
    return TK.tail_n(I.doc_lines(spark, sf), ["doc_id", "line_no"], 10)


@q("top_n_per_key")
def top_n_per_key(spark, sf):
    """O-04 per key: the 3 largest readings of each sensor (salted, exact)."""
    r = I.readings(spark, sf).select("sensor", "seq", "value")
    return TK.top_n_per_key(r, ["sensor"], [F.col("value").desc(), F.col("seq").asc()], 3)


# --------------------------------------------------------------------------
# Table maintenance and constraints
# --------------------------------------------------------------------------

def _hourly(e):
    return e.select(F.col("event_type").alias("sensor"), F.concat(F.lit("u_"), "event_type").alias("unit"),
                    TB.decimal_fit("value").alias("value"),
                    F.window("ts", "1 hour").start.alias("record_time"), "event_id")


@q("upsert_readings")
def upsert_readings(spark, sf):
    """K-04: stored hourly readings (first reading of each hour, days 1-15)
    upserted with a replayed batch (last reading per hour, days 11-30)."""
    e = I.events(spark, sf)
    stored = TB.first_per_key(_hourly(e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))),
                              ["sensor", "record_time"], "event_id").drop("event_id")
    batch = _hourly(e.where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")))
    return TB.upsert(stored, batch, ["sensor", "record_time"], "event_id")


@q("upsert_oee")
def upsert_oee(spark, sf):
    """K-05: per (customer, order date) keep the latest order's price and
    priority: orders before 1999 upserted with orders from 1998 on."""
    o = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("sensor_id"), F.col("o_orderdate").alias("record_time"),
        F.col("o_totalprice").alias("up_time"), F.col("o_orderpriority").alias("location"), "o_orderkey")
    stored = TB.first_per_key(o.where(F.col("record_time") < F.lit("1999-01-01").cast("timestamp_ntz")),
                              ["sensor_id", "record_time"], "o_orderkey").drop("o_orderkey")
    batch = o.where(F.col("record_time") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return TB.upsert(stored, batch, ["sensor_id", "record_time"], "o_orderkey")


@q("insert_ignore")
def insert_ignore(spark, sf):
    """K-06/J-04: location-style insert-if-absent keyed by customer: the
    table of first orders before 1998 plus first orders of new customers."""
    o = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("location_code"), F.col("o_orderpriority").alias("site_name"),
        F.col("o_orderkey").alias("address_number"), "o_orderdate")
    stored = TB.first_per_key(o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                              ["location_code"], "address_number").drop("o_orderdate")
    batch = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return TB.insert_if_absent(stored, batch, ["location_code"], "address_number")


@q("pk_violations")
def pk_violations(spark, sf):
    """C-01: (event type, minute) used as a key: duplicated keys."""
    e = I.events(spark, sf).select("event_type", F.window("ts", "1 minute").start.alias("minute"))
    return TB.pk_violations(e, ["event_type", "minute"])


@q("pk_violations_single")
def pk_violations_single(spark, sf):
    """C-02: a single column used as a key (location code := customer of an
    order): duplicated keys."""
    o = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("location_code"))
    return TB.pk_violations(o, ["location_code"])


@q("default_timestamps")
def default_timestamps(spark, sf):
    """C-05: readings without a time (the signups) take the batch's stamp."""
    e = I.events(spark, sf).select("event_id", F.when(F.col("event_type") != "signup", F.col("ts")).alias("record_time"))
    return TB.stamp_batch(e, "record_time", F.lit("2024-02-01").cast("timestamp_ntz"))


@q("decimal_fit")
def decimal_fit(spark, sf):
    """C-03: prices into decimal(5,2): fitted value or NULL (reject)."""
    li = read_table(spark, sf, "lineitem")
    d = TB.decimal_fit("l_extendedprice", 5, 2)
    return li.select("l_orderkey", "l_linenumber", d.alias("price_5_2"), d.isNotNull().alias("fits"))


@q("length_check")
def length_check(spark, sf):
    """C-04: VARCHAR(40) check on page URLs."""
    p = read_table(spark, sf, "pages")
    return p.select("page_id", F.length("url").alias("url_len"), TB.length_ok("url", 40).alias("url_ok"))


# --------------------------------------------------------------------------
# Telemetry: lineitem rows as archived device polls
# --------------------------------------------------------------------------


LAYOUTS = {"water_plant": S.WATER_PLANT_REGISTERS, "tank": S.TANK_REGISTERS, "belt": S.BELT_REGISTERS}
POLL_KEYS = ["l_orderkey", "l_linenumber"]


def _device_class():
    k = F.pmod(F.col("l_suppkey"), F.lit(3))
    return F.when(k == 0, "water_plant").when(k == 1, "tank").otherwise("belt")


def _encoded(spark, sf):
    li = read_table(spark, sf, "lineitem")
    fields = [("l_quantity", 100), ("l_discount", 1000), ("l_tax", 1000), ("l_extendedprice", 0.1),
              (F.pmod("l_partkey", F.lit(1400)), 1), (clock_mod("l_shipdate"), 1)]
    keep = [*POLL_KEYS, F.col("l_suppkey").alias("device"), F.col("l_shipdate").alias("ts"),
            _device_class().alias("device_class"),
            F.array(F.col("l_returnflag") == "R", F.col("l_linestatus") == "O",
                    F.col("l_discount") > 0.05, F.col("l_quantity") > 25, F.col("l_tax") > 0.04,
                    F.col("l_returnflag") == "A", F.col("l_quantity") < 3, F.col("l_discount") < 0.09).alias("bits")]
    return TM.encode_registers(li, fields, keep)


def _short_polls(spark, sf):
    """Polls of devices that answer in part, for the rules on missing
    positions: ``line + 1`` registers and ``line + 3`` bits."""
    e = _encoded(spark, sf)
    return (e.withColumn("registers", F.slice("registers", 1, F.least(F.lit(6), F.col("l_linenumber") + 1)))
            .withColumn("bits", F.slice("bits", 1, F.least(F.lit(8), F.col("l_linenumber") + 3))))


@q("encode_registers")
def encode_registers(spark, sf):
    """R-06: values -> scaled 16-bit register array (truncating)."""
    return _encoded(spark, sf).select(*POLL_KEYS, "registers")


@q("decode_registers")
def decode_registers(spark, sf):
    """R-01/R-02/R-05: registers present in each poll, decoded by the
    poll's device map."""
    m = TM.register_map(spark, LAYOUTS)
    return TM.decode_registers(_encoded(spark, sf), m, POLL_KEYS)


@q("decode_registers_default")
def decode_registers_default(spark, sf):
    """R-03: every mapped tag, missing registers as 0 (flagged)."""
    m = TM.register_map(spark, LAYOUTS)
    return TM.decode_registers_default(_short_polls(spark, sf), m, POLL_KEYS)


@q("decode_bits")
def decode_bits(spark, sf):
    """R-04: named status booleans, missing bits False, with the number of
    bits actually read."""
    return TM.decode_bits(_short_polls(spark, sf), S.WATER_PLANT_BITS, POLL_KEYS, with_count=True)


@q("alarm_list")
def alarm_list(spark, sf):
    """R-09: active alarms per poll or "All systems normal"."""
    st = TM.decode_bits(_encoded(spark, sf), S.WATER_PLANT_BITS, POLL_KEYS)
    return TM.alarm_list(st, POLL_KEYS)


STATUS_AS = [("pump_running", "pump_status"), ("valve_open", "valve_status"), ("heater_on", "heater_status"),
             ("temp_alarm", "temp_alarm"), ("pressure_alarm", "pressure_alarm")]


def _wide_poll(spark, sf):
    """Sensors and status of each poll side by side, decoded in one pass."""
    p = _encoded(spark, sf)
    both = TM.decode_bits(TM.decode_wide(p, S.WATER_PLANT_REGISTERS[:5], [*POLL_KEYS, "bits"]),
                          S.WATER_PLANT_BITS, [*POLL_KEYS, *[t for _p, t, _d, _u in S.WATER_PLANT_REGISTERS[:5]]])
    return both.select(*POLL_KEYS, *[t for _p, t, _d, _u in S.WATER_PLANT_REGISTERS[:5]],
                       *[F.col(a).alias(b) for a, b in STATUS_AS])


@q("unpivot_readings")
def unpivot_readings(spark, sf):
    """R-07: wide poll -> ten long readings with units (bool -> 1/0)."""
    w = _wide_poll(spark, sf)
    cols = [t for t, _u in S.POLL_UNITS]
    return TM.unpivot_readings(w, POLL_KEYS, cols, dict(S.POLL_UNITS), decimals=3)


def _alarms(spark, sf, rules):
    w = _wide_poll(spark, sf)
    # Only tags that have a rule are unpivoted: the rule join cannot be
    # pushed through the unpivot, so the filter is applied by construction.
    ruled = sorted({t for t, _op, _lim, _lab in rules} & set(w.columns))
    long = TM.unpivot_readings(w, POLL_KEYS, ruled, dict(S.POLL_UNITS))
    return TM.threshold_alarms(long, spark, rules)


@q("threshold_alarms")
def threshold_alarms(spark, sf):
    """R-08: readings over their rule limits."""
    return _alarms(spark, sf, S.THRESHOLD_RULES)


@q("threshold_alarms_second")
def threshold_alarms_second(spark, sf):
    """R-08: the same readings under the second server's limits."""
    return _alarms(spark, sf, S.SECOND_THRESHOLD_RULES)


@q("latest_snapshot")
def latest_snapshot(spark, sf):
    """R-10: latest value of every (device, sensor)."""
    r = I.readings(spark, sf)
    return TM.latest_snapshot(r, ["device", "sensor"], ["value"], ["ts", "seq"])


@q("dashboard")
def dashboard(spark, sf):
    """R-11: per device, the latest poll's sensors and status side by side,
    with setpoints where the device has them.  Registers and bits of the
    latest poll come from one aggregation and are decoded in one pass."""
    p = _encoded(spark, sf).withColumn("_o", F.struct("ts", *POLL_KEYS, "registers", "bits"))
    last = TB.last_per_key(p.select("device", "_o", "registers", "bits"), ["device"], "_o")
    sensor_cols = [t for _p, t, _d, _u in S.WATER_PLANT_REGISTERS]
    both = TM.decode_bits(TM.decode_wide(last, S.WATER_PLANT_REGISTERS, ["device", "bits"]),
                          S.WATER_PLANT_BITS, ["device", *sensor_cols])
    sup = read_table(spark, sf, "supplier")
    sp_regs = TM.encode_registers(sup, [("s_acctbal", 1), (F.col("s_nationkey") * 100, 1),
                                        (F.pmod("s_suppkey", F.lit(1000)), 1)],
                                  [F.col("s_suppkey").alias("device")])
    setpoints = TM.decode_wide(sp_regs, S.WATER_PLANT_SETPOINTS, ["device"])
    return TM.dashboard(both, None, setpoints, "device")


EVENT_ALIASES = [("view", "page_view"), ("click", "tap")]


@q("normalize_tags")
def normalize_tags(spark, sf):
    """R-12: tag names mapped between schemes, unmapped kept."""
    e = I.events(spark, sf).select("event_id", F.col("event_type").alias("original"))
    return TM.normalize_tags(e, EVENT_ALIASES, tag_col="original", out="tag")


@q("multi_device_union")
def multi_device_union(spark, sf):
    """R-13: devices with different tag sets in one table."""
    tank = read_table(spark, sf, "supplier").select(
        F.concat(F.lit("tank_"), F.col("s_suppkey").cast("string")).alias("device"),
        F.col("s_acctbal").alias("temperature"), F.col("s_nationkey").cast("double").alias("pressure"))
    dis = read_table(spark, sf, "customer").select(
        F.concat(F.lit("disinfection_"), F.col("c_custkey").cast("string")).alias("device"),
        F.col("c_acctbal").alias("uv"), F.col("c_nationkey").cast("double").alias("chlorine"),
        F.length("c_name").cast("double").alias("turbidity"))
    return TM.union_devices([tank, dis])


@q("device_list")
def device_list(spark, sf):
    """R-14: the devices seen in the polls."""
    return TM.device_list(_encoded(spark, sf), "device")


# --------------------------------------------------------------------------
# Scalar function projections
# --------------------------------------------------------------------------


@q("scalar_text")
def scalar_text(spark, sf):
    """F-01..F-06: lower/upper, split, strip, length, substring, in-list."""
    e = I.events(spark, sf)
    k_text = trim_all(F.regexp_replace(F.split("props", ":").getItem(1), "}", ""))
    return e.select("event_id", F.lower("event_type").alias("lower_type"),
                    F.upper("event_type").alias("upper_type"),
                    F.length("props").alias("props_len"),
                    trim_all(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
                    F.col("props").contains("9").alias("has_nine"),
                    F.col("event_type").isin("click", "view").alias("in_list"),
                    k_text.alias("k_text"))


@q("scalar_numeric")
def scalar_numeric(spark, sf):
    """F-07, F-09, F-10, F-14, F-15, F-16: parse, max, rounding, bool and
    bit conversions, truncating scale."""
    li = read_table(spark, sf, "lineitem")
    return li.select(*POLL_KEYS,
                     F.col("l_quantity").cast("int").cast("string").try_cast("int").alias("qty_parsed"),
                     F.greatest("l_quantity", F.col("l_tax") * 1000).alias("max_of_two"),
                     F.round(F.col("l_discount") * 100, 0).alias("discount_pct"),
                     bool_to_number(F.col("l_returnflag") == "R").alias("returned_num"),
                     bit_to_bool(F.col("l_linenumber") % 2).alias("odd_line"),
                     truncating_scale("l_tax", 100).alias("tax_x100"))


@q("scalar_time")
def scalar_time(spark, sf):
    """F-12, F-13, F-18 and epoch ms: clock text, date-time text, 16-bit
    seconds clock."""
    e = I.events(spark, sf)
    return e.select("event_id", hhmmss("ts").alias("hhmmss"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime_text"),
                    clock_mod("ts").alias("clock16"),
                    ts_to_epoch_ms("ts").alias("ts_ms"))


# --------------------------------------------------------------------------
# Streams run to completion (availableNow) and read back
# --------------------------------------------------------------------------


@q("stream_tumbling")
def stream_tumbling(spark, sf):
    """T-02/T-07/T-09: the flagship window as a stream in update mode; the
    input is bounded and its files come in any order, so no watermark drops
    rows that the batch form keeps."""
    base = scratch_path(spark, "stream_tumbling")
    r = events_as_readings(stream_table(spark, sf, "events"))
    r = r.withColumn("ets", RN.ntz_to_instant("ts"))
    agg = r.groupBy("sensor", F.window("ets", "1 hour").alias("window")).agg(
        F.sum(micros("value")).alias("_sum"), F.count(F.lit(1)).alias("cnt"), F.max("ts").alias("max_ts"))
    res = RN.run_updates(agg, ["sensor", "window"], f"{base}/out", f"{base}/checkpoint")
    return res.select("sensor", RN.instant_to_ntz("window.start").alias("window_start"),
                      RN.instant_to_ntz("window.end").alias("window_end"),
                      exact_mean("_sum", "cnt").alias("avg_value"), "cnt", "max_ts")


@q("file_sink_roundtrip")
def file_sink_roundtrip(spark, sf):
    """K-02: parsed JSON readings formatted as text lines, streamed into a
    text file sink (exactly-once via its log) and read back."""
    base = scratch_path(spark, "file_sink")
    msgs = I.json_messages_from(stream_table(spark, sf, "events"))
    ok = P.accepted(P.parse_json_readings(msgs))
    line = F.format_string("%s | %s | Value: %.2f | Ts: %d", F.coalesce("area", F.lit("-")),
                           "sensor", "value_num", "ts_ms")
    RN.start(lambda: FS.text_stream(ok.select(line.alias("value")), f"{base}/out", f"{base}/checkpoint"), spark)
    return spark.read.text(f"{base}/out")


@q("running_sum_stream")
def running_sum_stream(spark, sf):
    """A-01 streaming: one updated total per input reading, per sensor; the
    state store keeps a total per (sensor, 4,096 readings of the sequence), so
    the rows of one sensor are dealt over all tasks."""
    base = scratch_path(spark, "running_stream")
    r = events_as_readings(stream_table(spark, sf, "events"))
    res = ST.running_sum_batches(r, "sensor", "seq", "value", base, f"{base}/checkpoint", width=1 << 12)
    return res.select("seq", "sensor", "value", F.round("running_total", 4).alias("running_total"))


@q("distinct_lines_stream")
def distinct_lines_stream(spark, sf):
    """T-06/S-04 streaming: document lines arriving as a file stream,
    stripped, blanks skipped, each distinct line emitted once (the set of lines
    seen is kept by the state store)."""
    base = scratch_path(spark, "distinct_stream")
    lines = split_lines(stream_table(spark, sf, "documents"), "text", "doc_id").withColumnRenamed("line", "value")
    d = DD.distinct_lines_stream(lines, "value")
    out = RN.run_to_files(d.select(F.col("value").alias("line")), f"{base}/out", f"{base}/checkpoint")
    return out


@q("stream_static_join")
def stream_static_join(spark, sf):
    """J-05: the events as a stream LEFT JOIN the static customer table."""
    base = scratch_path(spark, "stream_static")
    e = stream_table(spark, sf, "events").select("event_id", "user_id", "value")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = J.left_join(e, c, "user_id", "c_custkey")
    return RN.run_to_files(j.select("event_id", "user_id", "value", "c_name", "c_nationkey"),
                           f"{base}/out", f"{base}/checkpoint")


@q("kafka_json_stream")
def kafka_json_stream(spark, sf):
    """S-06/K-09/P-05 on a stream: the table stream's JSON readings in the
    columns of a Kafka source, decoded and parsed."""
    base = scratch_path(spark, "kafka_json")
    stream = _kafka_records(spark, sf)
    ok = P.accepted(P.parse_json_readings(KF.values(stream)))
    out = RN.run_to_files(ok.select("seq", "sensor", "area", F.col("value_num").alias("value"), "ts_ms", "count"),
                          f"{base}/out", f"{base}/checkpoint")
    return out


@q("running_sum_stream_batches")
def running_sum_stream_batches(spark, sf):
    """A-01 streaming over several micro-batches: the readings followed as
    lines of growing files, a capped number of lines a batch."""
    base = scratch_path(spark, "running_batches")
    lines = _followed_readings(spark, sf, f"{base}/in")
    out = ST.running_sum_batches(lines, "sensor", "seq", "value", f"{base}/data", f"{base}/checkpoint", width=1 << 12,
                                 trigger={"processingTime": "0 seconds"})
    return out.select("seq", "sensor", "value", F.round("running_total", 4).alias("running_total"))


def _reading_lines(spark, sf) -> DataFrame:
    """``seq|sensor|micros|unit|value`` per reading, in files by ranges of the
    sequence, so that files in name order are in its order."""
    r = I.readings(spark, sf)
    top = r.agg(F.max("seq")).first()[0] or 0
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    return r.select(F.floor(F.col("seq") * 8 / F.lit(top + 1)).cast("int").alias("file_no"), F.col("seq").alias("ord"),
                    F.concat_ws("|", "seq", "sensor", us.cast("string"), "unit", F.col("value").cast("string")).alias("value"))


def _read_back(lines: DataFrame) -> DataFrame:
    p = F.split("value", "\\|")
    return lines.select(p[0].cast("long").alias("seq"), p[1].alias("sensor"),
                        F.timestamp_add("MICROSECOND", p[2].cast("long"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).alias("ts"),
                        p[3].alias("unit"), p[4].cast("double").alias("value"))


def _table_name(path: str) -> str:
    """A catalog name that no other run uses."""
    return "tg_" + path.rsplit("-", 1)[-1]


def _followed_readings(spark, sf, folder: str, batches: int = 4) -> DataFrame:
    """The readings as lines of growing files, followed in about ``batches``
    micro-batches by a cap on their lines."""
    lines = _reading_lines(spark, sf)
    I.write_growing(lines, folder)
    return _read_back(follow_lines(spark, folder, max_lines=max(1, -(-lines.count() // batches))))


def _kafka_records(spark, sf):
    """The table stream's JSON readings as Kafka-shaped records."""
    msgs = I.json_messages_from(stream_table(spark, sf, "events"))
    return msgs.select(F.lit(None).cast("binary").alias("key"), F.encode("value", "UTF-8").alias("value"),
                       F.lit("readings").alias("topic"), F.lit(0).alias("partition"),
                       F.col("seq").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))


@q("area_window_report_stream")
def area_window_report_stream(spark, sf):
    """E1 end to end: Kafka-shaped JSON records -> parse -> hourly windows per
    area (``-`` where a reading has none): first sensor, count, latest ts,
    mean -> one report line each.  The bounded input is drained and every
    window returned."""
    base = scratch_path(spark, "area_report")
    parsed = P.accepted(P.parse_json_readings(KF.values(_kafka_records(spark, sf))))
    r = (parsed.withColumn("area", F.coalesce("area", F.lit("-")))
         .withColumn("ts", epoch_ms_to_ts("ts_ms"))
         .withColumn("ets", RN.ntz_to_instant("ts")))
    agg = r.groupBy("area", F.window("ets", "1 hour").alias("window")).agg(
        F.min_by("sensor", F.struct("ts_ms", "seq")).alias("first_sensor"),
        F.count(F.lit(1)).alias("cnt"), F.max("ts_ms").alias("max_ts_ms"),
        F.sum(micros("value_num")).alias("_sum"))
    done = RN.run_updates(agg, ["area", "window"], f"{base}/out", f"{base}/checkpoint")
    done = done.withColumn("avg_value", mean_to_cents("_sum", "cnt"))
    return done.select("area", RN.instant_to_ntz("window.start").alias("window_start"),
                       fmt.area_report_line().alias("line"))


@q("upsert_partitioned")
def upsert_partitioned(spark, sf):
    """K-04 at table scale: the stored hourly readings are a parquet table
    partitioned by day; the replayed batch is upserted into it, reading and
    rewriting only the days it touches.  Same result as ``upsert_readings``."""
    base = scratch_path(spark, "readings_table")
    e = I.events(spark, sf)

    def by_day(df):
        return df.withColumn("record_date", F.to_date("record_time"))

    keys = ["sensor", "record_time", "record_date"]
    stored = TB.first_per_key(by_day(_hourly(e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))),
                              keys, "event_id").drop("event_id")
    stored.hint("rebalance", "record_date").write.partitionBy("record_date").parquet(base)
    batch = by_day(_hourly(e.where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz"))))
    TB.upsert_into(base, batch, keys, "event_id", "record_date")
    return spark.read.parquet(base).select("sensor", "record_time", "unit", "value")


@q("distinct_lines_exact_stream")
def distinct_lines_exact_stream(spark, sf):
    """T-06 exact on a stream: document lines from a file stream, each
    distinct line emitted once for the whole stream; per-batch partial
    dedupe, earlier outputs as the seen set."""
    base = scratch_path(spark, "distinct_exact")
    lines = split_lines(stream_table(spark, sf, "documents"), "text", "doc_id").withColumnRenamed("line", "value")
    return DD.distinct_lines_batches(lines, f"{base}/data", f"{base}/checkpoint")


@q("log_levels_stream")
def log_levels_stream(spark, sf):
    """P-04 + W-06/W-07 as a stream: log lines followed from files, parsed
    (rejects routed out), event-time windows per level; the bounded input is
    drained and every window returned."""
    base = scratch_path(spark, "log_levels")
    logs = P.accepted(P.parse_log_lines(I.log_lines_from(stream_table(spark, sf, "events"))))
    logs = logs.withColumn("ts", epoch_ms_to_ts("ts_ms")).withColumn("ets", RN.ntz_to_instant("ts"))
    agg = logs.groupBy("level", F.window("ets", "1 hour").alias("window")).agg(
        F.max("ts_ms").alias("max_ts_ms"), F.min_by("message", F.struct("ts", "seq")).alias("first_message"),
        F.count(F.lit(1)).alias("cnt"))
    res = RN.run_updates(agg, ["level", "window"], f"{base}/out", f"{base}/checkpoint")
    return res.select("level", RN.instant_to_ntz("window.start").alias("window_start"),
                      RN.instant_to_ntz("window.end").alias("window_end"), "max_ts_ms", "first_message", "cnt")


@q("sensor_lines_stream")
def sensor_lines_stream(spark, sf):
    """S-09/P-03 + W-02 as a stream (the device-poll job): line-protocol
    events parsed with rejects routed out, event time from the line,
    hourly mean per sensor (exact half-up), count and latest ts."""
    base = scratch_path(spark, "sensor_lines")
    ok = P.accepted(P.parse_sensor_lines(I.sensor_lines_from(stream_table(spark, sf, "events"))))
    r = ok.withColumn("ts", epoch_ms_to_ts("ts_ms")).withColumn("ets", RN.ntz_to_instant("ts"))
    agg = r.groupBy("sensor", F.window("ets", "1 hour").alias("window")).agg(
        F.sum(micros("value_num")).alias("_sum"), F.count(F.lit(1)).alias("cnt"),
        F.max("ts_ms").alias("max_ts_ms"))
    res = RN.run_updates(agg, ["sensor", "window"], f"{base}/out", f"{base}/checkpoint")
    return res.select("sensor", RN.instant_to_ntz("window.start").alias("window_start"),
                      exact_mean("_sum", "cnt").alias("avg_value"), "cnt", "max_ts_ms")


@q("row_count_stream")
def row_count_stream(spark, sf):
    """S-11 as a stream: the running row count of a table fed as a stream
    (a key-less aggregate in update mode); the last update is the count."""
    base = scratch_path(spark, "row_count")
    counts = agg.row_count(stream_table(spark, sf, "events"))
    return RN.run_updates(counts, [], f"{base}/out", f"{base}/checkpoint")


@q("tumbling_pairwise_stream")
def tumbling_pairwise_stream(spark, sf):
    """W-01 as a stream (the device-poll job's fold): ``(acc + v) / 2`` per
    sensor and hour, continued across micro-batches from carried state."""
    base = scratch_path(spark, "pairwise_stream")
    r = events_as_readings(stream_table(spark, sf, "events"))
    out = ST.pairwise_avg_batches(r, ["sensor"], "ts", "seq", "value", "unit", "1 hour", "1 hour",
                                  f"{base}/data", f"{base}/checkpoint")
    return out.select("sensor", "window_start",
                      (F.col("window_start") + F.expr("INTERVAL 1 hour")).alias("window_end"),
                      F.floor(F.col("pairwise_avg") * 1000 + F.lit(0.3137)).cast("bigint").alias("pairwise_avg_milli"),
                      "max_ts", "cnt", "first_unit")


# --------------------------------------------------------------------------
# Growing files, general folds, recovery, late rows, live state, clustered
# and bucketed tables, versioned dimensions
# --------------------------------------------------------------------------


@q("follow_growing_files")
def follow_growing_files(spark, sf):
    """S-04/S-05: lines of all documents appended to known files in two
    pieces; the files are followed with a cap on a batch's lines, the query is
    stopped between the pieces, and every line arrives once."""
    base = scratch_path(spark, "growing")
    lines = I.doc_lines(spark, sf).select(
        F.pmod(F.xxhash64("doc_id"), F.lit(8)).cast("int").alias("file_no"), F.struct("doc_id", "line_no").alias("ord"),
        F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("line_no").cast("string"), "line").alias("value"))
    half = lines.agg(F.percentile_approx("ord.doc_id", 0.5)).first()[0]
    cap = max(1, -(-lines.count() // 3))
    for piece in (lines.where(F.col("ord.doc_id") <= half), lines):  # the second holds the first
        I.write_growing(piece, f"{base}/in")
        out = drain(follow_lines(spark, f"{base}/in", max_lines=cap), f"{base}/out", f"{base}/checkpoint")
    p = F.split("value", "\t", 3)
    return out.select(p[0].cast("long").alias("doc_id"), p[1].cast("int").alias("line_no"), p[2].alias("line"))


def _milli(c: str):
    return F.floor(F.col(c) * 1000 + F.lit(0.3137)).cast("bigint")


@q("exponential_mean")
def exponential_mean(spark, sf):
    """U-03: exponential mean (weight 0.2) of each sensor's readings per hour,
    an ordered fold by composition of affine maps."""
    r = I.readings(spark, sf).withColumn("window_start", F.date_trunc("HOUR", "ts").cast("timestamp_ntz"))
    g = FO.affine_fold(r, ["sensor", "window_start"], ["ts", "seq"], "value", FO.exponential("value", 0.2),
                       F.date_trunc("MINUTE", "ts"), "ema", first=["unit"])
    return g.select("sensor", "window_start", _milli("ema").alias("ema_milli"), "cnt", "max_ts", "first_unit")


@q("exponential_mean_stream")
def exponential_mean_stream(spark, sf):
    """U-03 as a stream: the same means, carried over micro-batches in the
    state store as one affine map per (sensor, hour), a day's together."""
    base = scratch_path(spark, "ema_stream")
    r = _followed_readings(spark, sf, f"{base}/in")
    g = ST.affine_fold_stream(r, ["sensor"], "ts", "seq", "value", FO.exponential("value", 0.2), "1 hour", "1 hour",
                              f"{base}/data", f"{base}/checkpoint", ["unit"], "ema",
                              trigger={"processingTime": "0 seconds"})
    return g.select("sensor", "window_start", _milli("ema").alias("ema_milli"), "cnt", "max_ts", "first_unit")


@q("recovered_windows")
def recovered_windows(spark, sf):
    """T-05: the flagship window on a 10-second trigger, the query stopped and
    started again from its checkpoint after every micro-batch."""
    base = scratch_path(spark, "recovered")
    r = _followed_readings(spark, sf, f"{base}/in").withColumn("ets", RN.ntz_to_instant("ts"))
    agg_ = r.groupBy("sensor", F.window("ets", "1 hour").alias("window")).agg(
        F.sum(micros("value")).alias("_sum"), F.count(F.lit(1)).alias("cnt"), F.max("ts").alias("max_ts"))
    RN.run_with_restarts(lambda: RN.update_writer(agg_, f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
                         .trigger(processingTime="10 seconds").start(), spark)
    res = RN.last_updates(spark, f"{base}/out", ["sensor", "window"])
    return res.select("sensor", RN.instant_to_ntz("window.start").alias("window_start"),
                      RN.instant_to_ntz("window.end").alias("window_end"),
                      exact_mean("_sum", "cnt").alias("avg_value"), "cnt", "max_ts")


@q("late_rows")
def late_rows(spark, sf):
    """T-04: rows behind the watermark kept in a table of their own and
    counted exactly, over several micro-batches: on-time and late rows together
    are the input."""
    base = scratch_path(spark, "late")
    r = _followed_readings(spark, sf, f"{base}/in").withColumn("ets", RN.ntz_to_instant("ts"))
    on_time, late, counts = RN.split_late(r, "ets", "1 hour", base, f"{base}/checkpoint",
                                          trigger={"processingTime": "0 seconds"})
    total = counts.agg(F.sum("accepted").alias("a"), F.sum("late").alias("l")).first()
    kept = on_time.unionByName(late)
    return kept.groupBy("sensor").agg(F.count(F.lit(1)).alias("rows_kept")).withColumn(
        "rows_counted", F.lit((total["a"] or 0) + (total["l"] or 0)).cast("long"))


@q("live_snapshot")
def live_snapshot(spark, sf):
    """R-10 live: latest value of every (device, sensor) read from the state of
    the running aggregate's checkpoint, not from its output."""
    base = scratch_path(spark, "live_snapshot")
    r = events_as_readings(stream_table(spark, sf, "events"))
    g = r.groupBy("device", "sensor").agg(F.max_by("value", F.struct("ts", "seq")).alias("value"), F.max("ts").alias("latest_ts"))
    RN.run_updates(g, ["device", "sensor"], f"{base}/out", f"{base}/checkpoint")
    return TM.snapshot_of_state(RN.read_state(spark, f"{base}/checkpoint"))


@q("top_words_stream")
def top_words_stream(spark, sf):
    """O-01 as a stream: the leaderboard of words kept in complete mode."""
    base = scratch_path(spark, "top_words")
    lines = split_lines(stream_table(spark, sf, "documents"), "text", "doc_id")
    counts = TX.word_count(TX.words(lines, "line", min_len=2))
    return RN.leaderboard(counts, [F.col("cnt").desc(), F.col("word")], 25, f"{base}/out", f"{base}/checkpoint")


@q("point_lookup")
def point_lookup(spark, sf):
    """C-06: the readings stored in order of time with Bloom filters on their
    number; the hundred readings of the highest values are looked up by it."""
    path = scratch_path(spark, "clustered")
    r = I.readings(spark, sf).select("seq", "sensor", "ts", "value")
    FS.write_clustered(r, path, ["ts"], {"seq": 1 << 16}, group_bytes=1 << 20)
    wanted = [x["seq"] for x in r.orderBy(F.col("value").desc(), "seq").limit(100).collect()]
    return FS.point_lookup(spark, path, "seq", wanted)


@q("upsert_bucketed")
def upsert_bucketed(spark, sf):
    """K-04/K-05: the replayed batch upserted into a bucketed table; only the
    batch is shuffled.  Same result as ``upsert_readings``."""
    path = scratch_path(spark, "bucketed")
    name = _table_name(path)
    e = I.events(spark, sf)
    keys = ["sensor", "record_time"]
    stored = TB.first_per_key(_hourly(e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))), keys, "event_id")
    TB.write_bucketed(stored.drop("event_id"), f"{name}_0", f"{path}/0", keys, 8)
    batch = _hourly(e.where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")))
    return TB.upsert_bucketed(f"{name}_0", batch, keys, "event_id", f"{name}_1", f"{path}/1", 8).select(
        "sensor", "record_time", "unit", "value")


@q("versioned_join")
def versioned_join(spark, sf):
    """J-05 with a changing dimension: readings followed from growing files
    LEFT JOIN the customers' snapshot that is the newest when a micro-batch
    runs; a second snapshot (names in capitals) is committed half-way."""
    base = scratch_path(spark, "versioned")
    e = I.events(spark, sf).select("event_id", "user_id", "value")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    top = e.agg(F.max("event_id")).first()[0] or 0
    lines = e.select(F.floor(F.col("event_id") * 8 / F.lit(top + 1)).cast("int").alias("file_no"), F.col("event_id").alias("ord"),
                     F.concat_ws("|", *[F.col(x).cast("string") for x in ("event_id", "user_id", "value")]).alias("value"))
    for piece, names in ((lines.where(F.col("file_no") < 4), c), (lines, c.withColumn("c_name", F.upper("c_name")))):
        FS.write_snapshot(names, f"{base}/customers")
        I.write_growing(piece, f"{base}/in")
        p = F.split("value", "\\|")
        rows = follow_lines(spark, f"{base}/in").select(
            p[0].cast("long").alias("event_id"), p[1].cast("long").alias("user_id"), p[2].cast("double").alias("value"))
        out = RN.versioned_join(rows, f"{base}/customers", "user_id", "c_custkey", base, f"{base}/checkpoint",
                                trigger={"processingTime": "0 seconds"})
    return out.select("event_id", "user_id", "value", "c_name", "c_nationkey")


@q("snapshot_table")
def snapshot_table(spark, sf):
    """K-08: readings written as a committed snapshot, then replaced by a
    second one with all readings; readers see the newest committed state only."""
    base = scratch_path(spark, "snapshots")
    r = I.readings(spark, sf).select("seq", "sensor", "value")
    FS.write_snapshot(r.where(F.col("value") > 0), base)
    FS.write_snapshot(r, base)
    return FS.read_latest(spark, base)


@q("catalog_table")
def catalog_table(spark, sf):
    """K-10: the table of area means created in the catalog from its definition,
    filled and read by name."""
    path = scratch_path(spark, "catalog")
    name = _table_name(path)
    create_table(spark, name, S.TABLES["sensor_data"], path)
    g = I.readings(spark, sf).groupBy("area", F.col("sensor").alias("sensor_id")).agg(
        F.sum(micros("value")).alias("_sum"), F.count(F.lit(1)).alias("cnt"), F.max(ts_to_epoch_ms("ts")).alias("ts"))
    g.select("area", "sensor_id", exact_mean("_sum", "cnt").alias("avg_value"), F.col("cnt").cast("int"), "ts") \
        .write.mode("append").insertInto(name)
    return spark.table(name)


@q("fan_out_stream")
def fan_out_stream(spark, sf):
    """T-10: one stream to two outputs, all readings as rows and counts per
    sensor of each micro-batch; the counts of all batches together are those of
    the rows."""
    base = scratch_path(spark, "fan_out")
    r = _followed_readings(spark, sf, f"{base}/in")

    def rows(batch, bid):
        batch.select("sensor", "value").write.mode("overwrite").parquet(f"{base}/rows/batch_id={bid}")

    def counts(batch, bid):
        batch.groupBy("sensor").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{base}/counts/batch_id={bid}")

    RN.start(lambda: r.writeStream.foreachBatch(RN.fan_out(rows, counts)).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(processingTime="0 seconds").start(), spark, until_idle=True)
    stored = spark.read.schema("sensor string, value double, batch_id long").parquet(f"{base}/rows")
    counted = spark.read.schema("sensor string, n long, batch_id long").parquet(f"{base}/counts")
    a = stored.groupBy("sensor").agg(F.count(F.lit(1)).alias("rows_stored"), F.max("value").alias("max_value"))
    return a.join(counted.groupBy("sensor").agg(F.sum("n").alias("rows_counted")), "sensor")
