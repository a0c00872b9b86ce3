import json
import os
import time

from pyspark.sql import functions as F

from tagstream.operators import parse as P
from tagstream.operators import windows as W
from tagstream.plans.gallery import GALLERY
from tagstream.sinks import files as FS
from tagstream.sinks import kafka as K
from tagstream.streaming import dedupe as D
from tagstream.streaming import runner as RN
from tagstream.streaming import stateful as ST

SF = "/root/testdata/sf0.001"


def _write_json_batches(d, batches):
    os.makedirs(d, exist_ok=True)
    for i, rows in enumerate(batches):
        with open(os.path.join(d, f"part-{i}.json"), "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        t = time.time() + i
        os.utime(os.path.join(d, f"part-{i}.json"), (t, t))


def test_late_rows_and_unflushed_window(spark, tmp_dir):
    # 3-s windows, zero watermark delay, one file per micro-batch
    batches = [[{"key": "a", "t": 1, "n": 1}, {"key": "a", "t": 5, "n": 2}],
               [{"key": "a", "t": 2, "n": 7}, {"key": "a", "t": 10, "n": 3}],
               [{"key": "a", "t": 1, "n": 9}, {"key": "b", "t": 20, "n": 4}]]
    src = f"{tmp_dir}/in"
    _write_json_batches(src, batches)
    s = spark.readStream.schema("key string, t long, n int").option("maxFilesPerTrigger", 1).json(src)
    s = W.event_time(s, "t", "s").withColumn("ets", RN.ntz_to_instant("ts")).withWatermark("ets", "0 seconds")
    agg = s.groupBy("key", F.window("ets", "3 seconds").alias("window")).agg(F.sum("n").alias("s"))
    seen = {}
    out = RN.run_to_files(agg.select("key", F.col("window.start").alias("ws"), "s"),
                          f"{tmp_dir}/out", f"{tmp_dir}/ck",
                          on_done=lambda q: seen.update(dropped=RN.late_rows_dropped(q)))
    got = sorted((r.key, int(r.ws.timestamp()), r.s) for r in out.collect())
    assert got == [("a", 0, 8), ("a", 3, 2), ("a", 9, 3)]
    assert seen["dropped"] == 1


def test_update_mode_flushes_like_batch(spark):
    stream = {(r.sensor, r.window_start, r.avg_value, r.cnt) for r in GALLERY["stream_tumbling"](spark, SF).collect()}
    batch = {(r.sensor, r.window_start, r.avg_value, r.cnt) for r in GALLERY["tumbling_avg"](spark, SF).collect()}
    assert stream == batch


def test_text_sink_roundtrip_and_snapshot(spark, tmp_dir):
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("x | 1\ny | 2\n")
    s = spark.readStream.text(src)
    q = FS.text_stream(s, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/out").collect()) == ["x | 1", "y | 2"]
    # K-08: snapshots are visible only once committed
    df = spark.createDataFrame([(1,), (2,)], "a int")
    FS.write_snapshot(df, f"{tmp_dir}/tbl")
    FS.write_snapshot(df.where("a = 2"), f"{tmp_dir}/tbl")
    assert [r.a for r in FS.read_latest(spark, f"{tmp_dir}/tbl").collect()] == [2]


def test_distinct_lines_stream(spark, tmp_dir):
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    for i, body in enumerate(["a\n b \n\na\n", "b\nc\n"]):
        with open(f"{src}/f{i}.txt", "w") as f:
            f.write(body)
    s = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    out = RN.run_to_files(D.distinct_lines_stream(s).select("value"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert sorted(r.value for r in out.collect()) == ["a", "b", "c"]


def test_running_sum_stream_per_record(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_json_batches(src, [[{"k": "Rita", "seq": 0, "v": 100.0}, {"k": "Bob", "seq": 1, "v": 50.0}],
                              [{"k": "Rita", "seq": 2, "v": 200.0}, {"k": "Bob", "seq": 4, "v": 150.0},
                               {"k": "Rita", "seq": 5, "v": 50.0}]])
    s = spark.readStream.schema("k string, seq long, v double").option("maxFilesPerTrigger", 1).json(src)
    out = ST.running_sum_batches(s, "k", "seq", "v", f"{tmp_dir}/data", f"{tmp_dir}/ck")
    got = [(r.k, r.running_total) for r in out.orderBy("seq").collect()]
    assert got == [("Rita", 100.0), ("Bob", 50.0), ("Rita", 300.0), ("Bob", 200.0), ("Rita", 350.0)]


def test_kafka_shaped_source_decodes(spark, tmp_dir):
    msgs = ['{"sensor_id":"therm","area":"line_1","value":20.5,"timestamp":1000}', "{bad"]
    rows = [(None, m.encode(), "readings", 0, i, None) for i, m in enumerate(msgs)]
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/kafka")
    s = spark.readStream.schema(schema).parquet(f"{tmp_dir}/kafka")
    parsed = P.accepted(P.parse_json_readings(K.values(s)))
    out = RN.run_to_files(parsed.select("seq", "sensor", "value_num"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert [(r.seq, r.sensor, r.value_num) for r in out.collect()] == [(0, "therm", 20.5)]
    enc = K.encode(spark.createDataFrame([("s1", 1.5)], "sensor string, value double"), "sensor").collect()[0]
    assert enc.key == "s1" and json.loads(enc.value) == {"sensor": "s1", "value": 1.5}


def test_fan_out_two_outputs_and_stream_static_join(spark, tmp_dir):
    # T-10 (two outputs from one stream) and J-05 (stream x static left join)
    from tagstream.operators import joins as J
    src = f"{tmp_dir}/in"
    _write_json_batches(src, [[{"sensor": "s1", "v": 1.0}, {"sensor": "s9", "v": 2.0}]])
    locs = spark.createDataFrame([("s1", "London")], "code string, site string")
    s = spark.readStream.schema("sensor string, v double").json(src)
    joined = J.left_join(s, locs, "sensor", "code", broadcast_max_rows=100)

    def to_a(b, i):
        b.write.mode("overwrite").parquet(f"{tmp_dir}/a/batch_id={i}")

    def to_b(b, i):
        b.select("sensor").write.mode("overwrite").parquet(f"{tmp_dir}/b/batch_id={i}")

    q = (joined.writeStream.foreachBatch(RN.fan_out(to_a, to_b))
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    a = sorted((r.sensor, r.site) for r in spark.read.parquet(f"{tmp_dir}/a").collect())
    assert a == [("s1", "London"), ("s9", None)]
    assert spark.read.parquet(f"{tmp_dir}/b").count() == 2


def test_processing_time_window(spark, tmp_dir):
    # W-03/W-09: stamp at source, window on the stamp
    src = f"{tmp_dir}/in"
    _write_json_batches(src, [[{"w": "a"}, {"w": "a"}, {"w": "b"}]])
    s = RN.stamp_processing_time(spark.readStream.schema("w string").json(src))
    s = s.withWatermark("ingest_ts", "0 seconds")
    agg = s.groupBy("w", F.window("ingest_ts", "2 seconds").alias("window")).agg(F.count(F.lit(1)).alias("n"))
    out = RN.run_updates(agg, ["w", "window"], f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert sorted((r.w, r.n) for r in out.collect()) == [("a", 2), ("b", 1)]


def test_create_table_if_absent(spark, tmp_dir):
    from tagstream.schemas import TABLES
    from tagstream.sinks.catalog import create_table
    create_table(spark, "tg_readings_test", TABLES["readings"], f"{tmp_dir}/readings", drop=True)
    create_table(spark, "tg_readings_test", TABLES["readings"], f"{tmp_dir}/readings")
    assert spark.table("tg_readings_test").columns == ["sensor", "unit", "value", "record_time"]
    spark.sql("DROP TABLE IF EXISTS tg_readings_test")


def test_console_outputs(spark, tmp_dir, capsys):
    # K-01 / K-11: grid print of a batch result and the console sink
    from tagstream.sinks import console as C
    C.show_grid(spark.createDataFrame([("flowmeter_1", 1.5)], "sensor string, value double"))
    assert "flowmeter_1" in capsys.readouterr().out
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("hello\n")
    q = C.console_stream(spark.readStream.text(src), f"{tmp_dir}/ck")
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] == 1


def test_running_sum_batches_carries_state(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_json_batches(src, [[{"k": "Rita", "seq": 0, "v": 100.0}, {"k": "Bob", "seq": 1, "v": 50.0}],
                              [{"k": "Rita", "seq": 2, "v": 200.0}, {"k": "Bob", "seq": 4, "v": 150.0},
                               {"k": "Rita", "seq": 5, "v": 50.0}]])
    s = spark.readStream.schema("k string, seq long, v double").option("maxFilesPerTrigger", 1).json(src)
    out = ST.running_sum_batches(s, "k", "seq", "v", f"{tmp_dir}/data", f"{tmp_dir}/ck", width=1)
    got = [(r.k, r.running_total) for r in out.orderBy("seq").collect()]
    assert got == [("Rita", 100.0), ("Bob", 50.0), ("Rita", 300.0), ("Bob", 200.0), ("Rita", 350.0)]


def test_gapped_hopping_stream_append_equals_batch(spark, tmp_dir):
    # Gapped windows group by the window struct, so append mode works on a
    # stream; with a final far-future row every real window is closed.
    batches = [[{"w": "a", "t": t} for t in (0, 1999, 2000, 4900)],
               [{"w": "a", "t": t} for t in (5000, 6500, 11000, 12000)],
               [{"w": "z", "t": 100000}]]
    src = f"{tmp_dir}/in"
    _write_json_batches(src, batches)
    s = spark.readStream.schema("w string, t long").option("maxFilesPerTrigger", 1).json(src)
    s = W.event_time(s, "t", "ms").withColumn("ets", RN.ntz_to_instant("ts")).withWatermark("ets", "0 seconds")
    g = W.hopping_gapped(s, ["w"], "ets", "2 seconds", "5 seconds", [F.count(F.lit(1)).alias("n")])
    out = RN.run_to_files(g, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    got = sorted((r.w, int(r.window_start.timestamp()), r.n) for r in out.where("w = 'a'").collect())
    b = spark.createDataFrame([(r["w"], r["t"]) for rows in batches for r in rows], "w string, t long")
    b = W.event_time(b, "t", "ms")
    ref = W.hopping_gapped(b, ["w"], "ts", "2 seconds", "5 seconds", [F.count(F.lit(1)).alias("n")])
    expect = sorted((r.w, r.window_start.second, r.n) for r in ref.where("w = 'a'").collect())
    assert got == expect == [("a", 0, 2), ("a", 5, 2), ("a", 10, 1)]


def test_empty_stream_inputs(spark, tmp_dir):
    src = f"{tmp_dir}/empty"
    os.makedirs(src)
    s = spark.readStream.schema("k string, seq long, v double, ts timestamp").json(src)
    agg = (s.withWatermark("ts", "0 seconds").groupBy("k", F.window("ts", "1 hour").alias("window"))
           .agg(F.count(F.lit(1)).alias("n")))
    assert RN.run_updates(agg, ["k", "window"], f"{tmp_dir}/o1", f"{tmp_dir}/c1").count() == 0
    assert ST.running_sum_batches(s, "k", "seq", "v", f"{tmp_dir}/d2", f"{tmp_dir}/c2").count() == 0


def test_distinct_lines_exact_across_batches(spark, tmp_dir):
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    for i, body in enumerate(["a\n b \n\na\n", "b\nc\na\n", "c\nd\n"]):
        with open(f"{src}/f{i}.txt", "w") as f:
            f.write(body)
        t = time.time() + i
        os.utime(f"{src}/f{i}.txt", (t, t))
    s = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    out = D.distinct_lines_batches(s, f"{tmp_dir}/data", f"{tmp_dir}/ck")
    assert sorted(r.line for r in out.collect()) == ["a", "b", "c", "d"]


def test_pairwise_fold_continues_across_batches(spark, tmp_dir):
    import functools
    src = f"{tmp_dir}/in"
    rows = [(1000, 10.0), (1500, 20.0), (2000, 40.0), (2500, 5.0), (3000, 7.0)]
    _write_json_batches(src, [[{"s": "a", "t": t, "seq": i, "v": v, "u": f"u{i}"} for i, (t, v) in enumerate(rows[:2])],
                              [{"s": "a", "t": t, "seq": i + 2, "v": v, "u": "x"} for i, (t, v) in enumerate(rows[2:])]])
    s = spark.readStream.schema("s string, t long, seq long, v double, u string").option("maxFilesPerTrigger", 1).json(src)
    s = W.event_time(s, "t", "ms")
    out = ST.pairwise_avg_batches(s, ["s"], "ts", "seq", "v", "u", "10 seconds", "1 second",
                                  f"{tmp_dir}/data", f"{tmp_dir}/ck").collect()
    assert len(out) == 1
    expect = functools.reduce(lambda a, b: (a + b) / 2, [v for _t, v in rows])
    assert abs(out[0].pairwise_avg - expect) < 1e-12 and out[0].cnt == 5 and out[0].first_unit == "u0"


def test_pairwise_fold_evicts_closed_windows(spark, tmp_dir):
    import functools
    src = f"{tmp_dir}/in"
    b1 = [{"s": "a", "t": 1000, "seq": 0, "v": 10.0, "u": "u"}, {"s": "a", "t": 2000, "seq": 1, "v": 20.0, "u": "u"}]
    b2 = [{"s": "a", "t": 12000, "seq": 2, "v": 40.0, "u": "u"}, {"s": "a", "t": 13000, "seq": 3, "v": 8.0, "u": "u"}]
    b3 = [{"s": "a", "t": 3000, "seq": 4, "v": 99.0, "u": "u"}, {"s": "a", "t": 14000, "seq": 5, "v": 2.0, "u": "u"}]
    _write_json_batches(src, [b1, b2, b3])
    s = spark.readStream.schema("s string, t long, seq long, v double, u string").option("maxFilesPerTrigger", 1).json(src)
    s = W.event_time(s, "t", "ms")
    out = ST.pairwise_avg_batches(s, ["s"], "ts", "seq", "v", "u", "10 seconds", "1 second",
                                  f"{tmp_dir}/data", f"{tmp_dir}/ck", lateness="0 seconds").collect()
    got = {r.window_start.second: (r.pairwise_avg, r.cnt) for r in out}
    fold = lambda xs: functools.reduce(lambda a, b: (a + b) / 2, xs)
    # window 0-10 s closed after batch 2 (watermark 13 s): the late 99.0 row is dropped
    assert got[0] == (fold([10.0, 20.0]), 2)
    assert abs(got[10][0] - fold([40.0, 8.0, 2.0])) < 1e-12 and got[10][1] == 3
    assert not os.path.exists(f"{tmp_dir}/data/state/batch_id=2") or \
        spark.read.parquet(f"{tmp_dir}/data/state/batch_id=2").count() == 1
