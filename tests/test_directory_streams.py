"""Stream queries over a table of several files, one file per micro-batch,
equal the batch forms; restarts return what is stored."""

import pytest
from pyspark.sql import functions as F

from tagstream.functions.scalars import exact_mean, mean_to_cents, micros
from tagstream.operators import tables as TB
from tagstream.plans import gallery as G
from tagstream.sources import tables as SRC
from tagstream.streaming import runner as RN

SF = "/root/testdata/sf0.001"
STREAMS = ["stream_tumbling", "file_sink_roundtrip", "running_sum_stream", "distinct_lines_stream",
           "kafka_json_stream", "running_sum_stream_batches", "area_window_report_stream",
           "distinct_lines_exact_stream", "log_levels_stream", "sensor_lines_stream", "row_count_stream",
           "tumbling_pairwise_stream", "stream_static_join"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    for name, key in (("events", "event_id"), ("documents", "doc_id"), ("customer", "c_custkey")):
        spark.read.parquet(f"{SF}/{name}.parquet").repartitionByRange(4, key).sortWithinPartitions(key).write.parquet(
            f"{base}/{name}.parquet")
    return base


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", STREAMS)
def test_folder_tables_give_the_rows_of_file_tables(spark, folder, name):
    assert rows(G.GALLERY[name](spark, folder)) == rows(G.GALLERY[name](spark, SF))


@pytest.mark.parametrize("name", ["stream_tumbling", "log_levels_stream", "sensor_lines_stream", "row_count_stream",
                                  "distinct_lines_stream", "distinct_lines_exact_stream", "stream_static_join"])
def test_one_file_per_micro_batch(spark, folder, name, monkeypatch):
    whole = rows(G.GALLERY[name](spark, SF))
    monkeypatch.setattr(G, "stream_table", lambda s, d, t: SRC.stream_table(s, d, t, 1))
    assert rows(G.GALLERY[name](spark, folder)) == whole


def test_restart_without_new_input_returns_the_stored_rows(spark, folder, tmp_dir):
    def run():
        s = SRC.events_as_readings(SRC.stream_table(spark, folder, "events", 1))
        return rows(RN.run_updates(s.groupBy("sensor").count(), ["sensor"], f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    first = run()
    assert first and run() == first


def test_means_of_negative_and_three_decimal_values(spark):
    df = spark.createDataFrame([("a", -1.5), ("b", -0.01), ("b", 0.0), ("c", 1.234), ("c", 1.234), ("d", -0.005)],
                               "k string, v double")
    g = df.groupBy("k").agg(F.sum(micros("v")).alias("s"), F.count(F.lit(1)).alias("n"))
    got = {r["k"]: (r["m"], r["c"]) for r in
           g.select("k", exact_mean("s", "n").alias("m"), mean_to_cents("s", "n").alias("c")).collect()}
    assert got == {"a": (-1.5, -1.5), "b": (-0.005, -0.01), "c": (1.234, 1.23), "d": (-0.005, -0.01)}


def test_upsert_raises_on_a_damaged_table_and_leaves_it(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    batch = spark.createDataFrame([(1, 1, "x", "p")], "k int, ord int, v string, p string")
    TB.upsert_into(path, batch, ["k", "p"], "ord", "p")
    assert spark.read.parquet(path).columns == ["k", "v", "p"]
    import glob
    (part,) = glob.glob(f"{path}/p=p/*.parquet")
    with open(part, "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        TB.upsert_into(path, batch, ["k", "p"], "ord", "p")
    with open(part, "rb") as f:
        assert f.read() == b"not parquet"
