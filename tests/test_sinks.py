"""Sink logic that needs no external system: JDBC batching and retries
(with the writer's ``jdbc`` call stubbed), Kafka record encoding."""

from pyspark.sql.readwriter import DataFrameWriter

from tagstream.sinks import jdbc as JD


def test_jdbc_append_retries_then_succeeds(spark, monkeypatch):
    calls = []

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, dict(properties)))
        if len(calls) < 3:
            raise RuntimeError("connection reset")

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    deleted = []
    monkeypatch.setattr(JD, "delete_batch", lambda s, url, table, props, bid: deleted.append((table, bid)))
    df = spark.createDataFrame([("line_1", "therm", 20.5, 1, 1000)],
                               "area string, sensor_id string, avg_value double, cnt int, ts long")
    JD.append_batch(df, "jdbc:example://db/x", "sensor_data", {"user": "u"}, batch_id=7,
                    batchsize=100, retries=3, backoff_s=0)
    assert len(calls) == 3
    assert deleted == [("sensor_data", 7)] * 3  # before every attempt, so none leaves rows behind
    assert calls[-1][2]["batchsize"] == "100" and calls[-1][2]["user"] == "u"


def test_jdbc_gives_up_after_retries(spark, monkeypatch):
    def always_fail(self, url, table, mode=None, properties=None):
        raise RuntimeError("down")

    monkeypatch.setattr(DataFrameWriter, "jdbc", always_fail)
    df = spark.createDataFrame([(1,)], "a int")
    try:
        JD.append_batch(df, "jdbc:example://db/x", "t", {}, retries=2, backoff_s=0)
    except RuntimeError as e:
        assert "down" in str(e)
    else:
        raise AssertionError("expected failure")


def test_batch_writer_tags_batch_id(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None:
                        calls.append(table))
    monkeypatch.setattr(JD, "delete_batch", lambda *a: None)
    w = JD.batch_writer("jdbc:example://db/x", "sensor_data", {})
    w(spark.createDataFrame([(1,)], "a int"), 3)
    assert calls == ["sensor_data"]
    tagged = JD.with_batch_id(spark.createDataFrame([(1,)], "a int"), 3).collect()[0]
    assert tagged.batch_id == 3
