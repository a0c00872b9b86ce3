from pyspark.sql import functions as F

from tagstream.operators import running as R
from tagstream.operators import text as TX


def test_classify(spark):
    # G5
    xs = ["docker ls", "ls -la", "cd /tmp", "tools", "pwd", "DOCKER ps"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, line string")
    got = [r.c for r in df.select("i", TX.classify("line").alias("c")).orderBy("i").collect()]
    assert got == ["DOCKER", "NAVIGATION", "NAVIGATION", "NAVIGATION", "OTHER", "DOCKER"]


def test_word_count(spark):
    # G6
    df = spark.createDataFrame([("Go to the  Store",), ("the store",)], "line string")
    wc = TX.word_count(TX.words(df, "line", min_len=2))
    assert sorted(tuple(r) for r in wc.collect()) == [("store", 2), ("the", 2)]


def test_running_line_stats(spark):
    # G7: "ab cd", "x", "" -> (5,2,1) (3,1.5,2) (2,1,3)
    df = spark.createDataFrame([(0, "ab cd"), (1, "x"), (2, "")], "seq long, line string")
    m = TX.line_metrics(df, keep=["seq"])
    out = R.running_global_means(m, {"chars": F.col("n_chars"), "words": F.col("n_words")},
                                 ["seq"], R.seq_bucket("seq", 2), count_col="n")
    got = [(r.avg_chars, r.avg_words, r.n) for r in out.orderBy("seq").collect()]
    assert got == [(5.0, 2.0, 1), (3.0, 1.5, 2), (2.0, 1.0, 3)]
    g = TX.global_line_stats(m).collect()[0]
    assert (g.avg_chars, g.avg_words, g.n_lines) == (2.0, 1.0, 3)


def test_distinct_lines(spark):
    df = spark.createDataFrame([(" a ",), ("a",), ("",), ("  ",), ("b",)], "line string")
    assert sorted(r.line for r in TX.distinct_lines(df).collect()) == ["a", "b"]


def test_stopwords(spark):
    df = spark.createDataFrame([("the cat and the hat",)], "line string")
    w = TX.drop_words(TX.words(df, "line"), ["the", "and"])
    assert sorted(r.word for r in w.collect()) == ["cat", "hat"]
    stop = spark.createDataFrame([("cat",)], "w string")
    assert sorted(r.word for r in TX.drop_words(w, stop).collect()) == ["hat"]
