"""Small tables with the awkward cases, and readers of the given ones."""

import duckdb

SF = "/root/testdata/sf0.01"
LONG = "Lorem the of and ipsum " * 30_000


def table(name, sf=SF):
    """Rows of a given table as dicts."""
    rel = duckdb.sql(f"select * from read_parquet('{sf}/{name}.parquet')")
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def awkward_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and columns whose names clash with those the operators make."""
    base = "the quick brown fox jumps over the lazy dog and runs of to a river near an old mill " * 5
    rows = [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, " \t\n ", "en", "s", 3), (4, "word", "xx", "s", 4),
        (5, base, "en", "s", len(base)), (6, base, "en", "s", len(base)), (6, base, "en", "s", len(base)),
        (7, LONG, "en", "s", len(LONG)), (None, base + " extra", "en", "s", 1), (None, None, None, None, None),
        (8, "mail a@b.co or 10.0.0.1 \u00e9\u00df\U0001f600 +1 (555) 123-4567", "de", "s", 9),
    ]
    rows = [(*r, "x", "y", 1, True) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "kept string, n_words string, digest int, key boolean")


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def docs_frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
