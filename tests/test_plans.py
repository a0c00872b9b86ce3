"""Plan-shape guards: the properties the scale design relies on, read from
``explain('formatted')`` of the registered queries."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<(.*)>", text)


def test_scan_prunes_columns(spark):
    text = plan(spark, "tumbling_avg")
    (schema,) = read_schemas(text)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"ts", "event_type", "value"}


def test_filter_pushed_into_scan(spark):
    text = plan(spark, "filter_project")
    assert re.search(r"PushedFilters: \[.*GreaterThan\(value,40\.0\)", text)


def test_report_never_hash_shuffles_inputs(spark):
    text = plan(spark, "report_top6")
    assert "hashpartitioning" not in text


def test_running_windows_partition_by_bucket(spark):
    for name in ("running_sum", "tumbling_pairwise_avg"):
        text = plan(spark, name)
        specs = re.findall(r"\(\d+\) Window\nInput.*\nArguments: \[.*?\], \[(.*?)\], \[", text)
        assert specs, name
        # The per-row window runs per (key, bucket); only the bucket table
        # is windowed per key alone.
        assert any("_tg_bucket" in s for s in specs), (name, specs)


def test_dimension_joins_broadcast(spark):
    text = plan(spark, "left_join_chain")
    assert text.count("BroadcastHashJoin") >= 2


@pytest.mark.parametrize("name", ["left_join_fanout", "upsert_readings", "decode_registers_default", "dashboard"])
def test_no_cartesian_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_pairwise_fold_scans_and_shuffles_rows_once(spark):
    text = plan(spark, "tumbling_pairwise_avg")
    assert len(read_schemas(text)) == 1 and "Join" not in text
    # the rows by sub-window, then only the folded sub-windows
    assert len(re.findall(r"\(\d+\) Exchange\n", text)) == 2


def test_upsert_scans_each_input_once(spark):
    text = plan(spark, "upsert_readings")
    assert len(read_schemas(text)) == 2 and "Join" not in text
    # one for the stored table of the query, one for the upsert
    assert len(re.findall(r"\(\d+\) Exchange\n", text)) == 2
