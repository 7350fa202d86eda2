"""Plan-shape checks: the scale properties the README claims, read from explain()."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E

SF = os.environ.get("HOURGLASS_TEST_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def test_factor_share_is_one_broadcast_join_with_pruned_scan(spark):
    text = plan(spark, "q5_factor_share_daily")
    assert "BroadcastHashJoin Inner" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in text
    assert "partial_count" in text


def test_context_left_facts_never_shuffles_facts(spark):
    text = plan(spark, "k1_context_left_facts_daily")
    assert "BroadcastHashJoin Inner BuildLeft" in text      # context broadcast, facts streamed
    assert "BroadcastHashJoin LeftAnti BuildRight" in text  # missing keys from distinct fact keys
    assert "SortMergeJoin" not in text
    # no exchange ever takes the wide fact rows (l_orderkey only exists in that scan)
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)
    assert exchanges and not any("l_orderkey" in cols for cols in exchanges)


def test_scaling_uses_one_subquery(spark):
    for name in ("q3_training_table", "x17_min_max_scale"):
        ids = set(re.findall(r"Subquery subquery#(\d+)", plan(spark, name)))
        assert len(ids) == 1, name


def test_line_cleaning_is_map_only(spark):
    text = plan(spark, "c13_clean_crash_lines").split("\n\n\n")[0]
    assert "Exchange" not in text and "Sort" not in text


def test_no_broadcast_path_pre_aggregates_facts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "q5_factor_share_daily_shuffle")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n\n")[0]
    assert "SortMergeJoin Inner" in tree
    # facts: scan -> partial aggregate -> exchange -> final aggregate -> join exchange
    facts_side = tree[tree.index("SortMergeJoin"):]
    assert re.search(r"HashAggregate \(\d+\)\n.*Exchange \(\d+\)\n.*HashAggregate \(\d+\)\n.*Project", facts_side)


def test_cleaned_table_generates_the_split_array_only(spark):
    text = plan(spark, "p5_sentinel_counts")
    generate = text[text.index("Generate"):]
    assert "inline" in text and "_cells" in generate
    assert "vehicle_5" not in text and "latitude" not in text  # unused cells are pruned


def test_context_is_built_once_for_context_left_facts(spark):
    text = plan(spark, "k1_context_left_facts_daily").split("\n\n\n")[0]
    assert "orders.parquet" not in text  # the staged context is read instead
