"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(entry.queries()) if n[0] in "TJAMLPR"])
def test_no_products_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = entry.queries()["T6"](spark, FOLDER)._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_quantity,24.0)" in text
    schema = text[text.index("ReadSchema") :].splitlines()[0]
    assert "l_orderkey" not in schema and "l_extendedprice" in schema


def test_or_of_conjunctions_keeps_an_equi_join(spark):
    text = plan(spark, "T19")
    assert "l_partkey" in text and ("BroadcastHashJoin" in text or "SortMergeJoin" in text)


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "L2_top_k")


def test_window_groups_are_never_the_whole_table(spark):
    """Numbering a whole table windows over one row per slice only."""
    text = plan(spark, "W2_row_sequence")
    assert text.count("Window") == 1 and "o_orderdate" not in text[text.index("Window") :].splitlines()[0]


@pytest.mark.parametrize(
    "name,exchanges", [("W2_row_sequence", 3), ("M12_running_series", 4), ("S9_bad_records", 4), ("W8_interval_union", 6), ("W9_timeline", 8)]
)
def test_exchanges_after_the_slices(spark, name, exchanges):
    if name not in entry.queries():
        pytest.skip(name)
    assert plan(spark, name).count("Exchange ") <= exchanges


def test_log_rows_are_not_sorted(spark):
    """Lines are numbered by split: rows meet an aggregate before any exchange, and nothing is sorted before it."""
    text = plan(spark, "S9_bad_records")
    scan = text.rindex("Exchange")
    assert "Sort" not in text[scan:]
