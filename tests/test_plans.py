"""The shape of physical plans: what is read, shuffled and broadcast."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as contract
from demandkit.operators.grain import to_grain
from demandkit.operators.lags import sales_lags
from demandkit.plans import tables as t
from demandkit.runtime import small_side


def plan(df, mode="simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize(
    "name",
    [
        "order_plan", "future_days", "curated_sales", "sales_with_calendar", "holiday_calendar", "weather_daily",
        "weather_rolling7", "split_assign", "features_day_aggs", "batch_windows", "stale_windows", "weather_refresh",
        "assortment_days", "horizon_join", "order_overrides", "date_dimension",
    ],
)
def test_no_cross_or_nested_loop_joins(spark, sf, name):
    found = plan(contract.queries()[name](spark, sf))
    assert "CartesianProduct" not in found and "NestedLoop" not in found


def test_history_is_cut_before_the_shuffle(spark, sf):
    found = plan(contract.queries()["recent_profiles"](spark, sf))
    shuffled = found.index("Exchange hashpartitioning(store", found.index("WindowGroupLimit"))
    assert "WindowGroupLimit" in found[shuffled:] and ", Partial" in found[shuffled:]


def test_grain_combines_before_every_shuffle(spark, sf):
    found = plan(to_grain(t.sales_lines(spark, sf)))
    parts = re.split(r"Exchange hashpartitioning\(store#\d+, product#\d+, date#\d+", found)
    assert len(parts) == 3
    assert all("partial_sum" in part.split("\n")[1] for part in parts[1:])


def test_lags_share_one_shuffle_and_one_sort(spark, sf):
    found = plan(sales_lags(t.Stages(spark, sf).curated().history))
    assert found.count("Exchange") == 1 and len(re.findall(r"[-:] ?\*?(?:\(\d+\) )?Sort \[", found)) == 1


def test_range_reaches_the_scan(spark, sf):
    found = plan(contract.queries()["source_range"](spark, sf), "formatted")
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(date,1997-03-01\), LessThan\(date,1998-03-01\)", found)
    assert "ReadSchema: struct<store:int,product:string,date:date,sales:double>" in found


def test_trim_reaches_the_scan(spark, sf):
    found = plan(contract.queries()["entity_trim"](spark, sf), "formatted")
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(o_orderdate", found)
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in found


def test_lookup_reads_one_partition(spark, sf):
    found = plan(contract.queries()["forecast_for_store"](spark, sf), "formatted")
    assert re.search(r"PartitionFilters: .*store#\d+ = 1", found)


def test_only_needed_columns_are_read(spark, sf):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(contract.queries()["text_features"](spark, sf), "formatted")


def test_pages_are_a_top_k(spark, sf):
    found = plan(contract.queries()["part_search"](spark, sf))
    assert "TakeOrderedAndProject" in found and "rangepartitioning" not in found


def test_large_sides_are_not_broadcast(spark):
    big = spark.range(100)
    assert "ResolvedHint" in plan(small_side(big), "extended")
    assert "ResolvedHint" not in plan(small_side(big, max_cells=99), "extended")
    assert "ResolvedHint" not in plan(small_side(big, rows=10**9), "extended")


def test_day_aggregates_scan_an_entity_once(spark, sf):
    found = plan(contract.queries()["features_day_aggs"](spark, sf))
    assert found.count("FileScan") == 1 and "Join" not in found


def test_lines_move_for_the_order_header_alone(spark, sf):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(t.sales_lines(spark, sf))
        invoices = plan(contract.queries()["invoice_join"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", found)
    assert "l_partkey" not in moved and "l_suppkey" not in moved
    assert "hashpartitioning(l_partkey" not in invoices
