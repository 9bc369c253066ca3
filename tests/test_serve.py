import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from demandkit.functions.numbers import half_even, range_end, range_text
from demandkit.operators import serve, views

SCHEMA = "store int, product string, date date, forecast double"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture(scope="module")
def predictions(spark):
    data = [(s, p, day(n), f + n) for s, p, f in ((1, "b", 9.0), (1, "a", 19.0), (2, "a", 0.5)) for n in range(1, 10)]
    data.append((2, "only first day", day(1), 3.0))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def orders(predictions):
    return serve.order_table(predictions).cache()


def test_half_even(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, 2.4999999999, 3.5, -0.5)], "v double")
    assert [r[0] for r in df.select(half_even(F.col("v"))).collect()] == [0, 2, 2, 2, 4, 0]


def test_ranges_read_both_ways_of_writing(spark):
    df = spark.createDataFrame([("72-94",), ("72 - 94",), ("none",), (None,)], "r string")
    found = df.select(range_end(F.col("r"), 1), range_end(F.col("r"), 2)).collect()
    assert [tuple(r) for r in found] == [(72, 94), (72, 94), (0, 0), (0, 0)]
    assert df.limit(1).select(range_text(F.lit(1.5), F.lit(7.2))).first()[0] == "2 - 7"


def test_order_table(orders, rows):
    assert orders.columns == list(serve.ORDER_COLUMNS)
    assert rows(orders) == [
        (1, 1, "a", 20, "17 - 23", 21, "18 - 24", 161, "137 - 185"),
        (1, 2, "a", 2, "1 - 2", 2, "2 - 3", 32, "27 - 36"),
        (2, 1, "b", 10, "8 - 12", 11, "9 - 13", 91, "77 - 105"),
    ]


def test_a_pair_needs_both_first_days(orders):
    assert orders.filter("product = 'only first day'").isEmpty()


def test_only_the_first_seven_dates_are_served(predictions):
    ranked = serve.with_day_number(predictions)
    assert ranked.agg(F.max("date")).first()[0] == day(7)
    assert ranked.select("day_no").distinct().count() == 7


def test_gaps_do_not_break_day_numbers(spark, rows):
    df = spark.createDataFrame([(1, "a", day(n), 1.0) for n in (2, 5, 9)], SCHEMA)
    assert rows(serve.with_day_number(df), "date", "day_no") == [(day(2), 1), (day(5), 2), (day(9), 3)]


def test_joined_horizons_equal_the_single_aggregation(predictions, rows):
    joined, totals = serve.join_horizons(predictions), serve.horizon_totals(predictions)
    assert joined.columns == totals.columns
    assert rows(joined) == rows(totals)


def test_positions_equal_plain_numbering(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 != 0, (F.col("id") % 7).cast("int")).alias("store"),
        F.format_string("p%05d", (F.col("id") * 7919) % 3000).alias("product"),
    )
    numbered = serve.position_within(df, ["store"], ["product"], "id")
    plain = df.withColumn("id", F.row_number().over(Window.partitionBy("store").orderBy("product")))
    assert dict(numbered.dtypes)["id"] == "int" and df.filter("store IS NULL").count() > 0
    assert rows(numbered, "store", "product", "id") == rows(plain, "store", "product", "id")


def test_lookup(orders, rows):
    found = views.forecast_for_store(orders, 1)
    assert "store" not in found.columns and found.count() == 2
    with pytest.raises(views.UnknownStoreError, match="Store 99"):
        views.forecast_for_store(orders, 99)


def test_export(orders, rows):
    found = views.forecast_for_store(orders, 1)
    assert views.order_export(found, "tomorrow").columns == ["ID", "Produkt", "Bestellung Morgen"]
    assert views.order_export(found, "day_after_tomorrow").columns == ["ID", "Produkt", "Bestellung Übermorgen"]
    assert rows(views.order_export(found, "next_seven_days"))[0] == (1, "a", 161)
    assert len(views.order_export(found, "other").columns) == 8
    with pytest.raises(KeyError, match="next7_order_qty"):
        views.order_export(found.drop("next7_order_qty"), "tomorrow")


def test_overrides_replace_only_what_was_entered(spark, orders, rows):
    entered = spark.createDataFrame(
        [(1, "a", 99, None), (2, "zzz", 1, 1)],
        "store int, product string, tomorrow_order_qty long, next7_order_qty long",
    )
    changed = views.apply_overrides(orders, entered)
    assert changed.columns == orders.columns
    assert rows(changed, "store", "product", "tomorrow_order_qty", "next7_order_qty") == [
        (1, "a", 99, 161), (1, "b", 10, 91), (2, "a", 2, 32),
    ]


def test_overrides_for_one_pair_twice_stop_the_job(spark, orders):
    entered = spark.createDataFrame([(1, "a", 9), (1, "a", 8)], "store int, product string, tomorrow_order_qty long")
    with pytest.raises(Exception, match="several overrides for 1 a"):
        views.apply_overrides(orders, entered).collect()


def test_dashboard(orders, rows):
    assert rows(views.dashboard_kpis(orders)) == [(1, 30, 2, 7), (2, 2, 1, 7)]
    assert rows(views.dashboard_bands(orders)) == [(1, 25, 10), (2, 1, 1)]


def test_unreadable_ranges_count_zero(spark, rows):
    df = spark.createDataFrame([(1, "5 - 9"), (1, "?")], "store int, tomorrow_order_range string")
    assert rows(views.dashboard_bands(df)) == [(1, 5, 4)]


@pytest.fixture(scope="module")
def menu(spark):
    names = ["Brot", "Roggen Brot", "Brezel", "Kuchen", "brot klein"]
    return spark.createDataFrame(
        [(i, n, q) for i, (n, q) in enumerate(zip(names, (5, 9, 9, 1, 7)), 1)], "id int, product string, tomorrow_order_qty int"
    )


@pytest.mark.parametrize(
    "query, ids", [("BROT", [1, 2, 5]), ("brot roggen", [2]), ("", [1, 2, 3, 4, 5]), (None, [1, 2, 3, 4, 5]), ("4", [4]), ("x", [])]
)
def test_search(menu, query, ids):
    assert sorted(r["id"] for r in views.search(menu, query).collect()) == ids


def test_pages_and_sort(menu):
    def ids(**options):
        return [r["id"] for r in views.table_page(menu, sort_by="tomorrow_order_qty", ascending=False, **options).collect()]

    assert ids(page=1, rows_per_page=2) == [2, 3]
    assert ids(page=2, rows_per_page=2) == [5, 1]
    assert ids(page=3, rows_per_page=2) == [4]
    assert ids(page=4, rows_per_page=2) == []


def test_visible_columns_and_labels(orders):
    columns = [c for c in orders.columns if c != "store"]
    assert views.visible_columns(columns, ["tomorrow"]) == [
        "id", "product", "tomorrow_order_qty", "tomorrow_order_range",
    ]
    assert views.visible_columns(columns, [], narrow=True) == [
        "id", "product", "tomorrow_order_qty", "day_after_order_qty",
    ]
    page = views.table_page(orders.drop("store"), horizons=("next_seven_days",), labels=True)
    assert page.columns == ["ID", "Produkt", "Bestellung Woche", "Vorschlag Woche"]


@pytest.mark.parametrize("ascending", [True, False])
def test_pages_by_key_are_the_pages_by_offset(spark, ascending):
    values = [None, 3.0, 1.0, 1.0, None, 2.0, 1.0, 3.0, float("nan"), 0.5, None]
    rows = [(i, None if i == 4 else f"p{i % 4}", v) for i, v in enumerate(values)] + [(None, "p", 1.0)]
    table = spark.createDataFrame(rows, "id int, product string, qty double")
    for sort_by in ("qty", "product"):
        last, seen = None, []
        while True:
            page = views.page_after(table, last, None, sort_by, ascending, rows_per_page=2)
            found = page.collect()
            offset = views.table_page(table, None, sort_by, ascending, 1 + len(seen) // 2, 2).collect()
            assert [str(r) for r in found] == [str(r) for r in offset]
            if not found:
                break
            seen += found
            last = views.last_key(page, sort_by, ascending)
        assert len(seen) == len(rows)
        assert views.last_key(page, sort_by, ascending) is None


def test_a_deep_page_costs_what_the_first_one_costs(spark, tmp_path):
    spark.range(100_000).select("id", F.lit("x").alias("product")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    deep = views.page_after(table, {"id": 90_000}, rows_per_page=10)
    assert [r.id for r in deep.collect()] == list(range(90_001, 90_011))
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and "GreaterThan(id,90000)" in plan
