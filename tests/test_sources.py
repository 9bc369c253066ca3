import datetime as dt
import json

import pytest

from demandkit.config import ForecastConfig, load_config, store_table
from demandkit.operators.grain import to_grain
from demandkit.operators.template import future_template, recent_profile
from demandkit.operators.weather import VENDOR_COLUMNS
from demandkit.runtime import settle
from demandkit.sources import files, registers, windows
from demandkit.sources.registry import date_range, load_sales, register, registered


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


HEADER = "index,store,product,date,sales,price\n"


def test_folder_scan_skips_empty_and_differing_files(spark, tmp_path, rows):
    folder = tmp_path / "sales"
    put(folder, "a_empty.csv", "")
    put(folder, "b_blank.csv", " ")
    put(folder, "c.csv", HEADER + "1,1,x,2024-01-01,2.0,3.5\n2,1,\"y, z\",2024-01-02,,4\n")
    put(folder, "d_other.csv", "index,store,product,date,sales\n3,1,x,2024-01-03,2.0\n")
    put(folder, "e.csv", HEADER.replace("\n", "\r\n") + "4,2,x,2024-01-04,5.0,1\r\n")
    put(folder, "f_order.csv", "store,index,product,date,sales,price\n1,5,x,2024-01-05,1,1\n")
    df = files.scan_csv_folder(spark, str(folder))
    assert dict(df.dtypes) == {
        "index": "bigint", "store": "int", "product": "string", "date": "date", "sales": "double", "price": "string",
    }
    assert rows(df, "index", "product", "sales", "price") == [
        (1, "x", 2.0, "3.5"), (2, "y, z", None, "4"), (4, "x", 5.0, "1"),
    ]


def test_quoted_headers_are_the_same_columns(spark, tmp_path, rows):
    folder = tmp_path / "sales"
    put(folder, "a.csv", HEADER + "1,1,x,2024-01-01,2.0,3.5\n")
    put(folder, "b.csv", '"index","store","product","date","sales","price"\n2,1,"y, z",2024-01-02,1.0,4\n')
    put(folder, "c.csv", "index,store\n3,1\n")
    assert rows(files.scan_csv_folder(spark, str(folder)), "index", "product") == [(1, "x"), (2, "y, z")]
    assert [(r.path.rsplit("/", 1)[-1], r.header) for r in files.skipped_files(spark, str(folder)).collect()] == [("c.csv", "index,store")]


def test_bad_lines_stop_the_scan_and_are_listed(spark, tmp_path, rows):
    folder = tmp_path / "sales"
    put(folder, "a.csv", HEADER + "1,1,x,2024-01-01,2.0,3.5\n2,1,x,someday,2.0,3\n3,1,x,2024-01-03,much,3\n4,1,x,2024-01-04,2.0,4\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        files.scan_csv_folder(spark, str(folder)).collect()
    assert rows(files.rejected_lines(spark, str(folder)), "line") == [("2,1,x,someday,2.0,3",), ("3,1,x,2024-01-03,much,3",)]


def test_attributes_get_their_declared_types(spark, tmp_path):
    put(tmp_path / "s", "a.csv", HEADER + "1,1,x,2024-01-01,2.0,1.0\n2,1,x,2024-01-01,2.0,1.0\n3,1,x,2024-01-01,2.0,4.0\n")
    config = ForecastConfig(attributes=(("price", "double"),))
    lines = files.scan_csv_folder(spark, str(tmp_path / "s"), config.attribute_types())
    assert to_grain(lines).first()["price"] == 2.0


def test_weather_files_with_more_columns_are_read(spark, tmp_path, rows):
    put(tmp_path / "w", "a.csv", "Date time,Temperature\n01/01/2024 00:00:00,1\n")
    put(tmp_path / "w", "b.csv", "Date time,Temperature,Wind Speed\n01/02/2024 00:00:00,2,7\n")
    assert rows(files.scan_weather_history(spark, str(tmp_path / "w")), "temperature", "wind_speed") == [(1.0, None), (2.0, 7.0)]


def test_folder_without_data(spark, tmp_path):
    put(tmp_path / "none", "a.csv", "")
    with pytest.raises(FileNotFoundError):
        files.scan_csv_folder(spark, str(tmp_path / "none"))


def test_weather_files_keep_the_later_of_repeated_rows(spark, tmp_path, rows):
    header = "Date time,Temperature\n"
    put(tmp_path / "w", "weather_2024-01-01_21d.csv", header + "01/01/2024 00:00:00,1\n01/21/2024 00:00:00,2\n")
    put(tmp_path / "w", "weather_2024-01-21_21d.csv", header + "01/21/2024 00:00:00,3\n02/10/2024 00:00:00,4\n")
    found = files.scan_weather_history(spark, str(tmp_path / "w"))
    assert rows(found) == [
        ("01/01/2024 00:00:00", 1.0), ("01/21/2024 00:00:00", 3.0), ("02/10/2024 00:00:00", 4.0),
    ]


def test_weather_forecast_gets_canonical_names(spark, tmp_path):
    put(tmp_path / "f", "forecast.csv", "Date time,Chance Precipitation (%),Conditions\n01/01/2024 00:00:00,0.5,Rain\n")
    df = files.scan_weather_forecast(spark, str(tmp_path / "f"))
    assert df.columns == ["date_time", VENDOR_COLUMNS["Chance Precipitation (%)"], "Conditions"]


def test_export_and_entities(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "x")], "ID int, Produkt string")
    files.write_export(df, str(tmp_path / "export"))
    back = spark.read.option("header", True).csv(str(tmp_path / "export"))
    assert rows(back) == [("1", "x")]
    files.write_stage(df, str(tmp_path / "trans" / "weather"))
    files.write_stage(df, str(tmp_path / "trans" / "events.parquet"))
    found = files.discover_entities(spark, str(tmp_path / "trans"))
    assert list(found) == ["events", "weather"]
    assert rows(found["weather"]) == [(1, "x")]


def test_stage_writes_replace_only_their_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "stage")
    files.write_stage(spark.createDataFrame([(1, "a"), (2, "b")], "store int, v string"), path, ["store"])
    files.write_stage(spark.createDataFrame([(2, "c")], "store int, v string"), path, ["store"])
    assert rows(spark.read.parquet(path), "store", "v") == [(1, "a"), (2, "c")]


def invoice(number, deleted=None, category="7", items=()):
    return {
        "invoice_id": number, "invoice_total": 10.0, "invoice_deleted_at": deleted, "customerCategory_id": category,
        "tableArea_id": None, "paymentMethod_id": "1", "address": {"company": "c", "city": "Mainz"},
        "items": [
            {"item_id": i, "invoice_id": number, "item_qty": q, "item_timestamp": f"2024-01-0{d}T10:00:00Z",
             "item_product_name": "x", "paymentMethod_id": "9"}
            for i, q, d in items
        ],
    }


def test_invoices(spark, tmp_path, rows):
    page = {"invoices": [
        invoice(1, items=[(11, 2.0, 1), (12, 3.0, 2)]),
        invoice(2, deleted="2024-01-05T00:00:00Z", category=None, items=[(21, 4.0, 3)]),
        invoice(3, items=[]),
    ]}
    put(tmp_path / "inv", "page1.json", json.dumps(page))
    config = ForecastConfig(register="invoices", store=5)
    df = load_sales(spark, config, str(tmp_path / "inv"))
    assert rows(df, "index", "store", "date", "sales", "customerCategory_id", "tableArea_id", "paymentMethod_id_x") == [
        (11, 5, dt.date(2024, 1, 1), 2.0, "cat_7", None, "cat_1"),
        (12, 5, dt.date(2024, 1, 2), 3.0, "cat_7", None, "cat_1"),
        (21, 5, dt.date(2024, 1, 3), 0.0, None, None, "cat_1"),
    ]
    assert len(df.columns) == len(registers.INVOICE_FIELDS) + 1
    ranged = load_sales(spark, config, str(tmp_path / "inv"), "2024-01-02", dt.date(2024, 1, 2))
    assert rows(ranged, "index") == [(12,)]


def test_invoices_reach_the_grain(spark, tmp_path, rows):
    page = {"invoices": [invoice(1, items=[(11, 2.0, 1), (12, 3.0, 1)]), invoice(2, items=[(21, 4.0, 3)])]}
    put(tmp_path / "inv", "page1.json", json.dumps(page))
    grain = to_grain(load_sales(spark, ForecastConfig(register="invoices"), str(tmp_path / "inv")))
    assert rows(grain, "date", "sales", "address_city", "customerCategory_id", "tableArea_id") == [
        (dt.date(2024, 1, 1), 5.0, "Mainz", "cat_7", None), (dt.date(2024, 1, 3), 4.0, "Mainz", "cat_7", None),
    ]
    assert dict(grain.dtypes)["invoice_deleted_at"] == "timestamp"
    profile = recent_profile(grain, measures_too=("sales",))
    assert future_template(profile).count() == 7


def test_missing_whitelisted_field_is_an_error(spark):
    with pytest.raises(Exception, match="invoice_total"):
        registers.sales_from_invoices(spark.createDataFrame([(1,)], "item_id long"))


def test_panel(spark, tmp_path, rows):
    names = "store,brand,week,logmove,feat,price,AGE60,EDUC,ETHNIC,INCOME,HHLARGE,WORKWOM,HVAL150,SSTRDIST,SSTRVOL,CPDIST5,CPWVOL5"
    values = "0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0,1.1"
    put(tmp_path / "p", "panel.csv", f"{names}\n2,brand b,40,9.018695,0,3.87,{values}\n2,brand a,39,8,1,2,{values}\n")
    df = load_sales(spark, ForecastConfig(register="panel"), str(tmp_path / "p"), to_date="2018-01-08")
    assert df.columns == list(registers.PANEL_FIELDS)
    assert rows(df, "store", "product", "sales", "date") == [
        (2, "brand a", 2980, dt.date(2018, 1, 1)), (2, "brand b", 8255, dt.date(2018, 1, 8)),
    ]


def test_replay_and_registry(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, dt.date(2024, 1, n)) for n in range(1, 6)], "store int, date date")
    df.write.parquet(str(tmp_path / "r"))
    found = load_sales(spark, ForecastConfig(register="replay"), str(tmp_path / "r"), "2024-01-02", "2024-01-04")
    assert found.count() == 3
    assert {"invoices", "panel", "replay"} <= set(registered())
    with pytest.raises(KeyError, match="nowhere"):
        load_sales(spark, ForecastConfig(register="nowhere"), "x")

    @register("mine")
    def mine(spark, path, store, from_date, to_date):
        return spark.range(1)

    assert load_sales(spark, ForecastConfig(register="mine"), "x").count() == 1


def test_open_ranges(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),), (dt.datetime(2024, 1, 2),)], "ts timestamp")
    assert date_range(df, column="ts").count() == 2
    assert date_range(df, to_date="2024-01-01", column="ts").count() == 1
    assert date_range(df, from_date="2024-01-02", column="ts").count() == 1


def test_config(spark, tmp_path, rows):
    put(tmp_path, "c.toml", """
[base]
tomorrow = true
next_seven_days = true
rows_per_page = 20
store = 2
country = "DE"
register_plugin_name = "panel"
[[stores]]
store = 1
state = "HE"
city = "A"
store_name = "One"
[[stores]]
store = 2
state = "RP"
city = "B"
store_name = "Two"
""")
    config = load_config(str(tmp_path / "c.toml"))
    assert (config.store, config.rows_per_page, config.register) == (2, 20, "panel")
    assert config.horizons == ("tomorrow", "next_seven_days")
    assert config.for_store(1).store == 1
    with pytest.raises(KeyError):
        config.for_store(3)
    assert rows(store_table(spark, config.stores)) == [(1, "HE", "A", "One"), (2, "RP", "B", "Two")]


def test_planned_windows_follow_each_other(spark):
    today = dt.date(2018, 3, 5)
    found = [tuple(r) for r in windows.planned_windows(spark, today).orderBy("start_date").select("start_date", "end_date").collect()]
    expected, start = [], windows.FIRST_WINDOW
    while start < today:
        expected.append((start, start + dt.timedelta(days=28)))
        start += dt.timedelta(days=29)
    assert found == expected
    assert windows.planned_windows(spark, windows.FIRST_WINDOW).isEmpty()


def test_windows_are_loaded_again_within_the_grace_period(spark, rows):
    planned = windows.planned_windows(spark, dt.date(2018, 3, 2))
    names = [r["file_name"] for r in planned.orderBy("start_date").collect()]
    assert names[0] == "sales_2018-01-01_2018-01-29.csv"
    landed = spark.createDataFrame([(n,) for n in names], "file_name string")
    # the second window ends 2018-02-27: three days later is not before today
    assert rows(windows.windows_to_load(planned, landed), "file_name") == [(n,) for n in names[1:]]
    assert windows.windows_to_load(planned, landed.limit(0)).count() == len(names)


@pytest.mark.parametrize("today, starts", [(dt.date(2024, 1, 20), [1]), (dt.date(2024, 1, 21), [1, 21])])
def test_weather_windows(spark, today, starts):
    from pyspark.sql import functions as F

    landed = spark.createDataFrame([("weather_2023-12-12_21d.csv",), ("weather_2024-01-01_21d.csv",)], "file_name string")
    found = windows.weather_windows(landed, F.lit(today)).orderBy("start_date").collect()
    assert [r["start_date"].day for r in found] == starts
    assert found[0]["file_name"] == "weather_2024-01-01_21d.csv"
    assert found[0]["end_date"] == dt.date(2024, 1, 21)


def test_one_pass_for_the_file_table_and_one_for_the_data(spark, tmp_path):
    folder = tmp_path / "sales"
    put(folder, "a.csv", HEADER + "1,1,x,2024-01-01,2.0,3.5\n")
    put(folder, "b.csv", "index,store\n3,1\n")
    table = files.file_table(spark, str(folder))
    assert [tuple(r) for r in table.files.select("length", "header").orderBy("header").collect()] == [(16, "index,store"), (62, HEADER.strip())]

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count(" text")

    assert scans(files.skipped_files(spark, str(folder), table)) == 0, "the folder is read again"
    assert scans(files.scan_csv_folder(spark, str(folder), table=table)) == 1
    assert scans(files.rejected_lines(spark, str(folder), table=table)) == 1


def test_values_that_span_lines(spark, tmp_path, rows):
    folder = tmp_path / "sales"
    put(folder, "a.csv", HEADER + '1,1,"x\ny ""z""",2024-01-01,2.0,3.5\n2,1,w,someday,1.0,1\n')
    put(folder, "b.csv", HEADER + "3,1,v,2024-01-03,1.0,1\n")
    lines = files.scan_csv_folder(spark, str(folder), spanning=True, going_on=True)
    assert rows(lines, "index", "product") == [(1, 'x\ny "z"'), (3, "v")]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.scan_csv_folder(spark, str(folder), spanning=True).collect()
    assert rows(files.rejected_lines(spark, str(folder), spanning=True), "line") == [("2,1,w,someday,1.0,1",)]


def test_versions_of_a_stage_store(spark, tmp_path, rows):
    out = str(tmp_path / "out")

    def run(value, fail=False):
        with files.new_version(spark, out) as version:
            files.write_stage(spark.createDataFrame([(value,)], "v int"), f"{version}/table")
            if fail:
                raise RuntimeError("killed")

    def current():
        return rows(spark.read.parquet(f"{files.current_version(spark, out)}/table"))

    with pytest.raises(FileNotFoundError):
        files.current_version(spark, out)
    run(1)
    with pytest.raises(RuntimeError):
        run(2, fail=True)
    assert current() == [(1,)] and len(list((tmp_path / "out" / "versions").iterdir())) == 2
    old = files.current_version(spark, out)
    run(3)
    assert current() == [(3,)] and rows(spark.read.parquet(f"{old}/table")) == [(1,)]
    run(4)
    assert current() == [(4,)] and len(list((tmp_path / "out" / "versions").iterdir())) == 2


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sales"
    # Many files in a task, and files of several batches.
    for number in range(12):
        put(folder, f"{number:02d}.csv", HEADER.replace("price", f"p{number}") + f"{number},1,x,2024-01-01,2.0,1\n" * (1 if number % 3 else 25_000))
    plans = []

    def stored(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, purpose)

    monkeypatch.setattr(files, "settle", stored)
    table = files.file_table(spark, str(folder))
    found = {r.path.rsplit("/", 1)[-1]: r.header for r in table.files.collect()}
    assert found == {f"{n:02d}.csv": f"index,store,product,date,sales,p{n}" for n in range(12)}
    assert table.files.count() == 12 and table.first[-1] == "p0"
    assert "Sort" not in plans[0]
