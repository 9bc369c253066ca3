import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandkit.sources import windows
from demandkit.streaming import jobs

LINES = "index long, ts timestamp, product string, sales double"
WEATHER = "ts timestamp, temperature double"


def at(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("landing", "target", "progress")]


def land(spark, path, schema, *data):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def test_repeats_are_dropped_within_and_across_runs(spark, folders, rows):
    landing, target, progress = folders
    schema = spark.createDataFrame([], LINES).schema

    def run():
        jobs.ingest_lines(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, progress)

    land(spark, landing, LINES, (1, at(1), "x", 1.0), (1, at(1), "x", 1.0), (2, at(2), "y", 2.0))
    run()
    land(spark, landing, LINES, (2, at(2), "y", 2.0), (3, at(1), "late", 3.0), (4, at(9), "z", 4.0))
    run()
    land(spark, landing, LINES, (5, at(1), "backfilled", 5.0), (4, at(9), "z", 4.0), (6, at(10), "w", 6.0))
    run()
    run()
    assert rows(jobs.ingested_lines(spark, target), "index") == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_row_ids_once_across_days_and_lines_without_id(spark, folders):
    landing, target, progress = folders
    schema = spark.createDataFrame([], LINES).schema

    def run():
        jobs.ingest_lines(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, progress)

    land(spark, landing, LINES, (1, at(1), "x", 1.0), (None, at(1), "a", 1.0), (None, at(1), "b", 2.0))
    run()
    land(spark, landing, LINES, (1, at(5), "shifted", 1.0), (2, at(6), "y", 2.0), (2, at(4), "y", 2.0), (None, at(1), "c", 3.0))
    run()
    stored = sorted((tuple(r) for r in jobs.ingested_lines(spark, target).select("index", F.dayofmonth("ts")).collect()), key=repr)
    assert stored == [(1, 1), (2, 4), (None, 1), (None, 1), (None, 1)]


def test_weather_days_are_replaced_when_they_change(spark, folders, rows):
    landing, target, progress = folders
    schema = spark.createDataFrame([], WEATHER).schema

    def run():
        jobs.ingest_weather(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, progress)

    land(spark, landing, WEATHER, (at(1), 1.0), (at(2, 1), 4.0))
    run()
    assert rows(jobs.weather_days(spark, target), "date", "temperature") == [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 4.0)]
    land(spark, landing, WEATHER, (at(2, 2), 8.0), (at(3), 2.0))
    run()
    assert rows(jobs.weather_days(spark, target), "date", "temperature") == [
        (dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 6.0), (dt.date(2024, 1, 3), 2.0),
    ]


def test_a_new_checkpoint_replaces_nothing(spark, folders, rows, tmp_path):
    landing, target, _ = folders
    schema = spark.createDataFrame([], LINES).schema
    for run, line in enumerate([(1, at(1), "x", 1.0), (2, at(1), "y", 2.0), (3, at(1), "z", 3.0)]):
        land(spark, landing, LINES, line)
        jobs.ingest_lines(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, str(tmp_path / f"progress-{run}"))
        assert rows(jobs.ingested_lines(spark, target), "index") == [(n,) for n in range(1, run + 2)]


def test_a_batch_that_fails_half_way_is_whole_after_the_next_run(spark, folders, rows, monkeypatch):
    landing, target, progress = folders
    schema = spark.createDataFrame([], LINES).schema

    def run():
        jobs.ingest_lines(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, progress)

    land(spark, landing, LINES, (1, at(1), "x", 1.0))
    run()
    land(spark, landing, LINES, (1, at(1), "x", 1.0), (2, at(2), "y", 2.0), (3, at(3), "z", 3.0))
    append = jobs._append

    def broken(rows_, path, *partitions):
        if path.endswith("/ids"):
            raise RuntimeError("lost")
        append(rows_, path, *partitions)

    monkeypatch.setattr(jobs, "_append", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(jobs, "_append", append)
    assert rows(jobs.ingested_lines(spark, target), "index") == [(1,)]
    run()
    run()
    assert rows(jobs.ingested_lines(spark, target), "index") == [(1,), (2,), (3,)]
    before = spark.read.parquet(f"{target}/lines").count()
    assert len(jobs.remove_unpublished(spark, target, ["lines", "ids"])) == 1
    assert (before, spark.read.parquet(f"{target}/lines").count()) == (5, 3)
    assert rows(jobs.ingested_lines(spark, target), "index") == [(1,), (2,), (3,)]


def test_a_batch_reads_the_buckets_of_its_ids_only(spark, folders):
    landing, target, progress = folders
    schema = spark.createDataFrame([], LINES).schema
    many = spark.range(5000).select(F.col("id").alias("index"), F.lit(at(1)).cast("timestamp").alias("ts"), F.lit("x").alias("product"), F.lit(1.0).alias("sales"))
    many.coalesce(1).write.parquet(landing)
    jobs.ingest_lines(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, progress, buckets=64)
    size = len(jobs.known_ids(spark, target, range(64)).inputFiles())
    few = spark.createDataFrame([(17,), (4711,)], "index long").select(jobs.id_bucket(F.col("index"), 64).alias("b"))
    hit = [r.b for r in few.collect()]
    read = jobs.known_ids(spark, target, hit)
    files = [f for f in read.inputFiles() if "/ids/" in f]
    assert 64 <= size and {f.split("bucket=")[1].split("/")[0] for f in files} == {str(b) for b in hit}
    assert {17, 4711} <= {r["index"] for r in read.collect()}


def test_an_hour_ten_days_late_changes_its_day(spark, folders, rows, tmp_path):
    landing, target, progress = folders
    schema = spark.createDataFrame([], WEATHER).schema

    def run(checkpoint=progress):
        jobs.ingest_weather(jobs.landed_stream(spark, schema, landing, "*.parquet"), target, checkpoint)

    land(spark, landing, WEATHER, (at(1, 1), 1.0), (at(11, 1), 4.0))
    run()
    land(spark, landing, WEATHER, (at(1, 2), 3.0), (at(12, 1), 5.0), (None, 9.0))
    run()
    days = [(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 11), 4.0), (dt.date(2024, 1, 12), 5.0)]
    assert rows(jobs.weather_days(spark, target), "date", "temperature") == days
    run(str(tmp_path / "again"))
    assert rows(jobs.weather_days(spark, target), "date", "temperature") == days
    land(spark, landing, WEATHER, (at(1, 2), 7.0))
    run()
    assert rows(jobs.weather_days(spark, target), "date", "temperature")[0] == (dt.date(2024, 1, 1), 4.0)


def test_a_load_shows_once_it_is_whole(spark, folders, rows):
    landing, target, progress = folders
    schema = "window date, load int, sales double"
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 30)

    def run():
        stream = jobs.landed_stream(spark, schema, landing, "*.parquet")
        jobs.ingest_windows(stream, target, progress, F.col("window"), F.col("load"))

    def announce(*loads):
        jobs.announce_loads(target, spark.createDataFrame(loads, "window_start date, load_id int, n_lines int"))

    def current():
        return rows(jobs.current_windows(spark, target), "window", "sales")

    land(spark, landing, schema, (first, 1, 1.0), (first, 1, 2.0), (second, 1, 3.0))
    run()
    assert current() == []
    announce((first, 1, 2), (second, 1, 1))
    old = [(first, 1.0), (first, 2.0), (second, 3.0)]
    assert current() == old
    announce((second, 2, 3))
    for n, sales in enumerate((4.0, 5.0, 6.0)):
        assert current() == old
        land(spark, landing, schema, (second, 2, sales))
        run()
    assert current() == [(first, 1.0), (first, 2.0), (second, 4.0), (second, 5.0), (second, 6.0)]
    planned = spark.createDataFrame([(d, d + dt.timedelta(days=28), f"{d}.csv", dt.date(2024, 3, 2)) for d in (first, second, dt.date(2024, 2, 28))], "start_date date, end_date date, file_name string, today date")
    landed = jobs.complete_loads(spark, target)
    for grace, wanted in ((3, [dt.date(2024, 2, 28)]), (4, [second, dt.date(2024, 2, 28)]), (40, [first, second, dt.date(2024, 2, 28)])):
        found = windows.loads_to_plan(planned, landed, grace)
        assert [r[0] for r in rows(found, "start_date")] == wanted
