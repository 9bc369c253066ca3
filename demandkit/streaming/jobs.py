"""Incremental loads as Structured Streaming jobs.

Each job processes what has landed since its last run and stops (``availableNow``).
Progress lives in a checkpoint folder. Each batch writes a load of its own into the
target, under a name that no other checkpoint and no earlier attempt has, and publishes
it last, as one row of the target's table ``loads``. Readers see published loads only. So
a batch that fails, or that runs again, leaves no half and no second copy, and a new
checkpoint folder over an old target replaces nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from demandkit.operators.weather import daily
from demandkit.runtime import names_in, read_text, remove, scratch, settle, small_side, write_once

#: Buckets of the stored row ids.
BUCKETS = 256
LOADS = "stream string, batch long, load string, n_rows long"


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def landed_stream(spark: SparkSession, schema, path: str, glob: str = "*", fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", True).load(path)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there before."""
    return any(not name.startswith(("_", ".")) for name in names_in(spark, path))


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint folder, kept in it; a new folder gets a new one."""
    path = f"{checkpoint.rstrip('/')}/stream_name"
    if read_text(spark, path) is None:
        write_once(spark, path, uuid.uuid4().hex[:12])
    return read_text(spark, path)


def published(spark: SparkSession, target: str) -> DataFrame:
    """The loads that count: one row per batch."""
    path = f"{target}/loads"
    return spark.read.schema(LOADS).parquet(path) if has_rows(spark, path) else spark.createDataFrame([], LOADS)


def of_published(rows: DataFrame, target: str, besides: str | None = None) -> DataFrame:
    """The rows of published loads, and of the load that is being written."""
    loads = published(rows.sparkSession, target).select("load")
    if besides:
        loads = loads.unionByName(rows.sparkSession.createDataFrame([(besides,)], "load string"))
    return rows.join(small_side(loads), "load", "left_semi")


def remove_unpublished(spark: SparkSession, target: str, tables: Sequence[str]) -> list[str]:
    """Delete what failed batches left; to be called while no stream writes. Returns the loads."""
    known = {f"load={r.load}" for r in published(spark, target).select("load").collect()}
    gone = []
    for table in tables:
        for first in names_in(spark, f"{target}/{table}"):
            inner = [first] if first.startswith("load=") else [f"{first}/{n}" for n in names_in(spark, f"{target}/{table}/{first}") if n.startswith("load=")]
            for path in inner:
                if path.rpartition("/")[2] not in known:
                    remove(spark, f"{target}/{table}/{path}")
                    gone.append(path.rpartition("=")[2])
    return sorted(set(gone))


def _run(stream: DataFrame, target: str, checkpoint: str, store: Callable[[DataFrame, str], int]) -> None:
    """Give every batch that is not published yet to ``store``, with the name of its load."""
    name = stream_name(stream.sparkSession, checkpoint)

    def once(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not published(spark, target).filter((F.col("stream") == name) & (F.col("batch") == batch_id)).isEmpty():
            return
        load = f"{name}-{batch_id}-{uuid.uuid4().hex[:8]}"
        with scratch(spark, "batch"):
            n = store(batch, load)
        row = spark.createDataFrame([(name, batch_id, load, n)], LOADS)
        row.coalesce(1).write.mode("append").parquet(f"{target}/loads")

    _finish(stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _append(rows: DataFrame, path: str, *partitions: str) -> None:
    rows.write.mode("append").partitionBy(*partitions).parquet(path)


# --- sales lines ------------------------------------------------------------------


def id_bucket(row_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(row_id.cast("string")), F.lit(buckets)).cast("int")


def known_ids(spark: SparkSession, target: str, buckets: Sequence[int]) -> DataFrame | None:
    """Published row ids in the given buckets; the folders of other buckets are not even listed."""
    there = set(names_in(spark, f"{target}/ids"))
    paths = [f"{target}/ids/bucket={b}" for b in sorted(buckets) if f"bucket={b}" in there]
    if not paths:
        return None
    return of_published(spark.read.option("basePath", f"{target}/ids").parquet(*paths), target)


def ingest_lines(
    stream: DataFrame, target: str, checkpoint: str, timestamp: str = "ts", row_id: str = "index", buckets: int = BUCKETS
) -> None:
    """Add new lines to ``target``, each row id once, however late.

    Stored ids are kept apart from the lines, in buckets by their hash. A batch reads the
    buckets that its own ids fall into, within the range of its ids, whatever the day; so a
    backfilled file of any age is kept, an id that lands again on another day is not, and what a
    small batch reads does not grow with all that is stored. Of lines with one id in a batch the
    earliest stays; lines without an id all stay. Lines without a timestamp have a
    partition of their own.
    """
    spark = stream.sparkSession

    def store(batch: DataFrame, load: str) -> int:
        dated = batch.withColumn("date", F.col(timestamp).cast("date"))
        named = dated.filter(F.col(row_id).isNotNull()).groupBy(row_id).agg(
            F.min_by(F.struct(*dated.columns), F.struct(timestamp)).alias("__line")
        )
        fresh = named.select("__line.*").unionByName(dated.filter(F.col(row_id).isNull()))
        fresh = settle(fresh.withColumn("__bucket", id_bucket(F.col(row_id), buckets)), "landed-lines")
        # At most ``buckets`` numbers, and two ids.
        hit = [r[0] for r in fresh.select("__bucket").filter("__bucket is not null").distinct().collect()]
        known = known_ids(spark, target, hit)
        if known is not None:
            least, greatest = fresh.agg(F.min(row_id), F.max(row_id)).first()
            seen = known.filter(F.col(row_id).between(F.lit(least), F.lit(greatest))).select(row_id)
            fresh = settle(fresh.join(seen, row_id, "left_anti"), "new-lines")
        loaded = fresh.withColumn("load", F.lit(load))
        _append(loaded.drop("__bucket"), f"{target}/lines", "date", "load")
        ids = loaded.filter("__bucket is not null").select(row_id, F.col("__bucket").alias("bucket"), "load")
        _append(ids.repartition("bucket").sortWithinPartitions("bucket", row_id), f"{target}/ids", "bucket", "load")
        return fresh.count()

    _run(stream, target, checkpoint, store)


def ingested_lines(spark: SparkSession, target: str) -> DataFrame:
    return of_published(spark.read.parquet(f"{target}/lines"), target).drop("date", "load")


# --- weather ----------------------------------------------------------------------


def ingest_weather(
    hourly: DataFrame, target: str, checkpoint: str, timestamp: str = "ts", key: Sequence[str] | None = None
) -> None:
    """Keep a daily weather table current, however late an hour comes.

    Hours are stored by day; of hours with one ``key`` (the timestamp, unless given) the one
    stored last counts. A batch works out again the days that it touches, from all their
    hours, and replaces them whole. Nothing is dropped for being late, no state grows, and
    days that no hour came for are not read.
    """
    spark = hourly.sparkSession
    keys = list(key or [timestamp])

    def store(batch: DataFrame, load: str) -> int:
        timed = batch.withColumn("date", F.col(timestamp).cast("date")).filter("date is not null")
        arrived = settle(timed.withColumns({"stored_at": F.current_timestamp(), "load": F.lit(load)}), "hours")
        _append(arrived, f"{target}/hours", "date", "load")
        touched = settle(arrived.select("date").distinct(), "touched-days")
        hours = of_published(spark.read.parquet(f"{target}/hours"), target, besides=load)
        hours = hours.join(small_side(touched), "date", "left_semi")
        rest = [c for c in hours.columns if c not in (*keys, "date")]
        latest = hours.groupBy("date", *keys).agg(F.max_by(F.struct(*rest), F.struct("stored_at", "load")).alias("__hour"))
        replace_days(daily(latest.select("date", *keys, "__hour.*")), f"{target}/days")
        return arrived.count()

    _run(hourly, target, checkpoint, store)


def replace_days(days: DataFrame, target: str) -> None:
    """Replace exactly the days that are given."""
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(target)


def weather_days(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/days")


# --- sales windows ----------------------------------------------------------------


def ingest_windows(stream: DataFrame, target: str, checkpoint: str, window: Column, load: Column) -> None:
    """Store loads of sales windows side by side.

    A load of a window may come in several batches; each batch notes how many of its lines it
    brought. Which loads are whole, :func:`announce_loads` tells.
    """

    def store(batch: DataFrame, part: str) -> int:
        lines = settle(batch.withColumns({"window_start": window, "load_id": load, "load": F.lit(part)}), "window-lines")
        _append(lines, f"{target}/lines", "window_start", "load_id", "load")
        counts = lines.groupBy("window_start", "load_id").agg(F.count(F.lit(1)).alias("n_lines"))
        _append(counts.withColumn("load", F.lit(part)).coalesce(1), f"{target}/counts", "load")
        return lines.count()

    _run(stream, target, checkpoint, store)


def announce_loads(target: str, loads: DataFrame) -> None:
    """Say how many lines (``n_lines``) the loads (``window_start``, ``load_id``) have in all, once they
    are known: a load shows from when that many have come."""
    loads.select("window_start", "load_id", F.col("n_lines").cast("long").alias("n_lines")).write.mode("append").parquet(f"{target}/announced")


def complete_loads(spark: SparkSession, target: str) -> DataFrame:
    """window_start and load_id of the loads that have come in full."""
    come = of_published(spark.read.parquet(f"{target}/counts"), target)
    come = come.groupBy("window_start", "load_id").agg(F.sum("n_lines").alias("come"))
    if not has_rows(spark, f"{target}/announced"):
        return come.select("window_start", "load_id").limit(0)
    told = spark.read.parquet(f"{target}/announced").groupBy("window_start", "load_id").agg(F.max("n_lines").alias("n_lines"))
    # A load without lines has come as soon as it is announced.
    both = told.join(come, ["window_start", "load_id"], "left")
    return both.filter(F.coalesce("come", F.lit(0)) >= F.col("n_lines")).select("window_start", "load_id")


def current_windows(spark: SparkSession, target: str) -> DataFrame:
    """Lines of the newest complete load of every window; other loads are not read.

    The newest loads, one row per window, are stored and counted; broadcast, they
    prune the scan to their partitions.
    """
    newest = complete_loads(spark, target).groupBy("window_start").agg(F.max("load_id").alias("load_id"))
    newest = small_side(settle(newest, "newest-loads"))
    lines = spark.read.parquet(f"{target}/lines").join(newest, ["window_start", "load_id"], "left_semi")
    return of_published(lines, target).drop("load", "load_id", "window_start")
