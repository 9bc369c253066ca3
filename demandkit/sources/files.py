"""Landed files: guarded CSV folders, weather files, curated entities, sinks."""

from __future__ import annotations

import csv
import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from demandkit.operators.weather import canonical, latest_per_key
from demandkit.runtime import names_in, remove, settle, small_side, write_once
from demandkit.schemas import SALES_TYPES, WEATHER_TYPES

#: Different headers that a folder may have.
MAX_HEADERS = 1000
REJECTED = "__rejected"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the CSV files under a folder, with its file and where its part begins."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(path)
        .select(
            "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_block_start").alias("begin"),
        )
    )
    return lines.withColumn("value", F.regexp_replace("value", "^\ufeff", ""))


def _first_lines(lines: DataFrame) -> DataFrame:
    """The first line of each file, of lines of the files' first parts. A task gets its files one
    after the other, and their lines in order, so it has to remember only the file it is in."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            paths = batch.column("path")
            if batch.num_rows == 0 or paths[0].as_py() == paths[-1].as_py() == last:
                continue
            begins = np.flatnonzero(np.diff(paths.dictionary_encode().indices.to_numpy(), prepend=-1))
            begins = begins[paths[0].as_py() == last :]
            last = paths[-1].as_py()
            yield batch.take(pa.array(begins))

    return lines.mapInArrow(keep, lines.schema)


def _columns(header: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([header])))


@dataclass(frozen=True)
class FileTable:
    """The CSV files of a folder: a stored table of path, length and header, made in one pass.

    Whatever is asked about the folder is answered from it, and its data are read in one
    more pass.
    """

    spark: SparkSession
    path: str
    files: DataFrame
    #: Written headers by the columns they name; quoted and plain ones are the same.
    groups: dict[tuple[str, ...], list[str]]
    #: Columns of the first file; None without a file that has data.
    first: tuple[str, ...] | None

    def need(self) -> tuple[str, ...]:
        if self.first is None:
            raise FileNotFoundError(f"no CSV file with data under {self.path}")
        return self.first

    def with_columns(self, columns: Sequence[str]) -> DataFrame:
        return self.files.filter(F.col("header").isin(self.groups[tuple(columns)]))


def file_table(spark: SparkSession, path: str) -> FileTable:
    """The files of a folder that are not empty. The first line of a file is the one that
    comes first in its first part; parts behind it are not looked at."""
    lines = _lines(spark, path).filter("begin = 0").select("path", "length", F.col("value").alias("header"))
    headers = _first_lines(lines).filter(F.trim("header") != "")
    files = settle(headers, "file-table")
    found = files.groupBy("header").agg(F.min("path").alias("first")).orderBy("first").limit(MAX_HEADERS + 1).collect()
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found:
        groups.setdefault(_columns(row.header), []).append(row.header)
    return FileTable(spark, path, files, groups, next(iter(groups), None))


def skipped_files(spark: SparkSession, path: str, table: FileTable | None = None) -> DataFrame:
    """(path, header) of the files that :func:`scan_csv_folder` leaves out, for a report."""
    table = table or file_table(spark, path)
    accepted = table.groups.get(table.first, []) if table.first else []
    return table.files.filter(~F.col("header").isin(accepted)).select("path", "header")


def _schema(columns: Sequence[str], types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in columns])


def parsed_lines(table: FileTable, columns: Sequence[str], types: dict[str, T.DataType]) -> DataFrame:
    """The data lines of the files with these columns: their values, their file, and the whole line
    where it does not fit the types (``REJECTED``, else null)."""
    schema = _schema(columns, types).add(REJECTED, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    own = small_side(table.with_columns(columns).select(F.col("path").alias("file"), "header"))
    lines = _lines(table.spark, table.path).join(own, F.col("path") == F.col("file")).filter((F.trim("value") != "") & (F.col("value") != F.col("header")))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    # The text to parse depends on the join, so no pushed filter parses a header line.
    data = F.when(F.col("value") != F.col("header"), F.col("value"))
    return lines.select(F.from_csv(data, ddl, options).alias("row"), "path").select("row.*", F.col("path").alias("__file"))


def _spanning(table: FileTable, columns: Sequence[str], types: dict[str, T.DataType]) -> DataFrame:
    """As :func:`parsed_lines`, by a reader for which a quoted value may span lines; a file is one task."""
    paths = [r.path for r in table.with_columns(columns).select("path").orderBy("path").collect()]
    schema = _schema(columns, types).add(REJECTED, T.StringType())
    reader = table.spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(paths)
    # Written with all columns: the reader parses only those that are asked for, and what is
    # rejected must not depend on that.
    return settle(rows.withColumn("__file", F.col("_metadata.file_path")), "spanning-lines")


def _accepted(rows: DataFrame, going_on: bool = False) -> DataFrame:
    """The rows without the rejected ones, of which the first stops the job unless it is to go on."""
    if going_on:
        return rows.filter(F.col(REJECTED).isNull()).drop(REJECTED)
    stop = F.raise_error(F.concat(F.lit("[MALFORMED_RECORD] "), F.col("__file"), F.lit(": "), F.col(REJECTED)))
    return rows.filter(F.when(F.col(REJECTED).isNull(), True).otherwise(stop.cast("boolean"))).drop(REJECTED)


def scan_csv_folder(
    spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None, spanning: bool = False, table: FileTable | None = None,
    going_on: bool = False,
) -> DataFrame:
    """All files of a folder with the columns of its first file as one table.

    Empty files and files with other columns are skipped (:func:`skipped_files` lists
    them). Types come from ``types``; other columns are strings. A line that does not
    fit its types stops the job, unless it is told to go on; :func:`rejected_lines` lists those
    lines. With ``spanning``,
    a quoted value may hold line breaks; files cannot be split then. ``table`` is the folder's
    file table, if there is one already.
    """
    table = table or file_table(spark, path)
    known = {**SALES_TYPES, **(types or {})}
    read = _spanning if spanning else parsed_lines
    return _accepted(read(table, table.need(), known), going_on).drop("__file")


def rejected_lines(
    spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None, spanning: bool = False, table: FileTable | None = None
) -> DataFrame:
    """(path, line) of the lines of accepted files that do not fit their types."""
    table = table or file_table(spark, path)
    known = {**SALES_TYPES, **(types or {})}
    read = _spanning if spanning else parsed_lines
    rows = read(table, table.need(), known)
    return rows.filter(F.col(REJECTED).isNotNull()).select(F.col("__file").alias("path"), F.col(REJECTED).alias("line"))


def _all_weather(table: FileTable) -> DataFrame:
    """All weather files, whatever columns each has; columns a file lacks are NULL."""
    table.need()
    rows = None
    for columns in table.groups:
        part = _accepted(parsed_lines(table, columns, WEATHER_TYPES))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


def scan_weather_history(spark: SparkSession, path: str) -> DataFrame:
    """Weather files whose last row repeats as the first row of the next file.

    Of equal timestamps the row of the latest file stays, so the last row of the
    newest file is kept as well.
    """
    return latest_per_key(canonical(_all_weather(file_table(spark, path))), ["date_time"], ["__file"]).drop("__file")


def scan_weather_forecast(spark: SparkSession, path: str) -> DataFrame:
    return canonical(_all_weather(file_table(spark, path)).drop("__file"))


def discover_entities(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every Parquet table directly under a curated folder, named by its stem."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select(F.regexp_replace("path", r"^[a-z0-9]+:/*", "/").alias("path"))
    )
    root = "/" + folder.split(":", 1)[-1].strip("/") + "/"
    entry = F.split_part(F.substring_index("path", root, -1), F.lit("/"), F.lit(1))
    names = [r[0] for r in listed.select(entry).distinct().collect()]
    return {n.removesuffix(".parquet"): spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in sorted(names)}


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet between stages; only the partitions in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


#: Finished versions of a stage store that stay.
KEPT_VERSIONS = 2
_DONE = "FINISHED"


def _versions(spark: SparkSession, out: str) -> list[tuple[str, bool]]:
    """The version folders by age, and whether each was finished."""
    return [(v, _DONE in names_in(spark, f"{out}/versions/{v}")) for v in names_in(spark, f"{out}/versions")]


def current_version(spark: SparkSession, out: str) -> str:
    """The folder of the newest finished version."""
    done = [v for v, finished in _versions(spark, out) if finished]
    if not done:
        raise FileNotFoundError(f"no finished version under {out}")
    return f"{out}/versions/{done[-1]}"


@contextmanager
def new_version(spark: SparkSession, out: str, keep: int = KEPT_VERSIONS) -> Iterator[str]:
    """A folder for the tables of one run, which becomes the current version at the end.

    Nothing of an earlier run is touched: until the mark that finishes the folder is
    written, as one small file, readers see the version before. A run that fails leaves
    no mark. Then older versions than the ``keep`` newest go, and with them what failed runs
    before this one left.
    """
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    yield f"{out}/versions/{version}"
    write_once(spark, f"{out}/versions/{version}/{_DONE}", version)
    found = [(v, finished) for v, finished in _versions(spark, out) if v <= version]
    kept = [v for v, finished in found if finished][-keep:]
    for v, _ in found:
        if v not in kept:
            remove(spark, f"{out}/versions/{v}")


def write_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
