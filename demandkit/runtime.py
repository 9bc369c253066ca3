"""Session settings, shared work folder, stage tables and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A table is broadcast only when rows x columns stays below this many cells
#: (about 64 MB at 16 bytes a cell).
BROADCAST_CELLS = 4_000_000


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", broadcast_limit: str = "1MB"
) -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own.

    The low broadcast limit lets joins with middle-sized tables shuffle, as they
    do at scale, and so spreads a file that only one task can scan.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("demandkit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Folder of local applications without ``spark.checkpoint.dir``, by application.
_LOCAL: dict[str, str] = {}
#: Folder of the innermost open scope.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for stage tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a session on one machine
    without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="demandkit-")
    return _LOCAL[application]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    folder = _SCOPE.get() or f"{work_dir(spark)}/demandkit"
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, wherever it is stored."""
    hadoop, system = _file_system(spark, path)
    system.delete(hadoop, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly in a folder; none if there is no such folder."""
    hadoop, system = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop)) if system.exists(hadoop) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole; an error if it exists."""
    hadoop, system = _file_system(spark, path)
    part, _ = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(part, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if system.exists(hadoop) or not system.rename(part, hadoop):
        system.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    hadoop, system = _file_system(spark, path)
    return "\n".join(r.value for r in spark.read.text(path).collect()) if system.exists(hadoop) else None


@contextmanager
def scratch(spark: SparkSession, purpose: str = "scope", keep: bool = False) -> Iterator[str]:
    """A scope whose stage tables are removed at its end, whether it succeeds or fails.

    What outlives the scope has to be written elsewhere before the end. Scopes nest. With
    ``keep`` the caller removes the folder later.
    """
    path = fresh_path(spark, purpose)
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        if not keep:
            remove(spark, path)


def settle(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage table as Parquet in the shared folder and read it back.

    Later steps neither recompute the lineage nor lose it with an executor, and
    the scan keeps column pruning, row-group skipping and real size statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def small_side(table: DataFrame, rows: int | None = None, max_cells: int = BROADCAST_CELLS) -> DataFrame:
    """Mark a table for broadcast if it is small; leave a larger one to the shuffle
    joins (with adaptive skew splitting).

    ``rows`` is an upper bound known beforehand, such as the days of a calendar.
    Without it the table is counted, which is cheap for a stored one.
    """
    bound = table.count() if rows is None else rows
    return F.broadcast(table) if bound * len(table.columns) <= max_cells else table
