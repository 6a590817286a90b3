"""Session set-up and the shared folder for tables that cut a long lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
#: Rows up to which a side of a join is left to Spark's own size check.
BROADCAST_ROWS = 50_000
#: Spark's setting to remove the shuffle files of a query at its end.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROWS: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    Adaptive execution sizes the shuffle partitions and splits skewed join partitions at run
    time; broadcast joins stay with Spark's own size check (no operator raises the threshold).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables: `spark.checkpoint.dir` of the session.

    Only a local master without that setting falls back to a folder of its own; on a cluster
    a machine-local folder would be lost with its machine, so that case is refused.
    """
    application = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _LOCAL_FOLDERS.setdefault(application, tempfile.mkdtemp(prefix="tidemark-"))
    return f"{base.rstrip('/')}/tidemark/{application}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores, before heavy work per row.

    A table of few large row groups gives few tasks. With as many splits as cores, which any
    large table has, the scan stays as it is and nothing is shuffled. `keys` make each row's
    place repeatable and should be unique.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries inside leave no shuffle files: what they wrote is the only thing that is read again.

    Otherwise those files stay until the driver happens to collect its garbage, so a job of many
    steps holds the shuffles of all of them at once.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


def stage(df: DataFrame, label: str, partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, survives the loss of executors, and keeps what
    a checkpoint gives away: column pruning, filter pushdown, table statistics and, with
    `partition_by`, partition pruning. The shuffle files of the write are removed when it is done.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", "zstd")  # staged tables are written once and read a few times
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def few_rows(df: DataFrame) -> bool:
    """Whether a table is small enough for Spark's size check to choose; of a written table only row counts are read.

    A frame is counted once, however often it is asked about.
    """
    if df not in _ROWS:
        _ROWS[df] = df.count()
    return _ROWS[df] <= BROADCAST_ROWS


def join_side(df: DataFrame) -> DataFrame:
    """A written table as a side of a join, to be sorted and never broadcast when it has many rows.

    The size check sees compressed files, and of a few columns only their share. Sorted names and
    keys take a byte or two there and a hundred in a broadcast, so millions of rows would pass it.
    """
    return df if few_rows(df) else df.hint("merge")
