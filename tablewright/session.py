"""Spark session and the shared staging area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}

# Spark records the Python call site of every column expression unless told otherwise, which
# takes longer than planning for expressions over many columns
CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"

#: compression of staged tables
PACKED = "zstd"


def get_session(app_name: str = "tablewright", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on; size, master and memory are left to the caller."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(CALL_SITES, "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: bytes of a generated method beyond which Spark runs operators one by one, and the largest that HotSpot compiles
HUGE, COMPILED = "spark.sql.codegen.hugeMethodLimit", 8_000


def compiled(spark: SparkSession) -> None:
    """Let no projection of many columns become one method that the JVM only interprets.

    Spark documents 8000 for HotSpot, but fuses up to 65535 bytes by default; a limit that was set
    already stays. Beyond it operators are not fused, but their expressions come in small methods.
    """
    if spark.conf.get(HUGE, "65535") == "65535":
        spark.conf.set(HUGE, str(COMPILED))


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, from ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it gets a fresh folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/") + "/tablewright"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # one process reads and writes
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tablewright-")
    return _local_roots[app]


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the staging area and read it back.

    The written table cuts lineage, survives lost executors, freezes non-deterministic columns
    and lets later passes read only the columns they need. It is packed tightly, as it lies beside
    the shuffles of all that follows.
    """
    return _write(df, f"{staging_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as ``stage`` writes it, deleted at the end: for tables whose results the driver holds by then."""
    path = f"{staging_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    try:
        yield _write(df, path)
    finally:
        drop(df.sparkSession, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


#: rows of a part that a fit holds in memory, and parts for each core at least
PART_ROWS, PARTS = 250_000, 2


def spread(df: DataFrame, name: str = "spread") -> DataFrame:
    """``df`` written once and dealt evenly over parts that follow its rows and the cores.

    A table is read in as many tasks as its files have row groups, which may be one. A fit that goes
    over its rows again and again needs all cores for them.
    """
    rows = stage(df, name)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(PARTS * cores, -(-rows.count() // PART_ROWS)))


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged (call it when all results are written)."""
    drop(spark, staging_root(spark))


def together(spark: SparkSession, work: list, parallelism: int = 4) -> list:
    """Results of independent Spark jobs started from several driver threads.

    A failed one gives its exception in place of a result.
    """
    def guarded(task):
        try:
            return task()
        except Exception as error:  # the caller decides what a failure means
            return error

    with ThreadPool(max(1, min(parallelism, len(work) or 1))) as pool:
        return pool.map(inheritable_thread_target(spark)(guarded), work, chunksize=1)
