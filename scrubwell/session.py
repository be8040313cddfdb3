"""Session helpers: settings for local work and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables below this size may be broadcast.  Spark compares it with the size of
# the files a table was written to, so the side that is sent out is measured.
BROADCAST_LIMIT = 32 * 1024 * 1024
# Session setting: deal the rows of every table a query reads to so many tasks.
# For tables in few unsplittable files; unset, tables are only read.
INPUT_TASKS = "spark.scrubwell.inputTasks"
# Setting of Spark: shuffle files go when the query that made them has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths staged inside the innermost ``scratch``.
_collected: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def local_session(cpus: str | int = "*", app: str = "scrubwell") -> SparkSession:
    """A session for tests and benches; on a cluster bring your own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_LIMIT))
        .config(INPUT_TASKS, str(os.cpu_count() if cpus == "*" else cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a
    cluster that folder would exist on one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="scrubwell-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage where more than one branch reads the same rows, survives
    the loss of executors, and gives later joins a measured table size.  Once it is written
    nobody reads the shuffles it was made by; Spark would keep them until the driver
    collects its garbage, and jobs of many stages would hold them all at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _setting(spark, SHUFFLES_GO, "true"):
        df.write.parquet(path)
    if (inside := _collected.get()) is not None:
        inside.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def release(*tables: DataFrame) -> None:
    """Delete staged tables once their last reader has been written.

    A table made of staged ones reads them when it runs, so release what it is made of only
    after it was staged itself.  Tables that were not staged here are left alone.
    """
    for table in tables:
        path = table.__dict__.pop("_staged_at", None)
        if path:
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end whatever is staged inside, also after an error.

    For work whose result is written inside as well, such as a micro-batch.
    """
    paths: list[str] = []
    token = _collected.set(paths)
    try:
        yield
    finally:
        _collected.reset(token)
        for path in paths:
            _delete(spark, path)


def settle(df: DataFrame, columns: list[str]) -> DataFrame:
    """Make ``columns`` plain outputs that later filters refer to by name.

    The optimizer moves a filter below a projection by copying the projected
    expressions into it; through a long list of text steps the copies multiply
    at every step.  Filters on what a generator puts out stay above it.  The
    generator is ``explode`` because the optimizer narrows its structs to the one
    column that is read: texts alone do not compute their findings.
    """
    rest = [name for name in df.columns if name not in columns]
    settled = df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("_settled"))
    return settled.select(
        *[F.col(f"_settled.{n}").alias(n) if n in columns else F.col(n) for n in df.columns]
    )
