"""The cleaner on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from scrubwell.plans.cleaner import TABLE_STEPS, Cleaner
from scrubwell.session import scratch
from scrubwell.sources.corpus import CORPUS_SCHEMA

SEEN = "seen"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = CORPUS_SCHEMA,
    format: str = "json",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .format(format)
        .load(folder)
    )


def _start(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer


def stream_clean(
    stream: DataFrame,
    cleaner: Cleaner,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Clean rows as they arrive; the steps keep no state.

    A cleaner with language, spelling or name steps aggregates over its input
    and runs batch by batch through :func:`stream_clean_batches`; here it is refused.
    """
    joining = {*TABLE_STEPS, "remove_lang"}.intersection(name for name, _ in cleaner.steps())
    if joining:
        raise ValueError(f"use stream_clean_batches for {', '.join(sorted(joining))}")
    writer = (
        cleaner.transform(stream)
        .writeStream.format(format)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, available_now).start(path)


def stream_clean_batches(
    stream: DataFrame,
    cleaner: Cleaner,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Clean each micro-batch as a table of its own, with all steps.

    Dictionaries are written once, before the first batch, and joined to every batch; what a
    batch writes for itself is deleted when its result is there.  A batch that is run
    again after a failure replaces its own folder, so no row is written twice.
    """
    ready = cleaner.prepared()

    def run(batch: DataFrame, number: int) -> None:
        target = f"{path.rstrip('/')}/batch={number}"
        with scratch(batch.sparkSession):
            ready.transform(batch).write.mode("overwrite").format(format).save(target)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _start(writer, available_now).start()


def _milliseconds(spark: SparkSession, interval: str) -> int:
    moment = f"timestamp_millis(0) + INTERVAL {interval}"
    return spark.sql(f"SELECT unix_millis({moment})").first()[0]


def replay_delay(rows: DataFrame, time: str, least: str = "10 minutes") -> str:
    """The delay with which a replay of stored files drops no row as late, ``least`` or more.

    ``rows`` is the table of the same files with the time column.  A stream takes files by
    their modification time, which need not be the order of the times inside.  For every
    file: how far its first time lies behind the last time of any file that may come
    before.  One row for each file is compared.
    """
    files = rows.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("written"),
    ).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    moments = files.groupBy("written").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        # files written at one moment may come in any order
        F.when(F.count("*") > 1, F.max("last")).alias("beside"),
    )
    before = F.max("last").over(
        Window.orderBy("written").rowsBetween(Window.unboundedPreceding, -1)
    )
    behind = moments.select(
        (F.unix_millis(F.greatest(before, "beside")) - F.unix_millis("first")).alias("behind")
    )
    worst = behind.agg(F.max("behind")).first()[0] or 0
    floor = _milliseconds(rows.sparkSession, least)
    return f"{max(worst + 1, floor)} milliseconds"


# --- one row per text -------------------------------------------------------


def _first_sight(remember_ms: int) -> StatefulProcessor:
    """Lets the first row of a text pass and remembers the text for a while.

    The class is made here so that it travels with its code: the process that sets a
    stateful query up need not find this package.
    """

    class FirstSight(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getValueState(SEEN, "at bigint")

        def handleInputRows(self, key, rows, timerValues):
            if self.seen.exists():
                return iter(())
            # one row a window: the order of the rows inside was settled by the aggregate
            first = min(rows, key=lambda row: row["_window"])
            at = int(first["_window"].timestamp() * 1000)
            self.seen.update((at,))
            self.handle.registerTimer(at + remember_ms)
            return iter([Row(text_hash=key[0], _row=first["_row"])])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstSight()


def dedupe_stream(
    stream: DataFrame,
    time: str,
    delay: str,
    text: str = "text",
    order: str = "doc_id",
    hold: str = "1 minute",
    remember: str = "30 days",
) -> DataFrame:
    """The row with the smallest ``order`` of the first ``hold`` window that has a text; ``text_hash`` added.

    Rows of one window and text are reduced by an aggregate first: copies meet inside each
    task, so a text that floods the stream reaches its state as one row a window and task.  When the
    watermark (``delay`` behind the latest time) passes a window, its row meets the state of
    its text: the first passes, later ones do not until the text has not been let through for
    ``remember``.  State holds one number per text seen within that time.  Rows without
    an order come last; rows without a text are dropped.

    Needs the RocksDB state store: start it with :func:`write_stream`.
    """
    spark = stream.sparkSession
    rest = [name for name in stream.columns if name != order]
    row = F.struct(F.col(order).isNull().alias("_last"), order, *rest)
    hashed = stream.filter(F.col(text).isNotNull()).withWatermark(time, delay)
    hashed = hashed.withColumn("text_hash", F.sha2(F.encode(text, "UTF-8"), 256))
    firsts = hashed.groupBy(F.window(time, hold), "text_hash").agg(F.min(row).alias("_row"))
    firsts = firsts.select("text_hash", F.window_time("window").alias("_window"), "_row")
    kind = T.StructType([firsts.schema["text_hash"], firsts.schema["_row"]])
    milliseconds = _milliseconds(spark, remember)
    passed = firsts.groupBy("text_hash").transformWithState(
        _first_sight(milliseconds), kind, "append", "EventTime"
    )
    return passed.select(*[F.col(f"_row.{name}").alias(name) for name in stream.columns], "text_hash")


def open_texts(spark: SparkSession, checkpoint: str, columns: list[str]) -> DataFrame:
    """Rows of :func:`dedupe_stream` that wait for their window to close, from the stream's state.

    What it would still let through if no row came any more; reading changes nothing.
    """
    state = spark.read.format("statestore").option("path", checkpoint)
    waiting = state.option("operatorId", 1).load()
    row = F.col("value").getField(waiting.schema["value"].dataType.names[0])
    waiting = waiting.select(
        F.col("key.text_hash").alias("text_hash"), F.struct(F.col("key.window.start"), row.alias("row")).alias("w")
    )
    seen = spark.read.format("statestore").option("path", checkpoint).option("operatorId", 0)
    seen = seen.option("stateVarName", SEEN).load().select(F.col("key.text_hash").alias("text_hash"))
    fresh = waiting.join(seen, "text_hash", "left_anti").groupBy("text_hash").agg(F.min("w").alias("w"))
    return fresh.select(*[F.col(f"w.row.{name}").alias(name) for name in columns], "text_hash")


def report_stream(
    cleaned: DataFrame, time: str, delay: str = "10 minutes", width: str = "1 hour"
) -> DataFrame:
    """Changes per time window and tag; counts combine before the shuffle."""
    found = cleaned.withWatermark(time, delay).select(time, F.explode("findings").alias("found"))
    return (
        found.groupBy(F.window(time, width), F.col("found.tag").alias("tag"))
        .agg(F.count("*").alias("changes"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "tag",
            "changes",
        )
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows of :func:`report_stream` for windows that the watermark has not passed, from its state.

    With the rows written so far these are all changes seen, however often a report is asked
    for: reading the state changes nothing, and a window is in one of the two.
    """
    state = spark.read.format("statestore").option("path", checkpoint).load()
    key, value = (state.schema[name].dataType.names for name in ("key", "value"))
    return state.select(
        F.col(f"key.{key[0]}.start").alias("window_start"),
        F.col(f"key.{key[0]}.end").alias("window_end"),
        F.col("key").getField(key[1]).alias("tag"),
        F.col("value").getField(value[0]).alias("changes"),
    )


def write_stream(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that appends to files, with the state store that every job here runs on.

    A query takes the setting along when it starts; the session's own is put back.
    """
    conf, name = frame.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STATE_STORE)
    try:
        return _write(frame, path, checkpoint, format, available_now)
    finally:
        conf.set(name, before)


def _write(frame: DataFrame, path: str, checkpoint: str, format: str, available_now: bool):
    writer = frame.writeStream.format(format).option("checkpointLocation", checkpoint)
    return _start(writer.outputMode("append"), available_now).start(path)
