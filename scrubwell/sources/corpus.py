"""Reading and writing corpora."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubwell.plans.config import CleanConfig
from scrubwell.session import stage

CORRUPT = "_corrupt_record"
BUCKETS = 65_536  # of rows, when two tables are compared
CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CORPUS_SCHEMA,
    name_glob: str | None = None,
) -> DataFrame:
    """Newline-delimited JSON with a fixed schema and the file each row came from.

    A line that is not JSON arrives with NULLs and its content in
    ``_corrupt_record``.  Compression follows the file extension.
    """
    reader = (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_name"))


def read_directory(
    spark: SparkSession, folder: str, schema: T.StructType = CORPUS_SCHEMA, glob: str = "*.jsonl*"
) -> DataFrame:
    """Every matching file of a folder; an error if there is none.

    One file's name answers that; the list of all files stays with the reader.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no {glob} files in {folder}")
    return read_jsonl(spark, folder, schema, glob)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def project_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(key, text)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly, for input that cannot be split, such as gzip files."""
    return df.repartition(partitions) if partitions else df.repartition()


def concat_results(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all inputs; a column one of them lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("run_date", F.date_format(F.current_date(), "yyyyMMdd"))


def write_clean(df: DataFrame, path: str, format: str = "json", mode: str = "errorifexists") -> None:
    """Cleaned rows, one folder per run date."""
    _dated(df).write.mode(mode).partitionBy("run_date").format(format).save(path)


def write_report(
    df: DataFrame,
    path: str,
    source: str | None = None,
    format: str = "json",
    mode: str = "errorifexists",
) -> None:
    """Report rows, one folder per run date and, if named, per source.

    Rows are brought together by source so that not every task writes a file
    for every source; rebalancing splits a source that is too large for a task.
    """
    parts = ["run_date"] + ([source] if source else [])
    df = df.hint("rebalance", source) if source else df
    _dated(df).write.mode(mode).partitionBy(*parts).format(format).save(path)


def snapshot_raw(df: DataFrame, path: str) -> DataFrame:
    """A copy of the input as it was before cleaning."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and a hash that does not depend on row order.

    Hashes are added as decimals, which cannot overflow at any table size.
    """
    return df.select(F.xxhash64(*columns).cast("decimal(38,0)").alias("hash")).agg(
        F.count("*").alias("n_rows"), F.sum("hash").alias("hash_sum")
    )


def verify_write(expected: DataFrame, written: DataFrame) -> DataFrame:
    """One row: do both tables have the same columns, row count and content?"""
    columns = sorted(expected.columns)
    same_columns = columns == sorted(written.columns) and all(
        expected.schema[name].dataType == written.schema[name].dataType for name in columns
    )
    shared = [name for name in columns if name in written.columns]
    sides = _fingerprint(expected, shared).select(F.lit("expected").alias("side"), "*").unionAll(
        _fingerprint(written, shared).select(F.lit("written").alias("side"), "*")
    )

    def of(side: str, column: str):
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return sides.agg(
        F.lit(same_columns).alias("same_schema"),
        of("expected", "n_rows").alias("rows_expected"),
        of("written", "n_rows").alias("rows_written"),
        of("expected", "hash_sum").eqNullSafe(of("written", "hash_sum")).alias("same_content"),
    )


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), *columns), F.lit(buckets)).alias("_bucket")


def differing_buckets(expected: DataFrame, written: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``_bucket`` of the rows whose count or content is not the same on both sides.

    Rows are dealt to buckets by their content.  Per bucket only a count and two sums of hashes are
    kept, so one narrow row per bucket and task is shuffled, whatever the size of the tables.
    """
    columns = expected.columns

    def sums(df: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (0, 1)]
        return df.select(
            _bucket(columns, buckets), F.lit(sign).cast("bigint").alias("n"),
            *[(h * sign).alias(f"h{i}") for i, h in enumerate(hashes)],
        )

    both = sums(expected, 1).unionAll(sums(written.select(*columns), -1))
    totals = both.groupBy("_bucket").agg(*[F.sum(name).alias(name) for name in ("n", "h0", "h1")])
    return totals.filter("n <> 0 OR h0 <> 0 OR h1 <> 0").select("_bucket")


def differences(expected: DataFrame, written: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows found on one side only, with the side they are missing from.

    Sums over buckets come first; whole rows are compared in differing buckets only, so
    where few rows differ few are shuffled: one in ``buckets`` for each.
    """
    columns = expected.columns
    written = written.select(*columns)
    found = stage(differing_buckets(expected, written, buckets), "differing")

    def rows(df: DataFrame) -> DataFrame:
        told = df.withColumn("_bucket", _bucket(columns, buckets))
        return told.join(found, "_bucket", "left_semi").select(*columns)

    lost = rows(expected).exceptAll(rows(written)).withColumn("missing_from", F.lit("written"))
    extra = rows(written).exceptAll(rows(expected)).withColumn("missing_from", F.lit("expected"))
    return lost.unionAll(extra)


def run_header(spark: SparkSession, config: CleanConfig | None = None) -> DataFrame:
    """One row saying who ran what, where and when.  Keys are never part of it."""
    settings = json.dumps(asdict(config or CleanConfig()))
    return spark.range(1).select(
        F.current_user().alias("run_user"),
        F.version().alias("platform"),
        F.current_timestamp().alias("started"),
        F.lit(settings).alias("config"),
    )
