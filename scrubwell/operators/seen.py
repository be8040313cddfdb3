"""Texts seen in earlier runs: one row per text over all runs, not over one.

Every run leaves the hashes of the texts it let through.  They are kept in a table whose
files are bucketed by the hash, so a later run is dealt to the same buckets and meets them
without moving them again.  Beside it lies a bitmap of fixed size: a hash whose bit is
unset was never seen, and does not enter the join at all.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubwell.operators.dedupe import dedupe_texts
from scrubwell.session import release, stage

BUCKETS = 64
BITS = 27  # the bitmap has 1 << BITS bits, 16 MB, whatever the number of texts


class SeenTexts:
    """The texts that runs have let through, in ``folder``.

    A run that failed or is done again under its name gives the same rows: what it
    left itself is not held against it, and is not written twice.  Runs take turns; two at the
    same time may both let a text through.  The number of buckets and bits is fixed when the
    folder is first used.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, bits: int = BITS):
        self.spark, self.bits = spark, bits
        folder = folder.rstrip("/")
        self.name = "seen_" + hashlib.md5(folder.encode()).hexdigest()[:16]
        self.pages = f"{folder}/pages"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (text_hash BINARY, run STRING) USING parquet "
            f"CLUSTERED BY (text_hash) SORTED BY (text_hash) INTO {buckets} BUCKETS LOCATION '{folder}/hashes'"
        )
        self.buckets = buckets
        # an empty table of pages, so that the first run reads one
        self._page_rows(spark.sql("SELECT 0L AS slot WHERE false")).write.mode("append").parquet(self.pages)

    def hashes(self) -> DataFrame:
        """``text_hash, run`` of every text let through."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _page_rows(self, slots: DataFrame) -> DataFrame:
        return slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("page")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")
        )

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("text_hash"), F.lit(1 << self.bits)).alias("slot")

    def _maybe_seen(self, kept: DataFrame) -> DataFrame:
        """``text_hash`` of the texts whose bit is set."""
        pages = self.spark.read.schema("page bigint, bits binary").parquet(self.pages)
        pages = stage(pages.groupBy("page").agg(F.expr("bitmap_or_agg(bits)").alias("bits")), "pages")
        asked = kept.select("text_hash", self._slot()).select(
            "text_hash", F.expr("bitmap_bucket_number(slot)").alias("page"), F.expr("bitmap_bit_position(slot)").alias("bit")
        )
        octet = "int(conv(hex(substring(bits, int(bit div 8) + 1, 1)), 16, 10))"
        met = asked.join(pages, "page").filter(f"shiftright({octet}, int(bit % 8)) % 2 = 1")
        return met.select("text_hash")

    def first_sights(
        self, df: DataFrame, run: str, order: str = "doc_id", text: str = "text"
    ) -> DataFrame:
        """Rows of ``df`` whose text no other run has let through; of equal texts the smallest ``order``.

        The result is a written table with the columns of ``df``; its texts count as seen
        from now on.  Rows without a text are dropped, as by ``dedupe_texts``.
        """
        hashed = F.unhex(F.sha2(F.encode(F.col(text), "UTF-8"), 256))
        kept = stage(dedupe_texts(df, order, text).withColumn("text_hash", hashed), "kept")
        earlier = self.hashes().filter(F.col("run") != run).select("text_hash")
        seen = stage(self._maybe_seen(kept).join(earlier, "text_hash", "left_semi"), "seen")
        fresh = stage(kept.join(seen, "text_hash", "left_anti"), "fresh")
        release(kept, seen)
        # bits before hashes: a run that ends in between leaves bits too many, never too few
        self._page_rows(fresh.select(self._slot())).write.mode("append").parquet(self.pages)
        own = self.hashes().filter(F.col("run") == run).select("text_hash")
        new = fresh.select("text_hash").join(own, "text_hash", "left_anti")
        new = new.select("text_hash", F.lit(run).alias("run"))
        # one file for each bucket
        new.repartition(self.buckets, "text_hash").write.insertInto(self.name)
        return fresh.select(*df.columns)

    def forget(self) -> None:
        """Drop the table's name from this session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
