"""Resumable processing: batches that are committed once, durable counters, and a memo of converted texts.

A run reads a folder of Parquet files as a stream.  The checkpoint holds which files belong to which batch
before the batch begins, so a batch that fails half way is done again with the same rows under the same
number; its rows and counts go to folders of that number, which are overwritten.  So every row is committed
once, whatever failed, and totals are read from a table and not from the memory of a process.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from weftline.operators.ordered import global_rank

#: Fixed value: rows after which progress is saved.
EVERY = 200


def stage_rows(rows: DataFrame, order: list[str], path: str, every: int = EVERY) -> None:
    """[K1] Write rows in order, with their ``position`` from 0, in files of at most ``every`` rows, so that a batch of files is a range of positions."""
    ranked = global_rank(rows, order, "position").withColumn("position", F.col("position") - 1)
    ranked.repartitionByRange("position").sortWithinPartitions("position").write.option("maxRecordsPerFile", every).mode("append").parquet(path)


@dataclass(frozen=True)
class Run:
    """[K1, K5] A resumable run below ``root``: rows in ``root/rows``, counts in ``root/counts``, its place in ``root/position``."""

    spark: SparkSession
    root: str

    def rows(self, schema: str | StructType) -> DataFrame:
        """Committed rows."""
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        return self.spark.read.schema(fields).option("recursiveFileLookup", True).parquet(f"{self.root}/rows")

    def counts(self) -> DataFrame:
        """(batch, kind, n) of committed batches that have rows."""
        return self.spark.read.schema("batch long, kind string, n long").option("recursiveFileLookup", True).parquet(f"{self.root}/counts")

    def totals(self) -> DataFrame:
        """[K5] (kind, n) over all runs so far."""
        return self.counts().groupBy("kind").agg(F.sum("n").alias("n"))

    def processed(self) -> int:
        """[K1] Rows that are committed."""
        return self.counts().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if _exists(self.spark, f"{self.root}/counts") else 0

    def resume(self, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], kind: Column | None = None, files_per_batch: int = 1) -> int:
        """Process the files below ``source`` that no run has committed; the number of rows that this one has.

        ``transform`` is applied to a batch, so it must give each row its result without the other batches.
        ``kind`` is what rows are counted by.  A batch's counts are made from its written rows, so it is computed once.
        """
        before = self.processed()

        def commit(batch: DataFrame, number: int) -> None:
            path = f"{self.root}/rows/batch={number}"
            transform(batch).write.mode("overwrite").parquet(path)
            done = batch.sparkSession.read.parquet(path)
            counts = done.groupBy((kind if kind is not None else F.lit("all")).cast("string").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
            counts.select(F.lit(number).cast("long").alias("batch"), "kind", "n").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/batch={number}")

        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        stream.writeStream.foreachBatch(commit).option("checkpointLocation", f"{self.root}/position").trigger(availableNow=True).start().awaitTermination()
        return self.processed() - before


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class Memo:
    """[K6] Converted texts kept from run to run below ``path``, by 128 bits that stand for a text.

    New rows are appended in one commit, so a run that fails leaves the memo as it
    was.  Two runs at the same time may convert the same text twice; a reader takes one of them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self, kind: str) -> DataFrame:
        return self.spark.read.schema(f"key binary, result {kind}, run long").parquet(self.path)

    def known(self, kind: str) -> DataFrame | None:
        """(key, result, run) of texts converted so far."""
        if not _exists(self.spark, self.path):
            return None
        return self._rows(kind).groupBy("key").agg(F.min(F.struct("run", "result")).alias("r")).select("key", "r.result", "r.run")

    def convert(self, df: DataFrame, text: str, convert: Callable[[Column], Column], out: str, run: int = 0) -> tuple[DataFrame, int]:
        """``df`` with the conversion of its texts in ``out``, and how many texts this run had to convert.

        Only texts without a row in the memo are converted, each once; null texts give null.
        """
        key = F.unhex(F.md5(F.col(text)))
        fresh = df.filter(F.col(text).isNotNull()).groupBy(key.alias("key")).agg(F.first(text).alias("text"))
        kind = fresh.select(convert(F.col("text")).alias("result")).schema["result"].dataType.simpleString()
        before = self.known(kind)
        if before is not None:
            fresh = fresh.join(self._rows(kind).select("key"), "key", "left_anti")
        # Rows are dealt out by key already; they are written where they are.
        fresh.select("key", convert(F.col("text")).alias("result"), F.lit(run).cast("long").alias("run")).write.mode("append").parquet(self.path)
        memo = self.known(kind)
        # The results are not needed to count, so they are not read.
        n = self._rows(kind).groupBy("key").agg(F.min("run").alias("run")).filter(F.col("run") == run).count()
        joined = df.withColumn("_key", key).join(memo.select(F.col("key").alias("_key"), F.col("result").alias(out), F.col("run").alias(f"{out}_run")), "_key", "left").drop("_key")
        return joined, n


def windowed_counts(events: DataFrame, ts: str, width: str, late: str, kind: str) -> DataFrame:
    """Counts per window and kind, with a watermark; a timestamp without zone is cast first."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count(F.lit(1)).alias("n"))


class Progress(StreamingQueryListener):
    """[K4] Rows and rates per batch, kept for whoever shows them."""

    def __init__(self) -> None:
        self.batches: list[tuple[int, int, float]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryTerminated(self, event) -> None:
        pass
