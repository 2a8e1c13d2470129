"""Filings as a stream: late amendments replace what they amend.

A landing folder is read as a stream; each batch is united with the stored rows
of the keys it touches and the latest are kept by key, so the stored table always
equals the batch result over everything seen so far. Windowed totals carry a
watermark; sessions are gaps in a user's events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyforge.session import cut


def landing(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """A file-source stream over a folder."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def merge_batch(path: str, keys: Sequence[str], latest: Callable[[DataFrame], DataFrame], buckets: int = 256) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rewrite the hash buckets whose keys a batch touches, of as many
    as the table's size needs. A repeated batch gives the same table, so a restart does
    no harm; while buckets are replaced, a reader may see old ones beside new ones."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in new.select("__bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        try:
            old = spark.read.parquet(path).filter(F.col("__bucket").isin(touched)).select(*new.columns)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            old = new.limit(0)
        # The old files are read to the end before they are replaced.
        merged = cut(latest(old.unionByName(new)))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__bucket").parquet(path)

    return run


def maintain_latest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], latest: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Take in everything that is there, then stop."""
    return stream.writeStream.foreachBatch(merge_batch(path, keys, latest)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_totals(events: DataFrame, time: str, keys: Sequence[str], value: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and keys; events later than `late` are left out in
    a stream and never in a batch."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("event_count"), F.sum(value).alias("total_value")).select(F.col("w.start").alias("window_start"), *keys, "event_count", "total_value")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Start, end and number of events of each key's sessions."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("event_count")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "event_count")


def alerts(stream: DataFrame, condition: Column) -> DataFrame:
    """Rows of a stream that meet a condition: stateless, so in any output mode."""
    return stream.filter(condition)
