"""Incremental ingest: unit files as a stream, each micro-batch mapped and appended once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkloom.runtime import path_exists

#: Buckets of the index of written keys.
KEY_BUCKETS = 64


def ingest_stream(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str,
    transform: Callable[[DataFrame], tuple[DataFrame, DataFrame]], key: str, files_per_trigger: int = 8,
) -> StreamingQuery:
    """Reads JSON or parquet files as they arrive, transforms each micro-batch and adds good rows to target/records and
    failed ones to target/errors.

    A batch is written to the folder of its epoch, replacing what a failed run of it left; the keys of good rows are kept
    beside them in buckets, and only the buckets that a batch touches are read to leave out keys of earlier batches. So a
    batch that is run again, or a file that repeats earlier records, adds nothing. ``transform`` gives (good, failed), both
    holding ``key``. A failed row of a key comes again if a later file repeats it, so that it can be mended."""
    fmt = "json" if source.rstrip("/").endswith("json") else "parquet"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(source)

    def write(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")
        fresh = batch.filter(F.col(key).isNotNull()).dropDuplicates([key]).withColumn("_bucket", bucket)
        index = f"{target}/keys"
        if path_exists(session, index):  # any other failure to read it is a failure of the batch
            touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most KEY_BUCKETS numbers
            done = session.read.parquet(index).filter((F.col("_epoch") < epoch) & F.col("_bucket").isin(touched)).select(key)
            fresh = fresh.join(done, key, "left_anti")
        good, failed = transform(fresh.drop("_bucket"))
        good.write.mode("overwrite").parquet(f"{target}/records/_epoch={epoch}")
        failed.dropDuplicates([key]).write.mode("overwrite").parquet(f"{target}/errors/_epoch={epoch}")
        written = session.read.parquet(f"{target}/records/_epoch={epoch}")
        written.select(key).withColumn("_bucket", bucket).write.partitionBy("_bucket").mode("overwrite").parquet(f"{index}/_epoch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, length: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts per key and tumbling window of a stream (an addition for monitoring arrivals); rows later than ``late`` are dropped
    by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), key, "n")
