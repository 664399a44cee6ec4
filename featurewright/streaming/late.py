"""Window features with a defined path for late rows.

Every micro-batch is one epoch with a watermark: the latest event time of all
earlier epochs, less the delay.  Rows not behind it are admitted; rows behind it,
and rows without a time, go to a side table with the watermark that they missed.
Nothing disappears.

Admitted rows become partial aggregates (sum, count) per key and window, in a folder of
the epoch.  The feature table is their sum, so a window that several epochs add to
needs no state and no rewrite.  Per epoch three folders are overwritten and
the mark last: partials, late rows, mark (latest time, rows, late rows).  A retried
or restarted epoch reads the mark before it and writes the same folders again.

    root/partials/epoch=N   root/late/epoch=N   root/marks/epoch=N
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurewright.functions.time import year_month
from featurewright.operators.asof import interval_micros
from featurewright.sources.sinks import path_exists


def watermark_before(spark: SparkSession, root: str, epoch: int, delay: str) -> int | None:
    """The epoch's watermark in microseconds since 1970, from the mark of the epoch before; None for the first."""
    if epoch == 0:
        return None
    path = f"{root}/marks/epoch={epoch - 1}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path}: the mark of the epoch before is missing; a checkpoint and its root belong together")
    latest = spark.read.parquet(path).first()["latest"]
    return None if latest is None else latest - interval_micros(delay)


def _micros(ts_col: str):
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def admit(batch: DataFrame, ts_col: str, watermark: int | None) -> tuple[DataFrame, DataFrame]:
    """(admitted rows, rows aside): aside is what lies behind the watermark or has no time."""
    behind = F.col(ts_col).isNull() if watermark is None else F.col(ts_col).isNull() | (_micros(ts_col) < watermark)
    missed = F.lit(None).cast("timestamp_ntz") if watermark is None else F.timestamp_micros(F.lit(watermark)).cast("timestamp_ntz")
    return batch.where(~behind), batch.where(behind).withColumn("watermark", missed)


def admit_into(root: str, ts_col: str, key_col: str, value_col: str, delay: str, window: str, slide: str):
    """``foreachBatch`` body: split an epoch, write its partial aggregates, its late rows, and last its mark."""
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = watermark_before(spark, root, epoch, delay)
        before = None if mark is None else mark + interval_micros(delay)
        batch = batch.persist()  # the micro-batch is read three times
        try:
            rows, aside = admit(batch, ts_col, mark)
            cut = F.window(F.col(ts_col).cast("timestamp"), window, slide)
            partial = rows.groupBy(F.col(key_col).alias("zip"), cut.alias("w")).agg(
                F.sum(F.col(value_col)).alias("total"), F.count(F.col(value_col)).alias("n_values"), F.count(F.lit(1)).alias("n"))
            partial.select("zip", F.col("w.end").cast("timestamp_ntz").alias("ts"), "total", "n_values", "n").write.mode("overwrite").parquet(f"{root}/partials/epoch={epoch}")
            aside.write.mode("overwrite").parquet(f"{root}/late/epoch={epoch}")
            behind = F.col(ts_col).isNull() if mark is None else F.col(ts_col).isNull() | (_micros(ts_col) < mark)
            batch.agg(F.greatest(F.max(_micros(ts_col)), F.lit(before).cast("bigint")).alias("latest"), F.count(F.lit(1)).alias("rows"),
                      F.count_if(behind).alias("late_rows")).write.mode("overwrite").parquet(f"{root}/marks/epoch={epoch}")
        finally:
            batch.unpersist()

    return run


def run_admitting_stream(src: DataFrame, ts_col: str, key_col: str, value_col: str, root: str, checkpoint: str, delay: str = "1 hour",
                         window: str = "1 hour", slide: str = "15 minutes", available_now: bool = True):
    """Start (and with ``availableNow`` drain) the stream into ``root``; returns the query handle."""
    writer = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(admit_into(root, ts_col, key_col, value_col, delay, window, slide))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def window_features(spark: SparkSession, root: str) -> DataFrame:
    """The pickup features (C3) from all epochs' partial aggregates."""
    parts = spark.read.parquet(f"{root}/partials")
    merged = parts.groupBy("zip", "ts").agg(F.sum("total").alias("total"), F.sum("n_values").alias("n_values"), F.sum("n").alias("n"))
    return merged.select(
        "zip", "ts", year_month("ts").alias("yyyy_mm"),
        F.try_divide("total", "n_values").cast("float").alias("mean_fare_window_1h_pickup_zip"),
        F.col("n").cast("int").alias("count_trips_window_1h_pickup_zip"))


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that no window holds, with the epoch and the watermark that they missed."""
    return spark.read.parquet(f"{root}/late")


def marks(spark: SparkSession, root: str) -> DataFrame:
    """epoch, latest (microseconds), rows, late_rows."""
    return spark.read.parquet(f"{root}/marks")
