"""Running analytics of the request log.

A stream counts the log per (window, endpoint) in mergeable partials: counts,
sums and a KLL sketch of the latency.  A micro-batch writes the partials that it
changed under its own number, so a batch that runs again overwrites itself, and a
restart goes on from the checkpoint without reading old rows again.  The state is
one row per open window and endpoint; the watermark closes windows, and a row that
comes later than it is not counted.  A report merges the last partial of each
window; it reads partials, never the log.  Rows without a timestamp belong to no
window and are not counted.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("timestamp timestamp, endpoint string, input_fields string, prediction double, "
              "warnings array<string>, request_id bigint, latency_ms double")
PARTIAL_SCHEMA = ("start timestamp, endpoint string, n bigint, n_predicted bigint, sum_prediction double, "
                  "n_warned bigint, n_timed bigint, sketch binary")


def partials(log: DataFrame, window: str) -> DataFrame:
    """One row per (window, endpoint); the same for a stream and a table."""
    return log.groupBy(F.window("timestamp", window).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_predicted"),
        F.sum("prediction").alias("sum_prediction"), F.count_if(F.size("warnings") > 0).alias("n_warned"),
        F.count_if(F.col("latency_ms") > 0).alias("n_timed"),
        F.kll_sketch_agg_double("latency_ms").alias("sketch")).select(F.col("w.start").alias("start"), "*").drop("w")


def run_log_stats(spark: SparkSession, log_path: str, base: str, window: str = "1 hour", late: str = "1 day",
                  max_files: int | None = None) -> None:
    """Counts what is new in the log folder since the last run over ``base``
    (checkpoint and partials) and ends."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(base, "partials", f"batch={batch_id}"))

    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.json(log_path).withWatermark("timestamp", late)
    query = (partials(log, window).writeStream.outputMode("update").foreachBatch(per_batch)
             .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()


def last_partials(spark: SparkSession, base: str) -> DataFrame:
    """The newest partial of each window and endpoint; none before the first batch."""
    path = os.path.join(base, "partials")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    written = spark.read.schema(PARTIAL_SCHEMA + ", batch bigint").parquet(path)
    values = [c for c in written.columns if c not in ("start", "endpoint", "batch")]
    return written.groupBy("start", "endpoint").agg(
        F.max_by(F.struct(*values), "batch").alias("p")).select("start", "endpoint", "p.*")


def report(parts: DataFrame) -> DataFrame:
    """Per endpoint: requests, mean prediction, share with warnings, latency
    quantiles (NULL without a latency), merged from the windows' partials."""
    timed = F.col("n_timed") > 0
    merged = parts.groupBy("endpoint").agg(
        F.sum("n").cast("bigint").alias("n_requests"),
        (F.sum("sum_prediction") / F.sum("n_predicted")).alias("mean_prediction"),
        (F.sum("n_warned") / F.sum("n")).alias("warning_rate"),
        F.sum("n_timed").cast("bigint").alias("n_timed"),
        F.kll_merge_agg_double(F.when(timed, F.col("sketch"))).alias("k"))
    return merged.select("endpoint", "n_requests", "mean_prediction", "warning_rate", "n_timed", *[
        F.when(timed, F.kll_sketch_get_quantile_double("k", F.lit(q))).alias(f"latency_p{int(q * 100)}")
        for q in (0.5, 0.95, 0.99)])
