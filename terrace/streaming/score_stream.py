"""Streaming form of record scoring.

Records land as JSON files in a shared folder; a Structured Streaming query
reads their fields as text (extra keys are ignored), reads declared types from
that so that a wrongly typed value is reported, not lost, applies the same
column operators as the batch path -- normalise, validate, fill defaults,
warn, predict with a fitted ``PipelineModel`` -- and in ``foreachBatch``
writes scored rows, quarantined rows (with their error messages) and one log
row per record.  The query is stateless (no watermark needed) and restarts
from its checkpoint after a failure: ``foreachBatch`` output is keyed by the
batch id, so a replayed batch overwrites its own partition instead of
duplicating rows.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import score as SC
from terrace.session import scratch_path


SCORED = ("request_id bigint, endpoint string, predicted_price double, price_range_low double, "
          "price_range_high double, fields_defaulted int, warnings array<string>")


def write_records(records: DataFrame, path: str) -> None:
    """Land records as JSON files (the stream's source folder)."""
    records.write.mode("overwrite").json(path)


def validated_batch(batch: DataFrame, types: dict) -> DataFrame:
    """Records with canonical names, declared types and their errors."""
    return SC.validate(SC.coerce_types(SC.normalise(batch), types))


def scoring_batch(batch: DataFrame, model, defaults: dict, raw: list[str], types: dict,
                  mape: float) -> tuple[DataFrame, DataFrame]:
    """(scored, quarantined) rows of a batch of records."""
    return scored_batch(validated_batch(batch, types), model, defaults, raw, types, mape)


def scored_batch(v: DataFrame, model, defaults: dict, raw: list[str], types: dict,
                 mape: float) -> tuple[DataFrame, DataFrame]:
    """(scored, quarantined) rows of a batch of :func:`validated_batch`.  The
    input texts are joined by a shuffle: a small file can hold many rows, and
    their texts must not be collected on the driver to be broadcast."""
    bad = v.filter(~F.col("is_valid")).select(
        F.col("request_id").cast("bigint").alias("request_id"), F.array_join("errors", "; ").alias("errors"))
    good = SC.fill_defaults(v.filter(F.col("is_valid")), defaults, raw, types)
    good = good.withColumn("warnings", SC.record_warnings(good)).withColumn("request_id", F.col("request_id").cast("bigint"))
    scored = model.transform(good.withColumn("Id", F.col("request_id")))
    p, lo, hi = SC.price_interval(F.col("prediction"), mape)
    out = scored.select("request_id", "endpoint", p.alias("predicted_price"),
                        lo.alias("price_range_low"), hi.alias("price_range_high"),
                        "fields_defaulted", "warnings")
    inputs = good.select("request_id", F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw])).alias("inputs"))
    return out.join(inputs.hint("merge"), "request_id"), bad


def run_score_stream(spark: SparkSession, records: DataFrame, model, defaults: dict,
                     raw: list[str], types: dict, mape: float, max_files: int | None = None) -> DataFrame:
    """Scores the landed records as a stream; one row per record, ``scored`` or
    ``quarantined``.  ``max_files`` limits the files of one micro-batch."""
    base = scratch_path(spark, "stream")
    src, sink = os.path.join(base, "in"), os.path.join(base, "out")
    write_records(records, src)
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in records.schema.fields])

    written: list[int] = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        """Idempotent per batch id: a replayed batch overwrites its own folders.
        Records are parsed and validated once, into a folder that all outputs
        read: a filter on the verdict would else be pushed down to the JSON scan
        as one expression and parse every text again for each message."""
        valid = validated_batch(batch, types)
        kept = os.path.join(base, "validated", f"batch={batch_id}")
        valid.write.mode("overwrite").parquet(kept)
        valid = batch.sparkSession.read.schema(valid.schema).parquet(kept)
        scored, bad = scored_batch(valid, model, defaults, raw, types, mape)
        path = os.path.join(sink, "scored", f"batch={batch_id}")
        t0 = time.time()
        scored.write.mode("overwrite").parquet(path)
        took = (time.time() - t0) * 1000.0
        bad.write.mode("overwrite").parquet(os.path.join(sink, "quarantine", f"batch={batch_id}"))
        done = batch.sparkSession.read.schema(scored.schema).parquet(path)
        SC.log_rows(done, "stream", ["fields_defaulted", "inputs"], took / max(done.count(), 1)).write.mode("overwrite").json(
            os.path.join(sink, "log", f"batch={batch_id}"))
        written.append(batch_id)

    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.json(src).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    def sunk(name: str, schema: str) -> DataFrame:
        """What the batches wrote; no records, no batch, no rows."""
        folder = os.path.join(sink, name)
        return spark.read.schema(schema).parquet(folder) if written else spark.createDataFrame([], schema)

    scored = sunk("scored", SCORED).select(
        "request_id", F.lit("scored").alias("status"), "predicted_price", "price_range_low", "price_range_high",
        "fields_defaulted", F.array_join("warnings", " | ").alias("warnings"), F.lit(None).cast("string").alias("errors"))
    bad = sunk("quarantine", "request_id bigint, errors string").select(
        "request_id", F.lit("quarantined").alias("status"), "errors")
    return scored.unionByName(bad, allowMissingColumns=True)
