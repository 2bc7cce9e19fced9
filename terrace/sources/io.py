"""Sources and sinks: CSV with a missing-token set, parquet splits, JSON
documents, table / file fingerprints and the run-log table.

All readers take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import NA_TOKENS
from terrace.functions.exprs import col
from terrace.sources import digests


def _as_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType,
                tokens: Sequence[str] = NA_TOKENS, header: bool = True) -> DataFrame:
    """Read CSV with a whole SET of missing-value tokens.

    Spark's CSV reader knows a single ``nullValue``; every field is read as a
    string, any token of the set becomes NULL, and the rest is converted with
    ``try_cast`` (unparseable -> NULL, never an error; NaN -> NULL)."""
    raw = (spark.read.schema(_as_strings(schema)).option("header", header)
           .option("nullValue", "").option("emptyValue", "").csv(path))
    toks = F.array(*[F.lit(t) for t in tokens])
    out = []
    for f in schema.fields:
        c = col(f.name)
        v = F.when(c.isNull() | F.array_contains(toks, c), F.lit(None).cast("string")).otherwise(c)
        if not isinstance(f.dataType, T.StringType):
            v = v.try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                v = F.when(F.isnan(v), F.lit(None).cast(f.dataType)).otherwise(v)
        out.append(v.alias(f.name))
    return raw.select(*out)


def write_csv(df: DataFrame, path: str, na_rep: str = "NA", files: int | None = None) -> None:
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("header", True).option("nullValue", na_rep).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _render(name: str, kind: T.DataType) -> Column:
    c = col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.format_string("%.6f", c.cast("double"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("string")
    return c.cast("string")


def row_text(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """One string per row that tells all rows apart: every field with its length
    before it, NULL as ``~`` (doubles to six decimals, timestamps in
    microseconds, so that any engine can write the same)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in cols or df.columns:
        s = _render(c, kinds[c])
        parts.append(F.when(col(c).isNotNull(), F.concat(F.length(s).cast("string"), F.lit("="), s)).otherwise(F.lit("~")))
    return F.concat_ws("|", *parts)


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-free content fingerprint of all columns in one aggregation: the
    rows, and the sums of two 60-bit parts of the rows' md5 (decimals, so no
    row count overflows them) -- independent of partitioning and file layout."""
    h = df.select(F.md5(row_text(df, cols)).alias("h"))
    part = [F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 17)]
    return h.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.concat_ws("-", *[F.coalesce(p, F.lit(0)).cast("decimal(38,0)").cast("string") for p in part]).alias("fingerprint"))


def file_fingerprint(spark: SparkSession, path: str, block: int = 8 << 20) -> DataFrame:
    """md5 of every file's bytes under ``path``, files of any size
    (``terrace.sources.digests``: constant memory per task)."""
    digests.register(spark)
    return (spark.read.format("file_digests").option("block", block).load(path)
            .select("file", "length", "md5"))


RUN_LOG_SCHEMA = ("run string, stage string, kind string, key string, value_num double, "
                  "value_str string")


def run_log_rows(spark: SparkSession, run: str, stage: str, params: dict | None = None,
                 metrics: dict | None = None, tags: dict | None = None) -> DataFrame:
    rows = []
    for kind, d in (("param", params or {}), ("metric", metrics or {}), ("tag", tags or {})):
        for k, v in d.items():
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                rows.append((run, stage, kind, k, float(v), None))
            else:
                rows.append((run, stage, kind, k, None, None if v is None else str(v)))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


_ATTEMPT = ", attempt string, attempt_rows bigint, at timestamp"


def append_run_log(df: DataFrame, path: str, attempt: str | None = None) -> None:
    """Appends the rows of one or more (run, stage) as one attempt.

    Writers only add files, so any number may write at a time.  Every row names
    its attempt and how many rows that has; :func:`read_run_log` resolves retries
    and passes over attempts that were not written to their end.  A stage that
    logs no row leaves none."""
    (df.withColumns({"attempt": F.lit(attempt or uuid.uuid4().hex), "attempt_rows": F.lit(df.count()).cast("bigint"),
                     "at": F.current_timestamp()}).write.mode("append").parquet(path))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Of each (run, stage) the rows of its last whole attempt (latest time, then
    greatest name).  An attempt that was written twice under one name counts once;
    an attempt with fewer rows than it names is passed over."""
    log = spark.read.schema(RUN_LOG_SCHEMA + _ATTEMPT).parquet(path)
    key = ["attempt", "run", "stage", "kind", "key"]
    rows = log.groupBy(*key).agg(F.max_by(F.struct("value_num", "value_str", "attempt_rows"), "at").alias("v"),
                                 F.max("at").alias("at")).select(*key, "v.*", "at")
    whole = rows.groupBy("attempt").agg(F.count(F.lit(1)).alias("n"), F.max("attempt_rows").alias("of"), F.max("at").alias("end"))
    rows = rows.join(whole.filter(F.col("n") == F.col("of")).select("attempt", "end"), "attempt")
    last = rows.groupBy("run", "stage").agg(F.max(F.struct("end", "attempt")).alias("m")).select("run", "stage", "m.attempt")
    return rows.join(last, ["run", "stage", "attempt"], "left_semi").select(
        "run", "stage", "kind", "key", "value_num", "value_str")


def widen_run_log(log: DataFrame) -> DataFrame:
    """One row per run with params / metrics / tags as maps."""
    entry = F.struct("key", F.coalesce(F.col("value_str"), F.col("value_num").cast("string")))
    return log.groupBy("run", "stage").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == k, entry))).alias(k + "s")
        for k in ("param", "metric", "tag")])
