"""Record scoring as set-based DataFrame operators (batch and streaming).

The per-request work of a prediction service -- validate, normalise
aliases, fill defaults, warn, predict, attach an interval, log -- is done
here on a whole DataFrame of records with native expressions, so the same
functions serve a batch table and a Structured Streaming source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import (ALLOWED_SETS, NEIGHBORHOODS, NUMERIC_RANGES, REQUEST_ALIASES,
                            REQUIRED_FIELDS)
from terrace.functions.exprs import col

WARN_YEAR = ("YearBuilt or YearRemodAdd > 2010 outside training data range; "
             "prediction less reliable")
WARN_SOLD = "YrSold outside 2006-2010 training data range; prediction less reliable"


def normalise(df: DataFrame, aliases: dict[str, str] = REQUEST_ALIASES) -> DataFrame:
    """Alias fields fill their canonical column (NULLs ignored); extra keys stay untouched."""
    out = df
    for alias, canonical in aliases.items():
        if alias not in out.columns:
            continue
        if canonical in out.columns:
            out = out.withColumn(canonical, F.coalesce(col(alias), col(canonical)))
        else:
            out = out.withColumn(canonical, col(alias))
        out = out.drop(alias)
    return out


def coerce_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Reads fields that arrived as text as their declared numeric types.  A
    value that is none (or has a fraction where an integer is declared) becomes
    NULL and leaves ``field: wrong type`` in the array column ``_wrong``."""
    from terrace.functions.exprs import is_numeric
    present = {f.name: f.dataType for f in df.schema.fields}
    out, wrong = [], []
    for name, kind in present.items():
        want = types.get(name)
        if want is None or not is_numeric(want) or not isinstance(kind, T.StringType):
            out.append(col(name))
            continue
        number = col(name).try_cast("double")
        bad = col(name).isNotNull() & number.isNull()
        if isinstance(want, T.IntegralType):
            bad = bad | (number != F.floor(number))
        wrong.append(F.when(bad, F.lit(f"{name}: wrong type")))
        out.append(F.when(~F.coalesce(bad, F.lit(False)), number).try_cast(want).alias(name))
    found = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    return df.select(*out, found.alias("_wrong"))


def _fmt(x) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def validation_errors(df: DataFrame) -> Column:
    """array<string> of ``field: reason`` messages (empty = valid)."""
    msgs: list[Column] = []
    typed = "_wrong" in df.columns
    for f in REQUIRED_FIELDS:
        if f not in df.columns:
            msgs.append(F.lit(f"{f}: field required"))
        else:
            missing = col(f).isNull()
            if typed:
                missing = missing & ~F.array_contains("_wrong", f"{f}: wrong type")
            msgs.append(F.when(missing, F.lit(f"{f}: field required")))
    for f, (lo, hi) in NUMERIC_RANGES.items():
        if f in df.columns:
            v = col(f).cast("double")
            msgs.append(F.when(v.isNotNull() & ((v < lo) | (v > hi)),
                               F.lit(f"{f}: out of range [{_fmt(lo)}, {_fmt(hi)}]")))
    sets = dict(ALLOWED_SETS)
    sets["Neighborhood"] = NEIGHBORHOODS
    for f, allowed in sets.items():
        if f in df.columns:
            msgs.append(F.when(col(f).isNotNull() & ~col(f).isin(*allowed),
                               F.lit(f"{f}: not an allowed value")))
    found = F.array_compact(F.array(*msgs))
    return F.concat(found, F.col("_wrong")) if typed else found


def validate(df: DataFrame) -> DataFrame:
    """Adds ``errors`` (array) and ``is_valid``; split good / quarantine on it."""
    return df.withColumn("errors", validation_errors(df)) \
        .withColumn("is_valid", F.size("errors") == 0).drop("_wrong")


def fill_defaults(df: DataFrame, defaults: dict, raw_columns: Sequence[str],
                  types: dict[str, T.DataType]) -> DataFrame:
    """Missing raw fields take the training default (literal coalesce: no join).
    Numeric fields come out as doubles, because a default may be a fractional
    median of an integral column.

    ``fields_defaulted`` = number of raw columns the record did not supply."""
    supplied = [F.when(col(c).isNotNull(), 1).otherwise(0) for c in raw_columns if c in df.columns]
    n_supplied = sum(supplied[1:], supplied[0]) if supplied else F.lit(0)
    out = df.withColumn("fields_defaulted", (F.lit(len(raw_columns)) - n_supplied).cast("int"))
    from terrace.functions.exprs import is_numeric
    cols = []
    for c in raw_columns:
        d = defaults.get(c)
        kind = T.DoubleType() if is_numeric(types[c]) else types[c]
        lit = F.lit(d).cast(kind)
        cols.append((F.coalesce(col(c).cast(kind), lit) if c in df.columns else lit).alias(c))
    keep = [col(c) for c in out.columns if c not in raw_columns]
    return out.select(*keep, *cols)


def record_warnings(df: DataFrame) -> Column:
    yb, yra, ys = col("YearBuilt"), col("YearRemodAdd"), col("YrSold")
    return F.array_compact(F.array(
        F.when(F.coalesce(yb > 2010, F.lit(False)) | F.coalesce(yra > 2010, F.lit(False)),
               F.lit(WARN_YEAR)),
        F.when(ys.isNotNull() & ((ys < 2006) | (ys > 2010)), F.lit(WARN_SOLD))))


def price_interval(pred: Column, mape: float) -> tuple[Column, Column, Column]:
    p = F.round(pred, 2)
    return p, F.round(p * (1.0 - mape), 2), F.round(p * (1.0 + mape), 2)


def log_rows(scored: DataFrame, endpoint: str, input_fields: Sequence[str],
             latency_ms: float | None = None) -> DataFrame:
    """One log row per scored record: endpoint, input fields as JSON, prediction,
    warnings and the time that scoring took per record."""
    return scored.select(
        F.current_timestamp().alias("timestamp"), F.lit(endpoint).alias("endpoint"),
        F.to_json(F.struct(*[col(c) for c in input_fields if c in scored.columns]))
        .alias("input_fields"),
        F.col("predicted_price").alias("prediction"), F.col("warnings"),
        F.col("request_id"), F.lit(latency_ms).cast("double").alias("latency_ms"))
