"""Column-expression helpers.  Everything here returns a native ``Column`` so
it stays inside whole-stage codegen; nothing touches row data on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_32 = 4294967296.0


def q(name: str) -> str:
    """Back-quote a column name for SQL text (names may start with a digit)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def has(df: DataFrame, *names: str) -> bool:
    cols = set(df.columns)
    return all(n in cols for n in names)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# ---------------------------------------------------------------------------
# deterministic hash randomness (repartition-stable, replayable in SQL)
# ---------------------------------------------------------------------------

def hash_u32(salt: str | Column, key: str | Column) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5(salt:key)."""
    salt_c = F.lit(str(salt)) if isinstance(salt, (str, int)) else salt
    key_c = col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(salt_c, F.lit(":"), key_c.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(salt: str | Column, key: str | Column) -> Column:
    """Uniform in [0, 1) derived from :func:`hash_u32`."""
    return hash_u32(salt, key) / F.lit(TWO_32)


# ---------------------------------------------------------------------------
# null-safe predicates and arithmetic
# ---------------------------------------------------------------------------

def flag(cond: Column, null_as: int = 0) -> Column:
    """0/1 int of a predicate; a NULL comparison becomes ``null_as``."""
    return F.coalesce(cond.cast("int"), F.lit(null_as))


def not_true(cond: Column) -> Column:
    """Rows where ``cond`` is False *or NULL* (pandas ``df[~mask]``)."""
    return ~F.coalesce(cond, F.lit(False))


def clip_low(c: Column, lo: float = 0) -> Column:
    """``max(c, lo)`` that keeps NULL (``greatest`` would skip it)."""
    return F.when(c < lo, F.lit(lo)).otherwise(c)


def safe_ratio(num: Column, den: Column, fill: float = 0.0) -> Column:
    """num/den with den 0 or NULL -> ``fill``."""
    return F.coalesce(F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0))),
                      F.lit(fill))


def to_number(c: Column) -> Column:
    """``to_numeric(errors='coerce')``: unparseable -> NULL, never raises."""
    return c.try_cast("double")


def code_string(c: Column) -> Column:
    """Code -> string; a whole number is written without a trailing ``.0``
    (train/serve stable), anything else as it is; never raises."""
    s = c.cast("string")
    number = s.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.coalesce(s.try_cast("bigint").cast("string"), F.when(whole, number.try_cast("bigint").cast("string")), s)


# ---------------------------------------------------------------------------
# aggregate helpers
# ---------------------------------------------------------------------------

def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted sample skewness G1 (pandas ``Series.skew``).

    G1 = g1 * sqrt(n(n-1)) / (n-2); NULL for n < 3, 0.0 for a constant column.
    """
    x = c.cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_pop(x) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def count_null(c: Column) -> Column:
    return F.count_if(c.isNull()).cast("bigint")


# ---------------------------------------------------------------------------
# banding
# ---------------------------------------------------------------------------

def band_label(c: Column, bands: Sequence[tuple[str, float | None, float | None]]) -> Column:
    """Half-open [lo, hi) fixed-edge banding to a label (NULL outside)."""
    expr = None
    for label, lo, hi in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_order(c: Column, bands: Sequence[tuple[str, float | None, float | None]]) -> Column:
    expr = None
    for i, (_, lo, hi) in enumerate(bands):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c < hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def quantile_bin(c: Column, inner_edges: Column) -> Column:
    """Bin index for ``qcut``-style bins given an array of inner edges.

    Intervals are right-closed with the lowest included, so the bin is the
    number of inner edges strictly below the value.  Duplicate edges merge.
    """
    return F.size(F.filter(F.array_distinct(inner_edges), lambda e: c > e))


# ---------------------------------------------------------------------------
# Yeo-Johnson
# ---------------------------------------------------------------------------

def yeo_johnson(x: Column, lam: Column | float) -> Column:
    """Yeo-Johnson power transform of ``x`` for parameter ``lam`` (no scaling)."""
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    xd = x.cast("double")
    pos_log = F.log1p(xd)
    neg_log = F.log1p(-xd)
    pos = F.when(F.abs(lam_c) < 1e-12, pos_log).otherwise(
        (F.exp(lam_c * pos_log) - 1.0) / lam_c)
    neg = F.when(F.abs(lam_c - 2.0) < 1e-12, -neg_log).otherwise(
        -(F.exp((2.0 - lam_c) * neg_log) - 1.0) / (2.0 - lam_c))
    return F.when(xd.isNull(), F.lit(None).cast("double")).when(xd >= 0, pos).otherwise(neg)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (presentation; both engines round alike)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(col(f.name), digits).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)
