"""Table profiling: every statistic is a DataFrame aggregation.

Scale notes
-----------
* All per-column statistics of one kind come from ONE scan: a wide
  aggregate produces a single row that is unpivoted into a long table.
* Categorical statistics unpivot the string columns to (column, value) and
  count with a partially-aggregated ``groupBy`` -- map-side combine keeps the
  shuffle at (#columns x #levels) rows per task, whatever the row count or a
  hot level's share.
* Exact medians use Spark's ``percentile`` aggregate, whose buffer is a
  value->count map (bounded by the *distinct* values of a group, merged
  map-side), matching linear-interpolated NumPy/DuckDB quantiles.  Pass
  ``exact=False`` to switch to ``percentile_approx`` for continuous columns
  with unbounded distinct counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.config import ABSENT_PATTERNS, PRICE_BANDS
from terrace.functions.exprs import (adjusted_skew, band_label, band_order, col,
                                     count_null, numeric_columns, string_columns)


def median_of(c: Column, exact: bool = True) -> Column:
    return F.median(c) if exact else F.percentile_approx(c, 0.5, 10000).cast("double")


def _long(one_row: DataFrame, names: Sequence[str], prefix_fields: Sequence[str],
          name_col: str = "column") -> DataFrame:
    """Unpivot a one-row frame with fields ``<field>__<i>`` into rows per name."""
    structs = []
    for i, n in enumerate(names):
        fields = [F.lit(n).alias(name_col), F.lit(i).alias("pos")]
        fields += [F.col(f"{p}__{i}").alias(p) for p in prefix_fields]
        structs.append(F.struct(*fields))
    return one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# ---------------------------------------------------------------- PROF-1/5
def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric and non-numeric column counts (one scan)."""
    n_num = len(numeric_columns(df))
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(n_num).cast("bigint").alias("n_numeric"),
        F.lit(len(df.columns) - n_num).cast("bigint").alias("n_object"),
    )


# ---------------------------------------------------------------- PROF-2
def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows beyond the first of each identical row (NULLs compare equal).

    Digests first: 128 bits per row are counted, so the shuffle of the whole
    table does not depend on its width.  Whole rows move only where a digest
    occurs twice and are then compared themselves, so a collision changes
    nothing; they are combined map-side, so a heavily repeated row travels as
    one (row, count) pair per task.  The repeated digests are written; up to
    ``broadcast_rows`` of them (24 bytes each) are broadcast, more are joined by
    their hash.  ``-0.0`` equals ``0.0`` and NaN equals NaN, as in ``groupBy``.
    """
    from terrace.session import scratch_path
    spark, cols = df.sparkSession, list(cols or df.columns)
    rows = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    names = rows.columns
    # NULLs leave a hash as it is, so their places are hashed too
    places = [F.col(c).isNull() for c in names]
    hashed = rows.select(*names, F.xxhash64(*names, *places).alias("h1"),
                         F.xxhash64(F.lit("second"), *names, *places).alias("h2"))
    counts = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "repeated")
    counts.filter(F.col("n") > 1).write.parquet(path)
    repeated = spark.read.parquet(path)
    size = repeated.agg(F.count(F.lit(1)).alias("digests"), F.sum("n").alias("n")).first()
    alone = rows.count() - (size["n"] or 0)  # rows whose digest is their own
    few = repeated.select("h1", "h2")
    few = F.broadcast(few) if size["digests"] <= broadcast_rows else few
    whole = hashed.join(few, ["h1", "h2"], "left_semi").groupBy("h1", "h2", *names).agg(F.count(F.lit(1)).alias("n"))
    return whole.agg((F.coalesce(F.sum("n"), F.lit(0)) + alone).cast("bigint").alias("n_rows"),
                     (F.count(F.lit(1)) + alone).cast("bigint").alias("n_distinct"),
                     F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


# ---------------------------------------------------------------- PROF-3
def target_profile(df: DataFrame, target: str, exact: bool = True) -> DataFrame:
    from terrace.operators.quantile import column_quantiles
    y = col(target).cast("double")
    ly = F.log1p(y)
    if exact:
        meds = column_quantiles(df.select(y.alias("y"), ly.alias("ly")), ["y", "ly"], [0.5])
        med, lmed = F.lit((meds["y"] or [None])[0]), F.lit((meds["ly"] or [None])[0])
    else:
        med, lmed = median_of(y, False), median_of(ly, False)
    return df.agg(
        F.count(y).cast("bigint").alias("n"),
        F.avg(y).alias("mean"), med.cast("double").alias("median"),
        adjusted_skew(y).alias("skew"),
        F.avg(ly).alias("log_mean"), lmed.cast("double").alias("log_median"),
        adjusted_skew(ly).alias("log_skew"),
    )


# ---------------------------------------------------------------- PROF-4
def na_meaning(name_col: Column, patterns: Sequence[str] = ABSENT_PATTERNS) -> Column:
    """'absent' if the column name starts with or contains a pattern."""
    cond = F.lit(False)
    for p in patterns:
        cond = cond | name_col.contains(p)
    return F.when(cond, F.lit("absent")).otherwise(F.lit("unknown"))


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct, na_meaning) for columns with NULLs."""
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [count_null(col(c)).alias(f"m__{i}") for i, c in enumerate(names)]
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"m__{i}").alias("missing_count"),
                        F.col("n_rows").alias("n_rows")) for i, c in enumerate(names)]
    out = one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
    return (out.filter(F.col("missing_count") > 0)
            .select("column", "missing_count",
                    F.round(F.col("missing_count") * 100.0 / F.col("n_rows"), 2).alias("missing_pct"),
                    na_meaning(F.col("column")).alias("na_meaning"))
            .orderBy(F.col("missing_count").desc(), "column"))


def missing_totals(profile: DataFrame) -> DataFrame:
    return profile.groupBy("na_meaning").agg(F.count(F.lit(1)).cast("bigint").alias("n_columns"),
                                             F.sum("missing_count").cast("bigint").alias("n_missing"))


# ---------------------------------------------------------------- PROF-5
def skew_table(df: DataFrame, cols: Sequence[str] | None = None,
               threshold: float | None = 0.75) -> DataFrame:
    """Adjusted skewness per numeric column from one scan in long form (map-side
    combined moments per column); |skew| > threshold."""
    cols = list(cols or numeric_columns(df))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("x")) for c in cols])).alias("s")).select("s.*")
    out = long.groupBy("column").agg(adjusted_skew(F.col("x")).alias("skew")).filter(F.col("skew").isNotNull())
    if threshold is not None:
        out = out.filter(F.abs("skew") > threshold)
    return out.select("column", "skew").orderBy(F.abs("skew").desc())


# ---------------------------------------------------------------- PROF-6..9
def _comoments(df: DataFrame, left: list[tuple[int, str]], right: list[tuple[int, str]], shift: dict) -> DataFrame:
    """Co-moments of the pairs (left, right) of one tile, summed over all tasks;
    a tile of a block with itself gives the pairs i <= j.  It reads the
    columns of its two blocks only."""
    import numpy as np
    import pandas as pd

    same, k = left == right, len(left)
    used = left if same else left + right
    x = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in used])
    means = np.array([shift[i] for i, _ in used])
    pos = np.array([i for i, _ in used], dtype="int32")
    width = k if same else len(right)
    rows, others = np.triu_indices(k) if same else (a.ravel() for a in np.indices((k, width)))
    first, second = pos[rows], pos[others if same else others + k]

    def comoments(batches):
        acc = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            a = pdf.to_numpy(dtype=float, na_value=np.nan) - means
            m = (~np.isnan(a)).astype(float)
            a0 = np.where(m > 0, a, 0.0)
            (ma, mb), (xa, xb) = ((m, m), (a0, a0)) if same else ((m[:, :k], m[:, k:]), (a0[:, :k], a0[:, k:]))
            part = (ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb)
            acc = part if acc is None else tuple(u + v for u, v in zip(acc, part))
        if acc is None:
            return
        yield pd.DataFrame({"pos_a": first, "pos_b": second, **{
            c: v[rows, others] for c, v in zip(("n", "sa", "sb", "saa", "sbb", "sab"), acc)}})

    schema = "pos_a int, pos_b int, n double, sa double, sb double, saa double, sbb double, sab double"
    return x.mapInPandas(comoments, schema)


def correlation_long(df: DataFrame, cols: Sequence[str], block: int = 256) -> DataFrame:
    """Pairwise-complete Pearson r for every unordered pair (i <= j).

    Returns (col_a, col_b, pos_a, pos_b, r).  The columns are cut into blocks;
    each pair of blocks is a tile with a scan of its own (column-pruned to the
    two blocks), whose tasks reduce their Arrow batches with NumPy to ``block``
    x ``block`` co-moments (n, sums, sums of squares and cross products over
    the rows where both columns are present).  So no task holds p x p values
    (six matrices of ``block`` squared: 3 MB), and p columns are read
    p / ``block`` + 1 times; up to ``block`` columns there is one scan.  The
    shuffle is #tasks x pairs.  Columns are shifted by their global means
    first (one cheap pass per block) so the raw-moment formula does not cancel
    catastrophically.
    """
    cols = list(cols)
    places = list(enumerate(cols))
    blocks = [places[at:at + block] for at in range(0, len(places), block)]
    shift: dict[int, float] = {}
    for b in blocks:
        means = df.agg(*[F.avg(col(c).cast("double")).alias(f"c{i}") for i, c in b]).first()
        shift.update({i: means[f"c{i}"] if means[f"c{i}"] is not None else 0.0 for i, _ in b})
    tiles = [_comoments(df, a, b, shift) for i, a in enumerate(blocks) for b in blocks[i:]]
    m = reduce(DataFrame.unionByName, tiles).groupBy("pos_a", "pos_b").agg(
        *[F.sum(c).alias(c) for c in ["n", "sa", "sb", "saa", "sbb", "sab"]])
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    va = n * F.col("saa") - sa * sa
    vb = n * F.col("sbb") - sb * sb
    r = F.when((n < 2) | (va <= 0) | (vb <= 0), F.lit(None).cast("double")) \
        .otherwise((n * F.col("sab") - sa * sb) / F.sqrt(va * vb))
    # least and greatest skip NULLs, so an undefined r must stay out of them
    r = F.when(r.isNotNull(), F.when(F.col("pos_a") == F.col("pos_b"), F.lit(1.0)).otherwise(
        F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))))
    names = F.array(*[F.lit(c) for c in cols])
    return m.select(names[F.col("pos_a")].alias("col_a"), names[F.col("pos_b")].alias("col_b"),
                    "pos_a", "pos_b", r.alias("r"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Symmetric long form (col_a, col_b, r) including both triangles."""
    tri = correlation_long(df, cols).cache()
    mirror = tri.filter(F.col("pos_a") != F.col("pos_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"),
        F.col("pos_b").alias("pos_a"), F.col("pos_a").alias("pos_b"), "r")
    return tri.unionByName(mirror)


def top_correlations(corr_long: DataFrame, target: str, k: int = 15) -> DataFrame:
    """Top-k features by |r| with the target (sign kept)."""
    t = corr_long.filter((F.col("col_a") == target) | (F.col("col_b") == target)) \
        .filter(F.col("col_a") != F.col("col_b"))
    t = t.select(F.when(F.col("col_a") == target, F.col("col_b")).otherwise(F.col("col_a"))
                 .alias("feature"), "r")
    return t.filter(F.col("r").isNotNull()).orderBy(F.abs("r").desc(), "feature").limit(k)


def collinear_pairs(corr_long: DataFrame, target: str, threshold: float = 0.85) -> DataFrame:
    return (corr_long.filter((F.col("pos_a") < F.col("pos_b")) & (F.col("col_a") != target)
                             & (F.col("col_b") != target) & (F.abs("r") > threshold))
            .select(F.col("col_a").alias("feature_1"), F.col("col_b").alias("feature_2"), "r")
            .orderBy(F.abs("r").desc()))


# ---------------------------------------------------------------- PROF-10..12
def level_counts(df: DataFrame, cols: Sequence[str] | None = None,
                 drop_null: bool = False) -> DataFrame:
    """(column, value, n) for every categorical column in one scan.

    The stack/unpivot keeps one output row per input cell; the aggregation
    that follows is combined map-side, so a dominant level costs one row per
    task in the shuffle.
    """
    cols = list(cols or string_columns(df))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*")
    if drop_null:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def near_constant(df: DataFrame, cols: Sequence[str] | None = None,
                  threshold_pct: float = 95.0) -> DataFrame:
    """Dominant value and its share per column (NULL counted as a value).

    Ties go to the smallest non-NULL value (pinned, engine-independent).
    """
    counts = level_counts(df, cols)
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").isNull().alias("isnull"),
                       F.col("value").alias("value"))).alias("b"),
        F.sum("n").alias("total"))
    return best.select(
        "column",
        F.coalesce(F.col("b.value"), F.lit("nan")).alias("dominant_value"),
        F.round(-F.col("b.neg_n") * 100.0 / F.col("total"), 2).alias("share_pct"),
        (-F.col("b.neg_n") * 100.0 / F.col("total") > threshold_pct).alias("near_constant"),
    ).orderBy(F.col("share_pct").desc(), "column")


def rare_levels(df: DataFrame, cols: Sequence[str] | None = None, min_count: int = 10) -> DataFrame:
    counts = level_counts(df, cols, drop_null=True)
    return (counts.filter(F.col("n") < min_count)
            .select("column", F.col("value").alias("level"), F.col("n").alias("count"))
            .orderBy("column", "count", "level"))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Absolute and normalised counts, with and without NULL."""
    g = df.groupBy(col(c).alias("level")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("total"), F.count(col(c)).alias("non_null"))
    t = tot.first()  # two scalars of fitted state
    total, non_null = float(t["total"]), float(t["non_null"])
    return g.select("level", "n",
                    (F.col("n") / F.lit(total)).alias("share"),
                    F.when(F.col("level").isNull(), F.lit(None).cast("double"))
                    .otherwise(F.col("n") / F.lit(non_null if non_null else float("nan")))
                    .alias("share_non_null"))


# ---------------------------------------------------------------- PROF-13
def band_counts(df: DataFrame, value: str, bands=PRICE_BANDS) -> DataFrame:
    """Counts and percentages in fixed band order; empty bands report 0."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(i, b[0]) for i, b in enumerate(bands)], "band_order int, band string")
    v = col(value)
    g = (df.select(band_order(v, bands).alias("band_order"))
         .groupBy("band_order").agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    out = dim.join(g, "band_order", "left").select(
        "band_order", "band", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
    out = out.cache()  # len(bands) rows
    total = out.agg(F.sum("count")).first()[0] or 0
    return out.select("band_order", "band", "count",
                      F.round(F.col("count") * 100.0 / F.lit(float(total) or float("nan")), 2)
                      .alias("pct")).orderBy("band_order")


# ---------------------------------------------------------------- PROF-14..18
def group_stats(df: DataFrame, group: str, value: str, exact: bool = True) -> DataFrame:
    """count / median / mean / min / max per group.  The median comes from
    :func:`grouped_quantiles` (bounded per-task state for hot groups) and is
    attached with a NULL-safe join of two one-row-per-group tables."""
    from terrace.operators.quantile import grouped_quantiles
    v = col(value).cast("double")
    g = df.groupBy(col(group).alias(group)).agg(
        F.count(v).cast("bigint").alias("count"), F.avg(v).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    if exact:
        m = grouped_quantiles(df, [group], value, [0.5]).select(
            col(group).alias("_k"), F.col("q")[0].alias("median"))
    else:
        m = df.groupBy(col(group).alias("_k")).agg(median_of(v, False).alias("median"))
    j = g.join(m, col(group).eqNullSafe(F.col("_k")), "left").drop("_k")
    return j.select(group, "count", "median", "mean", "min", "max")


def group_stats_share(df: DataFrame, group: str, value: str) -> DataFrame:
    g = group_stats(df, group, value).drop("min", "max").cache()  # one row per group
    total = g.agg(F.sum("count")).first()[0] or 0
    return g.withColumn("share_pct", F.col("count") * 100.0 / F.lit(float(total))) \
        .orderBy(F.col("count").desc(), group)


def premium_vs_base(df: DataFrame, group: str, value: str, base_level: str) -> DataFrame:
    """Each group's median relative to the base group's median, in percent."""
    g = group_stats(df, group, value).select(group, "count", "median")
    base = g.filter(col(group) == base_level).select(F.col("median").alias("base_median"))
    b = base.first()
    bm = b["base_median"] if b else None
    return g.select(group, "count", "median", F.lit(bm).cast("double").alias("base_median"),
                    ((F.col("median") / F.lit(bm) - 1.0) * 100.0).alias("premium_pct"))


def group_extremes(df: DataFrame, group: str, value: str, k: int = 3) -> DataFrame:
    """Top-k and bottom-k groups by median (ties by name), tagged."""
    g = group_stats(df, group, value).select(group, "count", "median", "min", "max").cache()
    top = g.orderBy(F.col("median").desc(), col(group)).limit(k).withColumn("tag", F.lit("top"))
    bot = g.orderBy(F.col("median").asc(), col(group)).limit(k).withColumn("tag", F.lit("bottom"))
    return top.unionByName(bot)


def group_median_ratio(df: DataFrame, group: str, value: str) -> DataFrame:
    g = group_stats(df, group, value)
    return g.agg(F.max("median").alias("highest_median"), F.min("median").alias("lowest_median"),
                 (F.max("median") / F.min("median")).alias("ratio"))


# ---------------------------------------------------------------- PROF-19
def feature_target_corr(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the log target; NULL for a constant."""
    ly = F.log1p(col(target).cast("double"))
    present = [c for c in features if c in df.columns]

    def corr(x: Column) -> Column:
        a, b = F.when(ly.isNotNull(), x), F.when(x.isNotNull(), ly)
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))

    one = df.agg(*[corr(col(c).cast("double")).alias(f"r__{i}") for i, c in enumerate(present)])
    return _long(one, present, ["r"], name_col="feature").select("feature", "r") \
        .orderBy(F.abs("r").desc_nulls_last())


# ---------------------------------------------------------------- PROF-20
def histogram(df: DataFrame, value: Column, bins: int = 40, label: str = "raw") -> DataFrame:
    """Equal-width histogram with all its bins, empty ones too: one scan for the
    range, one for the counts.  No rows when there is no value."""
    r = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if r["lo"] is None:
        return df.sparkSession.createDataFrame([], "scale string, bin int, bin_lo double, bin_hi double, count bigint")
    lo, hi = float(r["lo"]), float(r["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((value - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    g = df.filter(value.isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    g = every.join(g, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    return g.select(F.lit(label).alias("scale"), "bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "count")


# ---------------------------------------------------------------- PROF-21
def boxplot_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (clamped to data) and outlier count per group."""
    from terrace.operators.quantile import grouped_quantiles
    v = col(value).cast("double")
    q = grouped_quantiles(df, [group], value, [0.25, 0.5, 0.75]).withColumnRenamed("q", "qs")
    q = q.select(group, F.col("qs")[0].alias("q1"), F.col("qs")[1].alias("median"),
                 F.col("qs")[2].alias("q3"))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # one stats row per group; AQE broadcasts it when its measured size is small
    j = df.select(col(group).alias(group), v.alias("v")).join(q, group)
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    w = j.groupBy(group).agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"),
        F.count(F.lit(1)).cast("bigint").alias("count"))
    return q.join(w, group).select(group, "count", "q1", "median", "q3", "whisker_lo",
                                   "whisker_hi", "n_outliers").orderBy("median", group)


__all__ = [n for n in dir() if not n.startswith("_")]
