"""Deterministic splitting, stratification and fold assignment.

Randomness is an md5 hash of (seed, id): repartition-stable, replayable in
SQL, and never needs a global sort.  Exact per-stratum allocation needs the
rank of every row inside its stratum; :func:`hash_rank` gets it without an
unpartitioned window by ranking in two levels:

1. count rows per (stratum, top 16 bits of the hash)  -> <= strata x 65,536 rows
2. cumulative counts over those buckets               -> offset of each bucket
3. ``row_number`` only *inside* one (stratum, bucket)  -> ~1/65,536 of a stratum

so no task ever holds more than a 1/65,536 slice of a stratum, even when one
stratum carries a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrace.functions.exprs import col, hash_u32, hash_uniform, quantile_bin


def quantile_edges(df: DataFrame, value: str, q: int, exact: bool = True) -> list[float]:
    """Inner edges of ``q`` quantile bins (linear interpolation), fitted state."""
    from terrace.operators.quantile import column_quantiles
    probs = [i / q for i in range(1, q)]
    if exact:
        e = column_quantiles(df, [value], probs)[value]
    else:
        e = df.agg(F.percentile_approx(col(value).cast("double"), probs, 10000)).first()[0]
    return [float(x) for x in (e or [])]


def with_quantile_bin(df: DataFrame, value: str, q: int, name: str = "stratum",
                      exact: bool = True) -> DataFrame:
    edges = quantile_edges(df, value, q, exact)
    arr = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>")
    return df.withColumn(name, quantile_bin(col(value).cast("double"), arr).cast("int"))


def hash_rank(df: DataFrame, id_col: str, salt: str, partition: Sequence[str] = (),
              name: str = "rank") -> DataFrame:
    """1-based rank of each row inside ``partition`` ordered by (hash, id)."""
    part = [col(p) for p in partition]
    u = hash_u32(salt, id_col)
    d = df.withColumn("_u", u).withColumn("_hi", F.shiftright(F.col("_u"), 16))
    keys = list(partition) + ["_hi"]
    counts = d.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*part).orderBy("_hi")
    offsets = counts.withColumn("_before", F.sum("_c").over(w) - F.col("_c")).drop("_c")
    d = d.join(offsets, keys)
    w2 = Window.partitionBy(*[col(k) for k in keys]).orderBy("_u", col(id_col))
    return d.withColumn(name, F.col("_before") + F.row_number().over(w2)).drop("_u", "_hi",
                                                                                 "_before")


def _take_count(n: Column, frac: float) -> Column:
    return F.floor(n * F.lit(float(frac)) + F.lit(0.5)).cast("bigint")


def bernoulli_split(df: DataFrame, id_col: str, target: str, seed: int = 42,
                    train_frac: float = 0.7, test_frac_of_rest: float = 0.5,
                    q1: int = 10, q2: int = 5) -> DataFrame:
    """Fast hash-Bernoulli 70/15/15 split, not stratified; strata (target deciles, then
    quintiles of the remainder) are attached so per-stratum balance can be
    checked.  Expected (not exact) proportions per stratum."""
    d = with_quantile_bin(df, target, q1, "stratum")
    u1 = hash_uniform(f"{seed}:s1", id_col)
    d = d.withColumn("_stage1", F.when(u1 < train_frac, F.lit("train")).otherwise(F.lit("rest")))
    rest = d.filter(F.col("_stage1") == "rest")
    edges2 = quantile_edges(rest, target, q2)
    arr2 = F.array(*[F.lit(e) for e in edges2])
    u2 = hash_uniform(f"{seed}:s2", id_col)
    split = (F.when(F.col("_stage1") == "train", F.lit("train"))
             .when(u2 < 1.0 - test_frac_of_rest, F.lit("val")).otherwise(F.lit("test")))
    stratum2 = F.when(F.col("_stage1") == "rest", quantile_bin(col(target).cast("double"), arr2))
    return d.withColumn("split", split).withColumn("stratum2", stratum2.cast("int")).drop("_stage1")


def _cut_points(narrow: DataFrame, id_col: str, salt: str, stratum: str, frac: float) -> dict:
    """Per stratum, the (hash, id) of the row ranked ``round(n*frac)`` by
    (hash, id): rows at or below it are the exact allocation.  Counts per
    (stratum, leading 16 hash bits) name the bucket that holds the cut; only
    the rows of that bucket are ranked.  The result has one row per stratum."""
    keyed = narrow.select(col(stratum).alias("_s"), hash_u32(salt, id_col).alias("_u"), col(id_col).alias("_id")) \
        .withColumn("_b", F.shiftright("_u", 16))
    counts = keyed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_n", F.expr("sum(_c) over (partition by _s)")).withColumn("_before", F.expr(
        "coalesce(sum(_c) over (partition by _s order by _b rows between unbounded preceding and 1 preceding), 0)"))
    take = _take_count(F.col("_n"), frac)
    held = counts.filter((F.col("_before") < take) & (take <= F.col("_before") + F.col("_c"))).select(
        F.col("_s").alias("_s2"), F.col("_b").alias("_b2"), (take - F.col("_before")).alias("_need"))  # one row per stratum
    rows = keyed.join(F.broadcast(held), F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2")))
    rows = rows.withColumn("_r", F.expr("row_number() over (partition by _s order by _u, _id)"))
    return {r["_s"]: (r["_u"], r["_id"]) for r in rows.filter("_r = _need").collect()}


def _at_or_below(cuts: dict, stratum: str, id_col: str, salt: str) -> Column:
    """True when the row's (hash, id) is at or below its stratum's cut point."""
    u, i = hash_u32(salt, id_col), col(id_col)
    out = F.lit(False)
    for s, (cu, ci) in sorted(cuts.items(), key=lambda kv: (kv[0] is None, kv[0])):
        out = F.when(col(stratum) == F.lit(s),
                     (u < F.lit(cu)) | ((u == F.lit(cu)) & (i <= F.lit(ci)))).otherwise(out)
    return F.coalesce(out, F.lit(False))


def stratified_split(df: DataFrame, id_col: str, target: str, seed: int = 42,
                           train_frac: float = 0.7, test_frac_of_rest: float = 0.5,
                           q1: int = 10, q2: int = 5) -> DataFrame:
    """Exact-size stratified split: in every target-decile stratum the
    ``round(n*(1-train_frac))`` rows with the smallest hash leave training;
    those are split again by quintiles of their own target, the
    ``round(m*test_frac)`` smallest (second hash) per stratum becoming test.

    All ranking runs on the narrow (id, target, stratum) projection and ends
    in one cut point per stratum (at most ``q1 + q2`` literals); the wide rows
    are only projected against those, so nothing wide is cached, joined or
    shuffled."""
    d = with_quantile_bin(df, target, q1, "stratum")
    cut1 = _cut_points(d.select(id_col, "stratum"), id_col, f"{seed}:x1", "stratum",
                       1.0 - train_frac)
    rest = _at_or_below(cut1, "stratum", id_col, f"{seed}:x1")
    rest_rows = d.select(id_col, target, "stratum").filter(rest)
    edges2 = quantile_edges(rest_rows, target, q2)
    arr2 = F.array(*[F.lit(e) for e in edges2]) if edges2 else F.array().cast("array<double>")
    s2 = quantile_bin(col(target).cast("double"), arr2).cast("int")
    cut2 = _cut_points(rest_rows.select(id_col, s2.alias("stratum2")), id_col, f"{seed}:x2",
                       "stratum2", test_frac_of_rest)
    d = d.withColumn("_rest", rest).withColumn("stratum2", F.when(F.col("_rest"), s2))
    test = _at_or_below(cut2, "stratum2", id_col, f"{seed}:x2")
    split = F.when(~F.col("_rest"), F.lit("train")).when(test, F.lit("test")).otherwise(F.lit("val"))
    out = d.withColumn("split", split).drop("_rest")
    cols = ["stratum"] + [c for c in out.columns if c not in ("stratum", "split", "stratum2")] \
        + ["split", "stratum2"]
    return out.select(*cols)


stratified_split_exact = stratified_split


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, salt: str = "fold",
          name: str = "fold") -> DataFrame:
    """Fold = hash(seed, id) mod k: balanced in expectation, stable, no shuffle."""
    return df.withColumn(name, F.pmod(hash_u32(f"{seed}:{salt}", id_col), F.lit(k)).cast("int"))


def kfold_exact(df: DataFrame, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Exactly balanced folds (sizes differ by at most one): fold = (rank-1) mod k
    with the two-level hash rank, so no single task ranks the whole table."""
    r = hash_rank(df, id_col, f"{seed}:kx", (), "_rank")
    return r.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def repeated_kfold(df: DataFrame, id_col: str, k: int = 5, repeats: int = 3,
                   seed: int = 42) -> DataFrame:
    """One row per (row, repeat) with that repeat's fold."""
    arr = F.array(*[F.struct(F.lit(r).alias("repeat"),
                             F.pmod(hash_u32(f"{seed}:r{r}", id_col), F.lit(k)).cast("int")
                             .alias("fold")) for r in range(repeats)])
    return df.withColumn("_rf", F.explode(arr)).select("*", "_rf.repeat", "_rf.fold").drop("_rf")


def overlap_check(df: DataFrame, id_col: str, split_col: str = "split") -> DataFrame:
    """Ids present in more than one split (must be 0), in one aggregation."""
    g = df.groupBy(col(id_col)).agg(F.min(col(split_col)).alias("_a"), F.max(col(split_col)).alias("_b"))
    return g.agg(F.count(F.lit(1)).cast("bigint").alias("n_ids"),
                 F.count_if(F.col("_a") != F.col("_b")).cast("bigint").alias("n_overlap"))


def ordered_cut(df: DataFrame, order_col: str, head_frac: float) -> DataFrame:
    """Label the first ``head_frac`` of rows by ``order_col`` as head, the rest
    tail (a positional cut without a global sort: the cut point is the
    interpolated quantile of the ordering column)."""
    from terrace.operators.quantile import column_quantiles
    cut = column_quantiles(df, [order_col], [head_frac])[order_col][0]
    return df.withColumn("part", F.when(col(order_col) <= F.lit(cut), F.lit("head"))
                         .otherwise(F.lit("tail")))
