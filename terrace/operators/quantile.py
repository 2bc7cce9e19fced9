"""Exact, interpolated quantiles by selecting order statistics in ranges.

A quantile is one or two order statistics of its group.  They are found in
three declarative rounds, the same at every size and for every distribution:

1. *Coarse ranges.*  ``sign(v) * log(1 + |v|)`` on a fixed grid is a monotone
   bucket number.  One map-side combined aggregation counts the rows of each
   (group, bucket) and keeps the bucket's smallest and largest value; running
   counts over a group's buckets name those that hold a wanted rank.  A bucket
   of one value has answered already.
2. *Fine ranges.*  Rows of the remaining buckets are counted again on an even
   grid between the bucket's smallest and largest value.
3. *Values.*  The distinct values of the fine ranges that hold a wanted rank
   are counted and the running count gives the value.

No task sees more of a group than its bucket counts (round 1), one bucket's
counts (round 2) or the distinct doubles of one fine range, a relative width
of about 1e-9 (round 3); a hot group or one global median is spread like any
other.  :func:`grouped_quantiles` collects nothing; :func:`column_quantiles` and
:func:`member_quantiles` collect the few ranges of a column.  NULL and NaN values take no part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.exprs import col

#: Coarse buckets per unit of log(1 + |v|), and fine ranges per bucket.
COARSE = 1024
FINE = 65536


def _ranks(n: Column, probs: Sequence[float]) -> Column:
    """The 0-based ranks that the quantiles of ``n`` rows need."""
    at = [(n - 1) * F.lit(float(p)) for p in probs]
    return F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))


def _holding(counts: DataFrame, within: str, order: str, before: Column) -> DataFrame:
    """Keeps the ranges that hold wanted ranks, with the rows before them."""
    cum = F.expr(f"coalesce(sum(_c) over (partition by {within} order by {order} "
                 "rows between unbounded preceding and 1 preceding), 0L)")
    out = counts.withColumn("_before", before + cum)
    return out.withColumn("_wanted", F.filter(
        "_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))).where(F.size("_wanted") > 0)


def grouped_quantiles(df: DataFrame, group_cols: Sequence[str], value: str, probs: Sequence[float],
                      folds: tuple[str, int] | None = None, weight: str | None = None, pairs: bool = False) -> DataFrame:
    """(group..., q array<double>) exact quantiles of ``value`` per group, linearly
    interpolated between the order statistics at floor and ceil of (n-1)*p.

    With ``folds`` (a fold column and the number of folds) there is a row per
    group and ``held_out`` fold, over the rows of all other folds: the bucket
    counts of the folds are added up, rows are repeated in no pass but inside
    the few ranges that still hold a wanted rank."""
    names = [f"_g{i}" for i in range(len(group_cols))]
    v = col(value).cast("double")
    own = [col(folds[0]).cast("int").alias("_fold")] if folds else []
    mass = (col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")).alias("_w")
    base = df.select(*[col(g).alias(n) for g, n in zip(group_cols, names)], *own, v.alias("_v"), mass).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not names:  # one group
        names = ["_g0"]
        base = base.withColumn("_g0", F.lit(0))
    keys = names
    if folds:
        names = [*keys, "_held"]
    group = ", ".join(names)
    base = base.withColumn("_b", F.floor(F.signum("_v") * F.log1p(F.abs("_v")) * COARSE))

    parts = [F.sum("_w").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    if folds:
        every = F.sequence(F.lit(0), F.lit(folds[1] - 1))
        coarse = base.groupBy(*keys, "_fold", "_b").agg(*parts)
        coarse = coarse.withColumn("_held", F.explode(F.filter(every, lambda f: f != F.col("_fold")))).groupBy(*names, "_b").agg(
            F.sum("_c").alias("_c"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    else:
        coarse = base.groupBy(*names, "_b").agg(*parts)
    coarse = coarse.withColumn("_n", F.expr(f"sum(_c) over (partition by {group})"))
    coarse = _holding(coarse.withColumn("_ranks", _ranks(F.col("_n"), probs)), group, "_b", F.lit(0))
    open1 = coarse.where("_lo < _hi").select(
        *[F.col(n).alias(f"{n}_") for n in names], F.col("_b").alias("_b_"), F.col("_lo").alias("_from"), F.col("_hi").alias("_to"),
        F.col("_before").alias("_base"), "_n", F.col("_wanted").alias("_ranks"))

    def same(extra: Column) -> Column:
        for n in keys:
            extra = F.col(n).eqNullSafe(F.col(f"{n}_")) & extra
        return extra & (F.col("_fold") != F.col("_held_")) if folds else extra

    def held(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_held", F.col("_held_")) if folds else rows

    step = F.floor((F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * FINE)
    rows = held(base.join(open1, same(F.col("_b") == F.col("_b_")))).withColumn("_f", F.least(step, F.lit(FINE - 1)))
    fine = rows.groupBy(*names, "_b", "_f", "_base", "_n", "_ranks").agg(*parts)
    fine = _holding(fine, f"{group}, _b", "_f", F.col("_base"))
    open2 = fine.where("_lo < _hi").select(
        *[F.col(n).alias(f"{n}_") for n in names], F.col("_b").alias("_b_"), F.col("_lo").alias("_from"), F.col("_hi").alias("_to"),
        F.col("_before").alias("_base"), "_n", F.col("_wanted").alias("_ranks"))
    rows = held(base.join(open2, same((F.col("_b") == F.col("_b_")) & F.col("_v").between(F.col("_from"), F.col("_to")))))
    last = rows.groupBy(*names, "_b", "_v", "_base", "_n", "_ranks").agg(F.sum("_w").alias("_c"))
    last = _holding(last, f"{group}, _b, _base", "_v", F.col("_base"))

    found = [x.select(*names, "_n", F.explode("_wanted").alias("_r"), F.col(y).alias("_x"))
             for x, y in ((coarse.where("_lo = _hi"), "_lo"), (fine.where("_lo = _hi"), "_lo"), (last, "_v"))]
    stats = found[0].unionByName(found[1]).unionByName(found[2]).groupBy(*names, "_n").agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))  # 2 * len(probs) entries at most

    def quantile(p: float) -> Column:
        at = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        a, b = F.col("_at")[low.cast("long")], F.col("_at")[high.cast("long")]
        if pairs:
            return F.struct(a.alias("low"), b.alias("high"), (at - low).alias("share"))
        return F.when((low == high) | (a == b), a).otherwise((high - at) * a + (at - low) * b)

    return stats.select(*[F.col(n).alias(g) for n, g in zip(keys, group_cols)],
                        *([F.col("_held").alias("held_out")] if folds else []),
                        F.array(*[quantile(p) for p in probs]).alias("q"))


def column_quantiles(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float]) -> dict[str, list[float] | None]:
    """Exact quantiles of several columns, in the rounds of :func:`grouped_quantiles`
    with the column as group.  The ranges that hold a wanted rank are few (two
    per column and quantile at most) and go to the driver, so the later rounds
    read only the columns that are still open and compare before they unpivot:
    no value outside an open range becomes a row or is shuffled."""
    cols = list(cols)
    if not cols:
        return {}
    spark, xs = df.sparkSession, [col(c).cast("double") for c in cols]
    parts = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    found: list[dict] = [{} for _ in cols]  # rank -> value
    total: dict[int, int] = {}

    def settle(rows, at) -> list[tuple]:
        """Answers from ranges of one value; the others stay open."""
        left = []
        for r in rows:
            if r["_lo"] == r["_hi"]:
                found[at(r)].update(dict.fromkeys(r["_wanted"], r["_lo"]))
            else:
                left.append((at(r), r["_lo"], r["_hi"], r["_before"], r["_wanted"]))
        return left

    def narrowed(ranges: list[tuple], key) -> list:
        if not ranges:
            return []
        cells = [F.when(xs[i].between(lo, hi), F.struct(F.lit(k).alias("_k"), key(xs[i], lo, hi).alias("_f"), xs[i].alias("_v")))
                 for k, (i, lo, hi, _, _) in enumerate(ranges)]
        rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("s")).select("s.*")
        state = spark.createDataFrame([(k, r[3], r[4]) for k, r in enumerate(ranges)], "_k int, _base bigint, _ranks array<bigint>")
        counts = rows.groupBy("_k", "_f").agg(*parts).join(F.broadcast(state), "_k")
        held = _holding(counts, "_k", "_f", F.col("_base"))
        return held.select("_k", "_lo", "_hi", "_before", "_wanted").collect()

    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_k"), x.alias("_v")) for i, x in enumerate(xs)])).alias("s")).select("s.*")
    bucket = F.floor(F.signum("_v") * F.log1p(F.abs("_v")) * COARSE).alias("_f")
    coarse = long.where(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy("_k", bucket).agg(*parts)
    coarse = coarse.withColumn("_n", F.expr("sum(_c) over (partition by _k)"))
    coarse = _holding(coarse.withColumn("_ranks", _ranks(F.col("_n"), probs)), "_k", "_f", F.lit(0)).select(
        "_k", "_n", "_lo", "_hi", "_before", "_wanted").collect()
    total.update((r["_k"], r["_n"]) for r in coarse)
    ranges = settle(coarse, lambda r: r["_k"])
    fine = narrowed(ranges, lambda v, lo, hi: F.least(F.floor((v - lo) / (hi - lo) * FINE), F.lit(FINE - 1)))
    ranges = settle(fine, lambda r, of=tuple(ranges): of[r["_k"]][0])
    settle(narrowed(ranges, lambda v, lo, hi: v), lambda r, of=tuple(ranges): of[r["_k"]][0])

    def quantile(i: int, p: float) -> float:
        at = (total[i] - 1) * float(p)
        low, high = math.floor(at), math.ceil(at)
        a, b = found[i][low], found[i][high]
        return a if low == high or a == b else (high - at) * a + (at - low) * b

    return {c: [quantile(i, p) for p in probs] if i in total else None for i, c in enumerate(cols)}


def member_quantiles(counts: DataFrame, key: str, value: str, members: int, probs: Sequence[float], pairs: bool = False) -> dict:
    """{(key, member): exact quantiles} of rows (key, value, ``_all``), where
    ``_all`` holds how often each of the members has the value, in the rounds of
    :func:`grouped_quantiles` (``pairs`` as there).  A value is one row for all
    members until its range is counted.  The ranges that hold a wanted rank (two
    per key, member and quantile at most) go to the driver; no value is shuffled
    outside of them."""
    spark = counts.sparkSession
    base = counts.select(col(key).alias("_k"), col(value).cast("double").alias("_v"), "_all").where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    base = base.withColumn("_b", F.floor(F.signum("_v") * F.log1p(F.abs("_v")) * COARSE))
    parts = [F.array(*[F.sum(F.get("_all", F.lit(j))) for j in range(members)]).alias("_all"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    found: dict = {}  # (key, member) -> rank -> value
    total: dict = {}

    def each(ranges: DataFrame, *keep: str) -> DataFrame:
        return ranges.select(*keep, "_lo", "_hi", F.posexplode("_all").alias("_j", "_c")).where("_c > 0")

    def settle(rows, of) -> list[tuple]:
        """Answers from ranges of one value; the others stay open."""
        left = []
        for r in rows:
            k, b = of(r)
            if r["_lo"] == r["_hi"]:
                found[k, r["_j"]].update(dict.fromkeys(r["_wanted"], r["_lo"]))
            else:
                left.append(((k, b, r["_lo"], r["_hi"]), r["_j"], r["_before"], r["_wanted"]))
        return left

    def narrowed(open_: list[tuple], at: Column) -> list[tuple]:
        if not open_:
            return []
        ranges = list(dict.fromkeys(x[0] for x in open_))
        number = {x: i for i, x in enumerate(ranges)}
        table = spark.createDataFrame([(i, *x) for i, x in enumerate(ranges)], base.select(
            F.lit(0).alias("_r"), F.col("_k").alias("_k_"), F.col("_b").alias("_b_"), F.col("_v").alias("_from"), F.col("_v").alias("_to")).schema)
        state = spark.createDataFrame([(number[x], j, before, wanted) for x, j, before, wanted in open_],
                                      "_r int, _j int, _base bigint, _ranks array<bigint>")
        rows = base.join(F.broadcast(table), (F.col("_k") == F.col("_k_")) & (F.col("_b") == F.col("_b_"))
                         & F.col("_v").between(F.col("_from"), F.col("_to")))
        fine = each(rows.groupBy("_r", at.alias("_f")).agg(*parts), "_r", "_f").join(F.broadcast(state), ["_r", "_j"])
        held = _holding(fine, "_r, _j", "_f", F.col("_base")).select("_r", "_j", "_lo", "_hi", "_before", "_wanted").collect()
        return settle(held, lambda r: ranges[r["_r"]][:2])

    coarse = each(base.groupBy("_k", "_b").agg(*parts), "_k", "_b").withColumn("_n", F.expr("sum(_c) over (partition by _k, _j)"))
    coarse = _holding(coarse.withColumn("_ranks", _ranks(F.col("_n"), probs)), "_k, _j", "_b", F.lit(0)).select(
        "_k", "_j", "_b", "_n", "_lo", "_hi", "_before", "_wanted").collect()
    for r in coarse:
        total[r["_k"], r["_j"]] = r["_n"]
        found.setdefault((r["_k"], r["_j"]), {})
    open_ = settle(coarse, lambda r: (r["_k"], r["_b"]))
    step = F.floor((F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * FINE)
    narrowed(narrowed(open_, F.least(step, F.lit(FINE - 1))), F.col("_v"))

    def quantile(k, p: float):
        at = (total[k] - 1) * float(p)
        low, high = math.floor(at), math.ceil(at)
        a, b = found[k][low], found[k][high]
        if pairs:
            return {"low": a, "high": b, "share": at - low}
        return a if low == high or a == b else (high - at) * a + (at - low) * b

    return {k: [quantile(k, p) for p in probs] for k in total}
