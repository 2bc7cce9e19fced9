"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Rows are ordered by (vector length, label, position on the Hilbert curve through
their widest components) and cut into Parquet blocks; a block's zone map holds
its labels' range and every component's minimum and maximum.  Interval
arithmetic over a zone map bounds the inner product of an anchor with all rows
of the block from below and above.  An anchor first reads a few blocks of the
highest upper bounds; the scores found there are thresholds, and of the other
blocks it reads only those whose interval can still hold one of its first
positives, and then one of the first negatives of one of its windows
``low * positive <= high * score <= high * positive``.

Components are integers (``floor(scale * x)``).  Where sums can leave the range
in which doubles are exact, a block is scored in Python's integers instead; a
score beyond 64 bits counts as the nearest bound of that range.

Rows whose label or vector is null, or with a null id or a null or non-finite
component (before or after scaling), take no part.  Only vectors of one length are compared.  An anchor's
others are the rows of other ids.  A repeated row is a candidate of its own, and
each repeated anchor gives its own rows.  Ties go to the smaller id.  An empty
vector scores 0.  An empty table gives no rows; other input columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import positions, save
from terrace.llm.hilbert_shard import hilbert_index

#: Sums of integers below this are exact in doubles.
EXACT = float(1 << 53)
#: Components that the curve runs through, and bits of each.
CURVE_DIMS, CURVE_BITS = 8, 7
#: Blocks that an anchor reads first, of each piece of the zone table.
FIRST = 2
#: Rows of a block and anchors of a group; blocks of a piece of the zone table.
BLOCK, GROUP, PIECE = 1024, 256, 512
_LONG = np.iinfo(np.int64)


def _floor(x: Column) -> Column:
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def _curve(rows: DataFrame) -> DataFrame:
    """Adds ``hilbert``: the row's place on the curve through the components
    that vary most (by standard deviation; constants of the whole table)."""
    spread = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.stddev_pop("x").alias("wide"))
    widest = spread.orderBy(F.desc_nulls_last("wide"), "at").limit(CURVE_DIMS).collect()  # one row per component

    @F.pandas_udf("long")
    def place(*bins: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([b.to_numpy() for b in bins], CURVE_BITS))

    top = (1 << CURVE_BITS) - 1
    bins = []
    for r in widest:
        share = (F.get("v", F.lit(r["at"])) / 2 - r["low"] / 2) / max(r["high"] / 2 - r["low"] / 2, 1e-300)
        bins.append(F.coalesce(F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * (top + 1)))).cast("long"), F.lit(0).cast("long")))
    return rows.withColumn("hilbert", place(*bins) if bins else F.lit(0).cast("long"))


def _packed(rows: DataFrame, group: str) -> DataFrame:
    """One row per (dims, group): its rows in order of id as arrays of bytes, with
    the zone map."""
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending"), ("rank", "ascending")])
        n = t.num_rows
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(n, -1)
        label = t.column("label").to_numpy()
        values = [t.column("dims")[0].as_py(), t.column(group)[0].as_py(), n, t.column("id").to_numpy().tobytes(), label.tobytes(),
                  t.column("rank").to_numpy().tobytes(), np.ascontiguousarray(v).tobytes(), v.min(axis=0, initial=np.inf).tobytes(),
                  v.max(axis=0, initial=-np.inf).tobytes(), int(label.min()), int(label.max())]
        return pa.Table.from_pylist([dict(zip(["dims", group, "n", "ids", "labels", "ranks", "v", "low", "high", "label_low", "label_high"],
                                              values))])

    return rows.select("dims", group, "id", "label", "rank", "v").groupBy("dims", group).applyInArrow(
        pack, f"dims long, {group} long, n long, ids binary, labels binary, ranks binary, v binary, low binary, high binary, "
              "label_low long, label_high long")


def _matrix(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors x blocks) lower and upper bounds of the inner products, widened by
    what doubles may have lost."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        slack = 1e-12 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T)
        slack = np.where(slack < 1e-2, 0, slack)
        least, most = least - slack, most + slack
    least, most = np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)
    return np.clip(least, _LONG.min, _LONG.max), np.clip(most, _LONG.min, _LONG.max)


def scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows as 64-bit integers."""
    if 2 * max(anchors.shape[1], 1) * np.abs(anchors).max(initial=1) * np.abs(vectors).max(initial=1) < EXACT:
        return (anchors @ vectors.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (anchors, vectors)]
    return np.array([[max(_LONG.min, min(_LONG.max, sum(x * y for x, y in zip(a, b)))) for b in whole[1]] for a in whole[0]],
                    np.int64).reshape(len(anchors), len(vectors))


def _best(who: np.ndarray, what: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each ``who`` by score descending, id, place in the block."""
    order = np.lexsort((what, ids, ~score, who))
    w = who[order]
    return order[np.arange(len(w)) - np.searchsorted(w, w) < k]


def _batch(columns: list, schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


_BOUNDS = [("dims", pa.int64()), ("group", pa.int64()), ("block", pa.int64()), ("least", pa.binary()), ("most", pa.binary()),
           ("same", pa.binary()), ("other", pa.binary()), ("early_same", pa.binary()), ("early_other", pa.binary())]
_BOUNDS_SQL = ("dims long, group long, block long, least binary, most binary, same binary, other binary, early_same binary, "
               "early_other binary")


def _bounds(batches):
    """From pairs (anchor group, piece of the zone table): per anchor group and
    block the bounds of all anchors, which of them may find positives and
    negatives there (by label), and which read it first for either."""
    for b in batches:
        for r in b.to_pylist():
            a, z = _matrix(r["v"], r["n"]), r["zones"]
            low, high = (np.stack([np.frombuffer(x[c], np.float64) for x in z]) for c in ("low", "high"))
            least, most = intervals(a, low, high)
            label = np.frombuffer(r["labels"], np.int64)[:, None]
            first, last = (np.array([x[c] for x in z])[None, :] for c in ("label_low", "label_high"))
            may = {"same": (first <= label) & (label <= last), "other": (first != label) | (last != label)}
            early = {}
            for name, ok in may.items():
                rank = np.argsort(np.argsort(np.where(ok, -most, np.inf), axis=1, kind="stable"), axis=1)
                early[name] = ok & (rank < FIRST)
            columns = [[r["dims"]] * len(z), [r["group"]] * len(z), [x["block"] for x in z]]
            columns += [[m[:, i].tobytes() for i in range(len(z))] for m in (least, most, may["same"], may["other"], early["same"], early["other"])]
            yield _batch(columns, _BOUNDS)


_CHOSEN = [("dims", pa.int64()), ("group", pa.int64()), ("block", pa.int64()), ("pick", pa.binary())]
_CHOSEN_SQL = "dims long, group long, block long, pick binary"


def _choose(late: bool):
    """From bounds with the group's windows (slot, low, high): the blocks that
    must be read, with the windows that must read them."""
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                slot, low, high = (np.frombuffer(r[c], np.int64) for c in ("w_slot", "w_low", "w_high"))
                least, most = (np.frombuffer(r[c], np.float64)[slot] for c in ("least", "most"))
                may, early = (np.frombuffer(r[c], bool)[slot] for c in ("may", "early"))
                must = (most >= low) & (least <= high) & (may & ~early if late else early)
                if must.any():
                    out.append((r["dims"], r["group"], r["block"], np.flatnonzero(must).astype(np.int64).tobytes()))
            if out:
                yield _batch([list(c) for c in zip(*out)], _CHOSEN)
    return run


_FOUND = [("dims", pa.int64()), ("group", pa.int64()), ("window", pa.int64()), ("id", pa.int64()), ("rank", pa.int64()), ("score", pa.int64())]
_FOUND_SQL = "dims long, group long, window long, id long, rank long, score long"


def _read(k: int, same: bool):
    """From (anchor group, its windows, block, which windows): the first ``k`` rows
    of the block in every such window, of the anchor's label or of others."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, labels, ranks = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels", "ranks"))
                a_ids, a_labels = (np.frombuffer(r[c], np.int64) for c in ("a_ids", "a_labels"))
                pick = np.frombuffer(r["pick"], np.int64)
                window, slot, low, high = (np.frombuffer(r[c], np.int64)[pick] for c in ("w_window", "w_slot", "w_low", "w_high"))
                which, of = np.unique(slot, return_inverse=True)
                s = scores(_matrix(r["a_v"], len(a_ids))[which], _matrix(r["v"], r["n"]))
                fits = (labels[None, :] == a_labels[which][:, None]) == same
                fits &= ids[None, :] != a_ids[which][:, None]
                for at in range(0, len(pick), 256):  # bounds the matrices of a step
                    rows = of[at:at + 256]
                    line = s[rows]
                    who, what = np.nonzero(fits[rows] & (line >= low[at:at + 256, None]) & (line <= high[at:at + 256, None]))
                    score = line[who, what]
                    top = _best(who, what, score, ids[what], k)
                    if len(top):
                        where = what[top]
                        yield _batch([[r["dims"]] * len(top), [r["group"]] * len(top), window[at + who[top]], ids[where], ranks[where],
                                      score[top]], _FOUND)
    return run


_WINDOWS_SQL = "dims long, group long, w_window binary, w_slot binary, w_low binary, w_high binary"


def _windows(rows: DataFrame) -> DataFrame:
    """One row per anchor group from its windows (dims, group, window, slot, low,
    high): at most GROUP times the number of positives."""
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("window")
        values = [t.column("dims")[0].as_py(), t.column("group")[0].as_py(), *(t.column(c).to_numpy().tobytes() for c in ("window", "slot", "low", "high"))]
        return pa.Table.from_pylist([dict(zip(["dims", "group", "w_window", "w_slot", "w_low", "w_high"], values))])

    return rows.select("dims", "group", "window", "slot", "low", "high").groupBy("dims", "group").applyInArrow(pack, _WINDOWS_SQL)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for each row where ``is_anchor`` holds and each of its first
    ``positives`` others of the same label, the first ``negatives`` rows of
    other labels with ``low * positive <= high * score <= high * positive``.
    ``label`` is an integer expression."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.col(vector).isNotNull() & F.col(key).isNotNull() & label.isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        F.size(vector).cast("long").alias("dims"), F.transform(values, lambda x: _floor(x * scale)).alias("v"))
    ranked, _ = positions(_curve(save(rows, "zones-rows")), ["dims", "label", "hilbert", "id"], "zones-order")
    ranked = save(ranked.withColumnRenamed("_rank", "rank").withColumn("block", F.expr(f"rank div {BLOCK}")), "zones-ranked")
    blocks = save(_packed(ranked, "block"), "zones-blocks")
    asked, _ = positions(ranked.where("asks").drop("hilbert"), ["dims", "rank"], "zones-asked")
    grouped = asked.withColumn("group", F.expr(f"_rank div {GROUP}"))
    groups = save(_packed(grouped, "group").drop("low", "high", "label_low", "label_high"), "zones-anchors")

    # every anchor group meets every piece of the zone table once
    zones = blocks.select("dims", "block", F.expr(f"block div {PIECE}").alias("piece"), "low", "high", "label_low", "label_high")
    pieces = zones.groupBy("dims", "piece").agg(F.collect_list(F.struct("block", "low", "high", "label_low", "label_high")).alias("zones"))
    spans = pieces.groupBy("dims").agg(F.min("piece").alias("p0"), F.max("piece").alias("p1")).join(
        groups.groupBy("dims").agg(F.min("group").alias("g0"), F.max("group").alias("g1")), "dims")
    ours = groups.join(spans, "dims").select("dims", "group", F.explode(F.sequence("p0", "p1")).alias("piece"), "n", "labels", "v")
    theirs = pieces.join(spans, "dims").select("dims", F.explode(F.sequence("g0", "g1")).alias("group"), "piece", "zones")
    bounds = save(ours.join(theirs, ["dims", "group", "piece"]).mapInArrow(_bounds, _BOUNDS_SQL), "zones-bounds")

    given = groups.select("dims", "group", F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("v").alias("a_v"))
    held = blocks.select("dims", "block", "n", "ids", "labels", "ranks", "v")

    def search(windows: DataFrame, k: int, same: bool, late: bool) -> DataFrame:
        side = "same" if same else "other"
        packed = _windows(windows)
        chosen = (bounds.select("dims", "group", "block", "least", "most", F.col(side).alias("may"), F.col(f"early_{side}").alias("early"))
                  .join(packed, ["dims", "group"]).mapInArrow(_choose(late), _CHOSEN_SQL))
        return chosen.join(packed, ["dims", "group"]).join(given, ["dims", "group"]).join(held, ["dims", "block"]).mapInArrow(
            _read(k, same), _FOUND_SQL)

    def first(found: DataFrame, k: int) -> DataFrame:
        place = F.expr("row_number() over (partition by dims, group, window order by score desc, id, rank)")
        return found.withColumn("place", place).where(F.col("place") <= k)

    def whole(windows: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """The first ``k`` of every window: a few blocks give thresholds, then
        the blocks that can still hold one of the first ``k``."""
        early = save(search(windows, k, same, False), f"zones-{name}-early")
        bar = first(early, k).where(F.col("place") == k).select("dims", "group", "window", F.col("score").alias("bar"))
        raised = windows.join(bar, ["dims", "group", "window"], "left").withColumn("low", F.greatest("low", "bar"))
        late = search(raised, k, same, True)
        return save(first(early.unionByName(late), k), f"zones-{name}")

    slots = grouped.select("dims", "group", F.expr("row_number() over (partition by dims, group order by id, rank) - 1").cast("long").alias("slot"),
                           F.col("id").alias("anchor_id"))  # the order of _packed
    open_ = slots.select("dims", "group", F.col("slot").alias("window"), "slot", F.lit(_LONG.min).cast("long").alias("low"),
                         F.lit(_LONG.max).cast("long").alias("high"))
    near = whole(open_, positives, True, "positives").join(
        slots.withColumnRenamed("slot", "window"), ["dims", "group", "window"])
    near = near.select("dims", "group", (F.col("window") * positives + F.col("place") - 1).alias("window"), F.col("window").alias("slot"),
                       "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    least = f"cast(positive_score as decimal(38, 0)) * {low}"
    floor = F.expr(f"case when positive_score > 0 then ({least} + {high - 1}) div {high} else {least} div {high} end")  # rounded up
    near = save(near, "zones-windows")
    windows = near.select("dims", "group", "window", "slot", floor.alias("low"), F.col("positive_score").alias("high")).where("low <= high")
    found = whole(windows, negatives, False, "negatives")
    return found.join(near, ["dims", "group", "window"]).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
