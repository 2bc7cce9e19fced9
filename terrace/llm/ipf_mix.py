"""Mixing sources to target weights by iterative proportional fitting.

Token weights are counted per cell of source x language x topic.  Raking then
scales the cells until all three marginals meet their targets, no cell giving
more than it has; the fitted part of a cell is the probability with which each
of its documents is drawn.

A value without a target (also null) falls into the class ``other`` of its
dimension, whose target is the share that it has; so the number of cells is
bounded by the target tables, not by the data.  A null text has no tokens.
Repeated rows with one id are drawn or left together.  An empty table gives no
rows.  Input columns other than those named are not carried by ``mix_weights``;
``mixed`` keeps the columns of its input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import token_count, unused

OTHER = "other"


def rake(tokens: np.ndarray, targets: list[np.ndarray], budget: float, rounds: int = 1000, tol: float = 1e-9) -> np.ndarray:
    """Fitted token counts: marginals in proportion to ``targets``, ``budget``
    in all, no cell above ``tokens``.  Where the bounds make that impossible,
    the last round's compromise."""
    t = tokens.astype(float)
    x = t * (budget / t.sum()) if t.sum() else t.copy()
    for _ in range(rounds):
        before = x
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(x.ndim) if a != axis)
            have = x.sum(axis=others)
            want = target * budget
            factor = np.divide(want, have, out=np.ones_like(have), where=have > 0)
            shape = [1] * x.ndim
            shape[axis] = -1
            x = np.minimum(x * factor.reshape(shape), t)
        if np.abs(x - before).max(initial=0) <= tol * max(budget, 1):
            break
    return x


def gap(x: np.ndarray, targets: list[np.ndarray]) -> float:
    """The largest distance of a marginal's share from its target."""
    return max(float(np.abs(x.sum(axis=tuple(a for a in range(x.ndim) if a != axis)) / max(x.sum(), 1e-300) - target).max())
               for axis, target in enumerate(targets))


def feasible(tokens: np.ndarray, targets: list[np.ndarray], share: float, near: float = 1e-4) -> tuple[np.ndarray, float, float]:
    """Fitted token counts, the share of all tokens they are, and their
    :func:`gap`: the largest share up to ``share`` (to a thousandth of it) at which
    every marginal meets its target.  Where no share does, the compromise at
    ``share``; its gap tells."""
    total = tokens.sum()
    whole = rake(tokens, targets, share * total)
    if total == 0 or gap(whole, targets) <= near:
        return whole, share, gap(whole, targets) if total else 0.0
    low, high, best = 0.0, share, None
    for _ in range(10):
        middle = (low + high) / 2
        x = rake(tokens, targets, middle * total)
        if gap(x, targets) <= near:
            low, best = middle, x
        else:
            high = middle
    return (whole, share, gap(whole, targets)) if best is None else (best, low, gap(best, targets))


def mix_weights(docs: DataFrame, targets: dict[str, dict[str, float]], dims: dict[str, Column], share: float = 0.5,
                seed: int = 3, text: str = "text", key: str = "doc_id", reach: bool = False) -> DataFrame:
    """doc_id, n_tokens, the classes, factor, probability and kept of each row,
    the share of all tokens drawn and the :func:`gap` of the fitted marginals.

    ``share`` is the part of all tokens to draw, ``targets`` gives weights of the
    values of each dimension in ``dims``.  Where ``share`` is too much for the
    targets, the fit is the nearest compromise and its gap tells; with ``reach``
    the largest share that meets them is taken instead (:func:`feasible`).
    """
    rows = docs.select(F.col(key).alias("doc_id"), token_count(F.col(text)).alias("n_tokens"),
                       *[_class(e, list(targets[d])).alias(d) for d, e in dims.items()])
    names = list(dims)
    cells = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")).collect()  # at most one row a cell of the targets
    values = [[*targets[d], OTHER] for d in names]
    t = np.zeros([len(v) for v in values])
    for r in cells:
        t[tuple(v.index(r[d]) for v, d in zip(values, names))] = r["tokens"]
    wanted = []
    for axis, (d, v) in enumerate(zip(names, values)):
        have = t.sum(axis=tuple(a for a in range(t.ndim) if a != axis)) / max(t.sum(), 1)
        w = np.array([targets[d].get(x, 0) for x in v[:-1]], float) * (have[:-1] > 0)
        w = w / w.sum() * (1 - have[-1]) if w.sum() else have[:-1]
        wanted.append(np.append(w, have[-1]))
    if reach:
        fitted, share, apart = feasible(t, wanted, share)
    else:
        fitted = rake(t, wanted, share * t.sum())
        apart = gap(fitted, wanted) if t.sum() else 0.0
    probability = np.divide(fitted, t, out=np.full(t.shape, float(share)), where=t > 0)
    table = [(*[v[i] for v, i in zip(values, at)], float(p)) for at, p in np.ndenumerate(probability)]
    schema = ", ".join(f"`{d}` string" for d in names) + ", probability double"
    joined = rows.join(F.broadcast(docs.sparkSession.createDataFrame(table, schema)), names, "left")
    return joined.select("doc_id", *names, "n_tokens", (F.col("probability") / share).alias("factor"),
                         "probability", (_draw(seed, "doc_id") < F.col("probability")).alias("kept"),
                         F.lit(float(share)).alias("share"), F.lit(apart).alias("gap"))


def _class(value: Column, listed: list[str]) -> Column:
    return F.when(value.isin(listed), value).otherwise(F.lit(OTHER))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]], dims: dict[str, Column], share: float = 0.5, seed: int = 3,
          text: str = "text", key: str = "doc_id") -> DataFrame:
    """The drawn rows of ``docs`` with their columns.  The draw is a function
    of the row and its cell, so the texts need no shuffle."""
    marks = mix_weights(docs, targets, dims, share, seed, text, key)
    *names, p = unused(docs, *[f"_mix_{d}" for d in dims], "_mix_p")
    table = marks.groupBy(*dims).agg(F.first("probability").alias(p)).toDF(*names, p)  # one row a cell
    marked = docs.select("*", *[_class(e, list(targets[d])).alias(n) for n, (d, e) in zip(names, dims.items())])
    return marked.join(F.broadcast(table), names).where(_draw(seed, key) < F.col(p)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _draw(seed: int, key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 53)) / float(1 << 53)
