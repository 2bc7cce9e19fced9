"""Registry of named queries: each key maps to a Spark callable
``(spark, sf_dir) -> DataFrame`` and, where the result is expressible in
SQL, an independent DuckDB oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Jobs of the published size that take hours on one machine: callable by name
#: like a query, but not part of the registered set (see the README).
FULL_SIZE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def full_size(key: str):
    def deco(fn):
        FULL_SIZE[key] = fn
        return fn
    return deco


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their ``@register`` calls run."""
    from terrace.plans import (q_clean, q_features, q_io, q_model, q_profile,  # noqa: F401
                               q_score, q_split)
