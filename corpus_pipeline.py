"""A corpus pipeline over ``documents``: language ID, exact dedup, MinHash
near-dedup, mixing sources to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
Null and empty texts are rejected by the first stage, because they have no
language; an empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import chunk_dedup, dart_minhash, ipf_mix, lang_hdc, packing
from terrace.llm.common import keep_rows, on_workers, save
from terrace.llm.queries import MIX, WORD_BPE, documents, mix_dims, remainder

#: Language ID and MinHash have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which a language is recognised: those with letters.
    A cosine falls with the number of trigrams, so no bound on it is set."""
    on_workers(spark)
    learn = F.coalesce(remainder("doc_id", 4) != 2, F.lit(True))
    told = lang_hdc.identify(docs, learn, names_as=("_told_lang", "_told_score"))
    return told.where(F.col("_told_lang") != lang_hdc.UNKNOWN).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of all documents with equal text, white space aside."""
    on_workers(spark)
    return keep_rows(docs, chunk_dedup.exact_groups(docs).where("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    on_workers(spark)
    return keep_rows(docs, dart_minhash.near_classes(docs).where("kept"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics meet the targets."""
    return ipf_mix.mixed(docs, MIX, mix_dims())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the drawn documents into windows; one row per piece."""
    on_workers(spark)
    return packing.pack(docs, WORD_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixture), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
