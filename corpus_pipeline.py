"""A corpus pipeline over ``documents``: each stage is one operator of ``silverlode.llm``, and its decisions take effect.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import minhash, mixing, perplexity, pii
from silverlode.llm.common import ship, stored, table
from silverlode.llm.queries import bpe_digest


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeping_columns(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable:
    """A stage whose result has the columns it was given; further ones go by under names that no operator uses."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        aside = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])

    return run


@keeping_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return perplexity.rules(docs).where("quality.kept")


@keeping_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least id. Rows without id stay."""
    return minhash.deduplicated(docs)


@keeping_columns
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` counted anew."""
    return pii.redacted(pii.find(docs), docs.columns)


@keeping_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last time in part; ``n_chars`` counted anew."""
    return mixing.mixed_texts(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: number and digest of the ids, and the digest of what these decode to."""
    ship(spark)
    return bpe_digest(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

# Stages of statistics, graphs and models cannot be put in SQL; tests hold each stage against plain Python on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
