"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Hashable
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the folder that all executors share: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def spark_partitions(df: DataFrame, bytes_: int, per_partition: int = 16 << 20) -> int:
    """Partitions for a shuffle of so many bytes: the session's number, or more where those would grow too large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_ // per_partition))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every row of ``nodes`` (node).

    Labels fall to the least one among the neighbours, then jump to their own label's label, until
    nothing changes; each round is written down. Only nodes that have edges take part in the rounds.
    """
    both = stored(
        reduce(DataFrame.unionAll, [edges.select("a", "b"), edges.select(F.col("b"), F.col("a"))])
        .where("a <> b")
        .distinct(),
        "edges",
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("jumped"))
        moved = stored(
            lower.join(jump, "low").select(
                "node", F.least("low", "jumped").alias("label"), (F.least("low", "jumped") < F.col("label")).alias("moved")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            break
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("component"))


_KEPT: dict[str, dict] = {}


def kept[V](operator: str, key: Hashable = None, build: Callable[[], V] = lambda: None) -> V:
    """In a Python worker: what ``operator`` has built under ``key``, for its later tasks there.

    A worker goes from stage to stage, so what other operators have kept in it is let go first.
    """
    others = _KEPT.keys() - {operator}
    for other in others:
        del _KEPT[other]
    if others:
        give_back()
    own = _KEPT.setdefault(operator, {})
    if key not in own:
        own[key] = build()
    return own[key]


def give_back() -> None:
    """In a Python worker: memory that a task has let go returns to the system, as idle workers count beside busy ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application, for sessions started without ``--py-files``."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        _SHIPPED[app] = shutil.make_archive(f"{tempfile.mkdtemp()}/silverlode", "zip", root, "silverlode")
        spark.sparkContext.addPyFile(_SHIPPED[app])
