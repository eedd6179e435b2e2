"""Near-duplicate vectors by randomly rotated binary codes with correction factors and confidence bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import components, kept, stored
from silverlode.llm.minhash import _in_blocks, _stars

COSINE = 0.98
# A linked pair at the threshold shares no table once in so many times.
LOST = 1e-6
# Width of the confidence bound of an estimate, in its standard deviations.
CONFIDENCE = 4.0
BLOCK = 512
SEED = 37


def plan(vectors: int, cosine: float, lost: float = LOST) -> tuple[int, int]:
    """(bits, tables): keys as long as the vectors are many, and tables so many that next to no linked pair is lost."""
    bits = min(40, max(4, math.ceil(math.log2(max(vectors, 2)))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(lost) / math.log1p(-same))


def rotations(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Rows of random orthogonal matrices, as many as make ``bits`` rows; the first ``dim`` rows are one rotation."""
    draw = np.random.default_rng([seed, dim])
    parts = [np.linalg.qr(draw.normal(size=(dim, dim)))[0] for _ in range(-(-max(bits, dim) // dim))]
    return np.concatenate(parts)[: max(bits, dim)]


def _usable(vector: list | None) -> np.ndarray | None:
    """The vector in double precision, or None where it is null, empty, zero, or holds a null or a non-finite number."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    return v if np.isfinite(v).all() and v.any() and np.isfinite(v @ v) else None


def _read(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, print, vector): the vector's bytes and their fingerprint; null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [_usable(v) for v in batch.column("embedding").to_pylist()]
            data = [None if v is None else v.tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([None if v is None else len(v) for v in vectors], pa.int32()),
                    pa.array([None if d is None else xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                    pa.array(data, pa.binary()),
                ],
                ["vec_id", "label", "dim", "print", "vector"],
            )

    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return given.mapInArrow(run, "vec_id long, label string, dim int, print binary, vector binary")


def _coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """``classes`` with the sign bits of all rotated coordinates, the correction factor of the first rotation, and table keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, np.ndarray] = {}
        for batch in batches:
            codes, factors, keys = [], [], []
            for data in batch.column("vector").to_pylist():
                v = np.frombuffer(data, np.float64)
                d = len(v)
                if d not in turned:
                    turned[d] = rotations(d, bits * tables)
                r = turned[d] @ (v / np.linalg.norm(v))
                sign = r >= 0
                codes.append(np.packbits(sign).tobytes())
                factors.append(float(np.abs(r[:d]).sum() / math.sqrt(d)))
                lots = sign[: bits * tables].reshape(tables, bits)
                keys.append((lots @ (1 << np.arange(bits, dtype=np.int64))).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(codes, pa.binary()),
                    pa.array(factors, pa.float64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                [*batch.schema.names, "code", "factor", "keys"],
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in classes.dtypes)
    return classes.mapInArrow(run, f"{schema}, code binary, factor double, keys array<long>")


def _compared(cosine: float, bits: int, tables: int):
    """For one block pair of a bucket: (a, b, 0) stars of what links, and (id, id, n) with the vectors that an id links with."""

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, block, copies, factor = (group.column(c).to_numpy()[order] for c in ("id", "block", "copies", "factor"))
        low, high, lot = (group.column(c)[0].as_py() for c in ("low", "high", "lot"))
        vectors = group.column("vector").to_pylist()
        x = np.stack([np.frombuffer(vectors[i], np.float64) for i in order])
        codes = group.column("code").to_pylist()
        signs = np.unpackbits(np.frombuffer(b"".join(codes[i] for i in order), np.uint8).reshape(len(ids), -1), axis=1)
        keys = signs[:, : bits * tables].reshape(len(ids), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
        d = x.shape[1]
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        turned = unit @ kept("rotated_codes", d, lambda: rotations(d, d)).T[:, :d] if d else unit
        # The unbiased estimate of <o, q> from o's code, and how far it may be off.
        quantised = (2.0 * signs[:, :d] - 1) / math.sqrt(d)
        off = CONFIDENCE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(d - 1, 1e-9))
        links = np.zeros(len(ids), np.int64)

        def near() -> Iterator[tuple[int, np.ndarray]]:
            for i in np.flatnonzero(block == low):
                estimate = (quantised @ turned[i]) / factor
                may = (block == high) & (estimate + off >= cosine)
                may[: i + 1] &= low != high
                may[i] = False
                at = np.flatnonzero(may)
                at = at[(x[at] @ x[i]) / (np.linalg.norm(x[at], axis=1) * np.linalg.norm(x[i])) >= cosine]
                # A pair belongs to the first table that it shares.
                at = at[(keys[at, :lot] != keys[i, :lot]).all(1)]
                if len(at):
                    links[i] += copies[at].sum()
                    links[at] += copies[i]
                    yield i, at

        stars = _stars(ids, near())
        linked = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array(np.append(stars["a"].to_numpy(), ids[linked]), pa.int64()),
                "b": pa.array(np.append(stars["b"].to_numpy(), ids[linked]), pa.int64()),
                "n": pa.array(np.append(np.zeros(len(stars), np.int64), links[linked]), pa.int64()),
            }
        )

    return run


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, embedding, label).

    1. Equal vectors of a label become one class, named by the least vec_id, with a count of its members.
    2. Vectors are turned at random; the signs of the turned coordinates are their code, and the product of a unit vector
       with its code is stored as correction factor. Slices of the signs of further rotations are keys of tables.
       Keys have as many bits as it takes to tell all vectors apart, and so many tables that a linked pair shares
       none of them once in a million times.
    3. In each bucket (a label's classes with equal key) the code of one vector and the other vector give an unbiased
       estimate of the inner product. Pairs whose upper confidence bound (four deviations) reaches ``cosine``
       are recomputed in double precision; no pair links without that.
    4. Buckets are compared in blocks. What leaves a block are counts of links, and stars of what hangs together.

    Vectors that are null, empty, zero, or hold nulls or non-finite numbers, and rows with a null label, link with nothing.
    Rows without vec_id link with nothing, have no component, and are kept. Of rows that repeat a vec_id with different vectors
    or labels, the one of least (label, fingerprint) stands for the id. Vectors of different lengths are not compared. An empty table
    gives no rows. Columns besides the three are not looked at.
    """
    read = stored(_read(rows), "vectors")
    usable = read.where("vec_id IS NOT NULL AND label IS NOT NULL AND print IS NOT NULL")
    grouped = usable.groupBy("label", "dim", "print").agg(
        F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("copies")
    )
    chosen = grouped.groupBy("id").agg(F.min(F.struct("label", "dim", "print", "copies")).alias("c")).select("id", "c.*")
    vectors = usable.select(F.col("vec_id").alias("id"), "label", "dim", "print", "vector").dropDuplicates(["id", "label", "print"])
    bits, tables = plan(usable.count(), cosine)
    coded = stored(
        _coded(vectors.join(chosen, ["id", "label", "dim", "print"]).drop("print"), bits, tables), "codes"
    )
    keyed = coded.select("id", "label", "dim", F.posexplode("keys").alias("lot", "key")).select(
        "id", "lot", F.xxhash64("label", "dim", "lot", "key").alias("bucket")
    )
    shared = (
        keyed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    members = _in_blocks(keyed, "bucket", shared).join(coded.select("id", "label", "dim", "copies", "vector", "code", "factor"), "id")
    found = stored(
        members.groupBy("bucket", "label", "dim", "low", "high").applyInArrow(
            _compared(cosine, bits, tables), "a long, b long, n long"
        ),
        "found",
    )
    edges = found.where("a <> b")
    counts = found.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    linked = components(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), edges)
    resolved = (
        grouped.join(counts, "id", "left")
        .join(linked, F.col("id") == F.col("node"), "left")
        .select(
            "label",
            "print",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    return (
        read.join(resolved, ["label", "print"], "left")
        .select(
            "vec_id",
            F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
