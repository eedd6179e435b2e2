"""Near-duplicates by one-permutation MinHash: optimal densification, banded buckets, star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from silverlode.llm.common import components, give_back, kept, spark_partitions, stored

WORDS = 5
SIMILARITY = 75  # per cent
BINS = 128
BANDS = 32
SEED = 29
# Members of a bucket are compared in blocks of about so many.
BLOCK = 1024
BLOCK_BYTES = 8 << 20
# Sets that one task compares, over all pairs of blocks that it is dealt.
PAIR_BYTES = 4 << 20
# Pairs whose sketches agree less than so many standard deviations below the similarity asked for are no candidates.
DEVIATIONS = 5.0

_ROWS = BINS // BANDS
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted 64-bit hashes of a text's set of word shingles.

    Words are runs without ASCII white space, A-Z in lower case. Fewer words than a shingle has are one
    shingle; without words the set is empty.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = max(1, len(hashes) - words + 1)
    size = min(words, len(hashes))
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mix(out * _MIX + hashes[i : i + n])
    return np.unique(out)


def _donors(bins: int, seed: int) -> np.ndarray:
    """For every try, the bin that each bin would borrow from: a seeded hash of bin and try, as optimal densification has it."""
    draw = np.random.default_rng(seed)
    return draw.integers(0, bins, (32 * bins, bins))


def signature(hashes: np.ndarray, donors: np.ndarray) -> np.ndarray:
    """The least hash of each bin (a hash's leading bits); an empty bin takes that of the first filled bin among its donors."""
    tries, bins = donors.shape
    edges = np.arange(bins + 1, dtype=np.uint64) << np.uint64(64 - (bins - 1).bit_length())
    at = np.searchsorted(hashes, edges[:-1])
    filled = np.append(at[1:], len(hashes)) > at
    out = hashes[np.minimum(at, len(hashes) - 1)]
    if not filled.all():
        first = np.arange(bins)
        empty = np.flatnonzero(~filled)
        for lot in donors:
            hit = filled[lot[empty]]
            first[empty[hit]] = lot[empty[hit]]
            empty = empty[~hit]
            if not len(empty):
                break
        first[empty] = np.flatnonzero(filled)[0]
        out = out[first]
    return out


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_print, n_shingles, print, bands, sketch): a hash of the text, size and 128-bit fingerprint of its set, a hash
    for each band, a byte for each bin."""
    donors = _donors(BINS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("minhash")
        for batch in batches:
            sizes, prints, bands, sketches = [], [], [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), words)
                sizes.append(len(hashes))
                prints.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                if len(hashes):
                    rows = signature(hashes, donors).reshape(BANDS, _ROWS)
                    value = np.arange(BANDS, dtype=np.uint64)
                    for i in range(_ROWS):
                        value = _mix(value * _MIX + rows[:, i])
                    bands.append(value.view(np.int64))
                    sketches.append((_mix(rows) & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_print"),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "text_print", "n_shingles", "print", "bands", "sketch"],
            )
        give_back()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_print"))
    return given.mapInArrow(
        run, "doc_id long, text_print long, n_shingles long, print binary, bands array<long>, sketch binary"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("minhash")
        for batch in batches:
            sets = [shingles(t.as_py(), words) for t in batch.column("text")]
            prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(prints, pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "print", "hashes"],
            )
        give_back()

    return docs.mapInArrow(run, "doc_id long, print binary, hashes binary")


def _stars(ids: np.ndarray, rows: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
    """From the neighbours of each place: for every group that hangs together, an edge from its least id to each other."""
    label = np.arange(len(ids))  # ids are in order, so a group's least place is its least id's
    for i, near in rows:
        joined = np.unique(label[np.append(near, i)])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    at = np.flatnonzero(label != np.arange(len(ids)))
    return pa.table({"a": pa.array(ids[label[at]], pa.int64()), "b": pa.array(ids[at], pa.int64())})


def _block_pair(table: pa.Table, *columns: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Ids in order, which of them compare with the others, which are compared with, and their further columns."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    block = table.column("block").to_numpy()[order]
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    more = [[column[i] for i in order] for column in (table.column(c).to_pylist() for c in columns)]
    return ids[order], block == low, block == high, more


def _candidates(percent: int):
    """Stars of the members of one block pair of a bucket whose sizes and sketches allow the similarity asked for."""

    def run(table: pa.Table) -> pa.Table:
        ids, ours, theirs, (sizes, sketches) = _block_pair(table, "n", "sketch")
        n, p = np.array(sizes), percent / 100
        bins = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, BINS)

        def near() -> Iterator[tuple[int, np.ndarray]]:
            for i in np.flatnonzero(ours):
                least, most = np.minimum(n, n[i]), np.maximum(n, n[i])
                floor = p - DEVIATIONS * np.sqrt(p * (1 - p) / np.clip(most / 2, 1, BINS))
                like = theirs & (least * 100 >= most * percent) & ((bins == bins[i]).mean(1) >= floor)
                like[i] = False
                if like.any():
                    yield i, np.flatnonzero(like)

        return _stars(ids, near())

    return run


def _links(percent: int):
    """Stars of the members of one block pair of a family whose full sets are as alike as asked for."""

    def run(table: pa.Table) -> pa.Table:
        ids, ours, theirs, (sets,) = _block_pair(table, "hashes")
        sizes = np.array([len(s) // 8 for s in sets])
        hashes, owner = np.unique(np.frombuffer(b"".join(sets), np.int64), return_inverse=True)
        member = np.repeat(np.arange(len(ids)), sizes)
        by_hash = member[np.argsort(owner, kind="stable")]
        start = np.searchsorted(np.sort(owner), np.arange(len(hashes) + 1))
        first = np.append(0, sizes.cumsum())

        def near() -> Iterator[tuple[int, np.ndarray]]:
            for i in np.flatnonzero(ours):
                own = owner[first[i] : first[i + 1]]
                length = start[own + 1] - start[own]
                skip = np.repeat(start[own] - (length.cumsum() - length), length)
                both = np.bincount(by_hash[skip + np.arange(length.sum())], minlength=len(ids))
                like = theirs & (both * 100 >= (sizes + sizes[i] - both) * percent)
                like[i] = False
                if like.any():
                    yield i, np.flatnonzero(like)

        return _stars(ids, near())

    return run


def _in_blocks(rows: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """``rows`` once for each pair of blocks of its group that it takes part in; ``blocks`` has (group, blocks)."""
    return (
        rows.join(blocks, group)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("blocks", "other")
    )


def _pairs(sets: DataFrame, size: DataFrame) -> GroupedData:
    """Members of families by pairs of blocks. The pairs are dealt out, not the families, to as many tasks as their sets are worth."""
    sent = size.agg(F.sum(F.col("bytes") * F.col("blocks"))).first()[0] or 0
    rows = _in_blocks(sets, "family", size.select("family", "blocks"))
    tasks = spark_partitions(sets, sent, PAIR_BYTES)
    return rows.repartition(tasks, "family", "low", "high").groupBy("family", "low", "high")


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    1. Each text becomes a set of word shingles and a signature: one hash of the set's members, its range cut into
       128 bins, the least of each bin, empty bins filled by optimal densification. Four bins make a band. Sets
       that are 75 % alike share none of the 32 bands once in 200,000 times.
    2. Documents with the same set become one class, named by the least doc_id, before anything else is done.
    3. The classes that share a band are a bucket. In it, sketches (a byte for each bin) tell which pairs can be alike
       at all; what hangs together by such pairs leaves as a star from its least class. Stars that
       touch, over all buckets, are a family.
    4. A family's members are compared on their full sets, and what hangs together by links leaves as a star again.

    Buckets and families are compared in blocks of bounded size, each pair of blocks in a group of its own, so that no
    task holds a hot one whole. Each gives fewer edges than it has members, never its pairs.

    Texts without words (null, empty, blank) have empty sets and link with nothing. Rows without doc_id link with
    nothing, have no component, and are kept. Rows that repeat a doc_id are each returned, with the component of their own
    text. An empty table gives no rows. Columns besides doc_id and text are not looked at. A very long text is a set like
    others, in the memory of one task.
    """
    return _marked(docs, percent, words).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: of least doc_id, and of the rows of that id that are in the
    group one of least hash of its text.

    Rows without words or without id stay, however often they repeat. Rows go by id and text, so where an id repeats with
    texts that are not alike, each has a fate of its own.
    """
    print_ = _free("text_print", docs.columns)
    marked = stored(_marked(docs, percent, words), "marked")
    heads = marked.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL")
    several = stored(
        heads.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("text_print").alias("best")).where("n > 1"), "several"
    )
    more = heads.join(several, "component")
    gone = marked.where("NOT kept").unionByName(more.where("text_print <> best").select(marked.columns))
    key = ["doc_id", print_]
    gone = gone.select("doc_id", F.col("text_print").alias(print_)).distinct()
    left = docs.withColumn(print_, F.xxhash64("text")).join(gone, key, "left_anti")
    if not several.isEmpty():
        again = more.where("text_print = best").select("doc_id", F.col("text_print").alias(print_)).distinct()
        once = left.join(again, key, "left_semi").dropDuplicates(key)
        left = left.join(again, key, "left_anti").unionByName(once)
    return left.drop(print_)


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _marked(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The rows of ``near_duplicates``, with the hash of their text and a name of their component that no other has.

    A class is a node named by its least doc_id; of several classes with the same one, those after the first, by
    fingerprint, get negative names from it.
    """
    signed = stored(_signed(docs, words), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("print").agg(F.min("doc_id").alias("id"))
    least = classes.groupBy("id").agg(F.min("print").alias("least"))
    other_name = F.xxhash64("print").bitwiseOR(F.lit(-(1 << 63)))
    classes = stored(
        classes.join(least, "id").select(
            "print", F.col("id").alias("doc_id"), F.when(F.col("print") == F.col("least"), F.col("id")).otherwise(other_name).alias("node")
        ),
        "classes",
    )
    first = usable.join(classes, ["doc_id", "print"]).dropDuplicates(["node"])

    in_band = first.select(F.col("node").alias("id"), F.explode("bands").alias("bucket"))
    shared = (
        in_band.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    # Most bands are shared with nobody: sketches go along only with rows that are.
    sketches = first.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    members = _in_blocks(in_band, "bucket", shared).join(sketches, "id")
    stars = stored(
        members.groupBy("bucket", "low", "high").applyInArrow(_candidates(percent), "a long, b long").distinct(), "stars"
    )
    active = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    families = components(active, stars).withColumnRenamed("component", "family")
    families = stored(families.join(classes, "node"), "families")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(
        _sets(texts.join(families.select("doc_id").distinct(), "doc_id", "left_semi"), words)
        .join(families, ["doc_id", "print"])
        .dropDuplicates(["node"])
        .select("family", F.col("node").alias("id"), "hashes"),
        "sets",
    )
    size = sets.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("hashes")).alias("bytes"))
    size = size.withColumn("blocks", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int"))
    links = stored(_pairs(sets, size).applyInArrow(_links(percent), "a long, b long").distinct(), "links")
    linked = components(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), links)
    linked = linked.join(classes.select("node", "doc_id"), "node")
    named = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    resolved = classes.join(linked.drop("doc_id").join(named, "component"), "node", "left").select(
        "print",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component", "node").alias("component"),
    )
    placed = signed.join(resolved, "print", "left").select(
        "doc_id",
        "text_print",
        "n_shingles",
        "component",
        F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return placed.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
