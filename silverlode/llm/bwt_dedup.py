"""Exact substring dedup: 50-byte strings shared with earlier documents, by backward extension on Burrows-Wheeler transforms."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import stored
from silverlode.session import scratch_path

LENGTH = 50
# A window is filed under the least hash of its byte strings of this length.
ANCHOR = 24
BLOCK_BYTES = 4 << 20
BLOCKS_PER_BUCKET = 1
LEAST_BLOCKS = 16
# Windows of one segment at most: their verdicts fit a 32-bit mask.
SEGMENT = 32
TRANSFORM_BYTES = 1 << 19
PIECE = 1 << 14

_SPAN = LENGTH - ANCHOR + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """For each window of 50 bytes, the least hash of the 24-byte strings in it: a function of the window alone."""
    out = np.empty(len(data) - LENGTH + 1, np.uint64)
    for begin in range(0, len(out), PIECE):  # pieces that stay in the processor's cache
        part = out[begin : begin + PIECE]
        word = data[begin : begin + len(part) + LENGTH - 1].astype(np.uint64)
        for step in (1, 2, 4):
            word = word[:-step] | (word[step:] << np.uint64(8 * step))
        h = word[:-16] * np.uint64(0x9E3779B97F4A7C15)
        h += word[8:-8] * np.uint64(0xC2B2AE3D27D4EB4F)
        h += word[16:] * np.uint64(0x9FB21C651E98DF25)
        h = _mix(h ^ (h >> np.uint64(31)))
        for step in (1, 2, 4, 8):
            h = np.minimum(h[:-step], h[step:])
        np.minimum(h[: -(_SPAN - 16)], h[_SPAN - 16 :], out=part)
    return out


class Block:
    """Documents of one block in order of id, cut into segments: runs of windows with the same least hash."""

    def __init__(self, docs: list[dict]) -> None:
        docs = sorted((d for d in docs if d["doc_id"] is not None), key=lambda d: d["doc_id"])
        self.ids = [d["doc_id"] for d in docs]
        self.texts = [(d["text"] or "").encode("utf-8", "surrogatepass") for d in docs]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.data = b"".join(self.texts)
        self.first = np.append(0, sizes.cumsum())
        empty = np.empty(0, np.int64)
        self.start, self.stop, self.doc, self.anchor = empty, empty, empty, empty.astype(np.uint64)
        if len(self.data) >= LENGTH:
            hashes = _window_hashes(np.frombuffer(self.data, np.uint8))
            valid = np.ones(len(hashes) + 1, bool)  # windows that do not reach into the next document
            valid[-1] = False
            for begin, end in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
                valid[max(begin, end - LENGTH + 1) : end] = False
            new = valid[:-1].copy()
            new[1:] &= (hashes[1:] != hashes[:-1]) | ~valid[:-2]
            begin = np.flatnonzero(new)
            # A run ends where the next begins or, at a document's end, with its last window.
            last = np.flatnonzero(valid[:-1] & ~valid[1:]) + 1
            if len(begin):
                end = np.minimum(np.append(begin[1:], len(hashes)), last[np.searchsorted(last, begin, "right")])
                pieces = -(-(end - begin) // SEGMENT)
                number = np.arange(pieces.sum()) - np.repeat(pieces.cumsum() - pieces, pieces)
                self.start = np.repeat(begin, pieces) + number * SEGMENT
                self.stop = np.minimum(self.start + SEGMENT, np.repeat(end, pieces))
                self.doc = np.searchsorted(self.first, self.start, "right") - 1
                # Least hashes are low ones: mixed again, they fill the ranges evenly.
                self.anchor = _mix(hashes[self.start] * np.uint64(0x9E3779B97F4A7C15))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The different anchors in order, and which of them two documents here have."""
        order = np.lexsort((self.doc, self.anchor))
        anchors, doc = self.anchor[order], self.doc[order]
        distinct, begin = np.unique(anchors, return_index=True)
        ends = np.append(begin[1:], len(anchors))
        return distinct, (doc[begin] != doc[ends - 1]) if len(distinct) else np.empty(0, bool)

    def shared_segments(self, known: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different segments under the anchors ``known``, by anchor: bytes, anchor, first document; and which one each place holds."""
        at = np.flatnonzero(np.isin(self.anchor, known))
        number: dict[bytes, int] = {}
        place = np.array(
            [
                number.setdefault(self.data[s:e], len(number))
                for s, e in zip(self.start[at].tolist(), (self.stop[at] + LENGTH - 1).tolist(), strict=True)
            ],
            np.int64,
        )
        segments = list(number)
        anchor, doc = np.zeros(len(segments), np.uint64), np.full(len(segments), len(self.ids))
        anchor[place] = self.anchor[at]
        np.minimum.at(doc, place, self.doc[at])
        order = np.argsort(anchor, kind="stable")
        renamed = np.empty(len(order), np.int64)
        renamed[order] = np.arange(len(order))
        return [segments[i] for i in order], anchor[order], doc[order], at, renamed[place]


def _suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least: prefix doubling from seven symbols in one number."""
    n = len(symbols)
    padded = np.append(symbols, np.zeros(7, np.int64))
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | padded[i : i + n]
    length = 7
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        step = np.append(1, (np.diff(key[order]) != 0).astype(np.int64))
        rank[order] = step.cumsum()
        if length >= depth or rank[order[-1]] == n:
            return order
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - length)] = rank[length:]
        key = rank * (n + 1) + ahead
        length *= 2


def window_minima(segments: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each window of 50 bytes of each segment, the least document among the segments that hold it.

    Breadth first from the interval of all suffixes, each round extends the strings of all intervals by one byte to the
    left, through the transform: the members of an interval with the same byte before them are the interval of the longer
    string. Intervals whose members belong to one document are done. After 50 rounds those left are the strings of 50 bytes
    that several documents share.
    """
    sizes = np.array([len(s) for s in segments])
    symbols = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + 1
    ends = (sizes + 1).cumsum()
    symbols[ends - 1] = 0  # between segments; no byte has this symbol
    owner = np.repeat(docs, sizes + 1)
    least = owner.copy()
    order = _suffixes(symbols, LENGTH + 1).astype(np.int32)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    before = symbols[order - 1].astype(np.uint16)
    before[order == 0] = 0
    back = place[order - 1]
    rank = np.unique(docs, return_inverse=True)[1].astype(np.int32)
    holder = np.repeat(rank, sizes + 1)[order]
    rows, group = np.arange(len(order), dtype=np.int32), np.zeros(len(order), np.int32)
    for level in range(1, LENGTH + 1):
        byte = before[rows]
        turn = np.argsort(byte, kind="stable")
        turn = turn[np.searchsorted(byte[turn], 1) :]  # a separator begins no string
        rows, group, byte = back[rows[turn]], group[turn], byte[turn]
        if not len(rows):
            break
        new = np.append(True, (byte[1:] != byte[:-1]) | (group[1:] != group[:-1]))
        if level % 4 == 0 or level == LENGTH:
            begin, own = np.flatnonzero(new), holder[rows]
            lengths = np.diff(np.append(begin, len(rows)))
            on = np.repeat(np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin), lengths)
            rows, new = rows[on], new[on]
        group = new.cumsum(dtype=np.int32)
    if len(rows):
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        lows = np.minimum.reduceat(owner[order[rows]], begin)
        least[order[rows]] = np.repeat(lows, np.diff(np.append(begin, len(rows))))
    starts = ends - sizes - 1
    return [least[s : s + n - LENGTH + 1] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _verdicts(table: pa.Table) -> pa.Table:
    """For one bucket: a mask for each segment of each block, of the windows that an earlier document has than the block's first."""
    rows = table.to_pylist()
    least: dict[bytes, int] = {}
    of_anchor: dict[int, list[bytes]] = {}
    unpacked = []
    for row in rows:
        body, at = row["body"], 0
        docs = np.frombuffer(row["docs"], np.int64).tolist()
        segments = []
        for size, anchor, doc in zip(
            np.frombuffer(row["sizes"], np.uint8).tolist(), np.frombuffer(row["anchors"], np.uint64).tolist(), docs, strict=True
        ):
            segment = body[at : at + size]
            at += size
            segments.append(segment)
            known = least.get(segment)
            if known is None:
                of_anchor.setdefault(anchor, []).append(segment)
                least[segment] = doc
            elif doc < known:
                least[segment] = doc
        unpacked.append((row["block"], segments, docs))
    # A segment that is alone under its anchor shares its windows with equal segments only, and those are one by now.
    minima: dict[bytes, np.ndarray] = {}
    part: list[bytes] = []
    size = 0

    def transform() -> None:
        minima.update(zip(part, window_minima(part, np.array([least[s] for s in part])), strict=True))

    for alike in of_anchor.values():
        if len(alike) > 1:
            part += alike
            size += sum(map(len, alike))
            if size > TRANSFORM_BYTES:
                transform()
                part, size = [], 0
    if part:
        transform()
    masks = []
    for _, segments, docs in unpacked:
        mask = np.zeros(len(segments), np.uint32)
        for i, (segment, doc) in enumerate(zip(segments, docs, strict=True)):
            low = minima.get(segment)
            if low is not None:
                mask[i] = int((low < doc) @ (1 << np.arange(len(low))))
            elif least[segment] < doc:
                mask[i] = 0xFFFFFFFF
        masks.append(mask.tobytes())
    return pa.table(
        {
            "block": pa.array([b for b, _, _ in unpacked], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int64()),
            "masks": pa.array(masks, pa.binary()),
        }
    )


def _repeated(table: pa.Table) -> pa.Table:
    """For one bucket: which of each block's anchors another document has, here or in another block."""
    rows = table.to_pylist()
    hashes = [np.frombuffer(r["anchors"], np.uint64) for r in rows]
    twice = [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, hashes, strict=True)]
    _, place, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    shared = n > 1
    shared[place[np.concatenate(twice)]] = True
    bits = np.split(shared[place], np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table(
        {
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int64()),
            "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary()),
        }
    )


def _by_bucket(anchors: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Sorted anchors in slices by bucket: equal ranges of the hash."""
    edges = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(anchors, edges), [len(anchors)]]).tolist()
    for bucket, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if end > begin:
            yield bucket, slice(begin, end)


def _known(block: Block, replies: list[dict], buckets: int) -> np.ndarray:
    anchors, _ = block.anchors()
    bits = {r["bucket"]: r["bits"] for r in replies or ()}
    parts = [
        anchors[at][np.unpackbits(np.frombuffer(bits[b], np.uint8), count=at.stop - at.start).astype(bool)]
        for b, at in _by_bucket(anchors, buckets)
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _removed(block: Block, known: np.ndarray, replies: list[dict], buckets: int) -> Iterator[tuple[int, list[tuple[int, int]], bytes]]:
    """(place of the document, removed runs, kept bytes) for each document of a block."""
    _, anchor, first, at, place = block.shared_segments(known)
    verdicts = {r["bucket"]: r["masks"] for r in replies or ()}
    parts = [np.frombuffer(verdicts[b], np.uint32) for b, _ in _by_bucket(anchor, buckets)]
    masks = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    ids = np.array(block.ids, np.int64)
    # Where an earlier document of this block has the segment whole, all its windows are shared.
    mask = np.where(ids[block.doc[at]] > ids[first[place]], np.uint32(0xFFFFFFFF), masks[place]) if len(at) else masks
    cover = np.zeros(len(block.data) + 1, np.int32)
    for i in range(SEGMENT):
        hit = (block.start[at] + i < block.stop[at]) & ((mask >> np.uint32(i)) & np.uint32(1) > 0)
        begin = block.start[at][hit] + i
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + LENGTH, -1)
    gone = cover.cumsum() > 0
    for k, text in enumerate(block.texts):
        own = gone[block.first[k] : block.first[k + 1]]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
        runs = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        yield k, runs, (np.frombuffer(text, np.uint8)[~own].tobytes() if runs else text)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): for each row of ``docs`` (doc_id, text) the byte runs that earlier documents have.

    A byte goes when a string of 50 bytes over it also starts in a document with a smaller doc_id; ``removed`` has the
    maximal runs (start, end), ``kept`` the bytes left.

    1. Documents are dealt by id into blocks of about 4 MB, kept as files bucketed by block in the shared folder, so that the
       later passes join with them without moving a text again.
    2. Each window of 50 bytes is filed under the least hash of its 24-byte strings; neighbours under the same
       one make a segment. Blocks send their different anchors to hash ranges, which answer with a bit for
       each: whether two documents have it. Most text ends here.
    3. Segments under shared anchors go to the same ranges, each block's different ones once, with the first document that has it.
       Equal ones collapse; those under one anchor that differ go through Burrows-Wheeler transforms, where backward
       extension finds the windows they share (``window_minima``). The answer is a mask for each segment.
    4. Each block marks its documents' bytes.

    A group of copies, however large, sends a segment once for each block. Null and empty texts have no bytes; rows without
    doc_id lose nothing and take nothing from others; of rows that repeat a doc_id, none takes from another.
    An empty table gives no rows. Columns besides doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-total // BLOCK_BYTES))
    buckets = max(LEAST_BLOCKS, blocks // BLOCKS_PER_BUCKET)
    # Rows without an id are spread by text.
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(blocks)).alias("block")
    name = f"bwt_blocks_{uuid.uuid4().hex}"
    (
        rows.select(block, F.struct("doc_id", "text").alias("doc"))
        .repartition(blocks, "block")
        .groupBy("block")
        .agg(F.collect_list("doc").alias("docs"))
        .write.bucketBy(min(blocks, 50_000), "block")
        .option("path", scratch_path(spark, "blocks"))
        .saveAsTable(name)
    )
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay where they are; the plans that read them know their buckets

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors, twice = Block(row["docs"]).anchors()
                parts = [(b, anchors[at].tobytes(), np.packbits(twice[at]).tobytes()) for b, at in _by_bucket(anchors, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([p[0] for p in parts], pa.int64()),
                        pa.array([p[1] for p in parts], pa.binary()),
                        pa.array([p[2] for p in parts], pa.binary()),
                    ],
                    ["block", "bucket", "anchors", "twice"],
                )

    asked = held.mapInArrow(ask, "block long, bucket long, anchors binary, twice binary")
    answered = asked.groupBy("bucket").applyInArrow(_repeated, "block long, bucket long, bits binary")
    replies = stored(
        answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("replies")), "replies"
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row["docs"])
                segments, anchor, first, _, _ = own.shared_segments(_known(own, row["replies"], buckets))
                ids = np.array(own.ids, np.int64)[first] if len(first) else np.empty(0, np.int64)
                sizes = np.array([len(s) for s in segments], np.uint8)
                parts = list(_by_bucket(anchor, buckets))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([b for b, _ in parts], pa.int64()),
                        pa.array([anchor[at].tobytes() for _, at in parts], pa.binary()),
                        pa.array([ids[at].tobytes() for _, at in parts], pa.binary()),
                        pa.array([sizes[at].tobytes() for _, at in parts], pa.binary()),
                        pa.array([b"".join(segments[at]) for _, at in parts], pa.binary()),
                    ],
                    ["block", "bucket", "anchors", "docs", "sizes", "body"],
                )

    with_replies = held.join(replies, "block", "left")
    sent = with_replies.mapInArrow(send, "block long, bucket long, anchors binary, docs binary, sizes binary, body binary")
    judged = sent.groupBy("bucket").applyInArrow(_verdicts, "block long, bucket long, masks binary")
    verdicts = stored(
        judged.groupBy("block").agg(F.collect_list(F.struct("bucket", "masks")).alias("verdicts")), "verdicts"
    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row["docs"])
                found = _removed(own, _known(own, row["replies"], buckets), row["verdicts"], buckets)
                out = [(own.ids[k], len(own.texts[k]), [{"start": s, "end": e} for s, e in cut], kept) for k, cut, kept in found]
                for d in row["docs"]:
                    if d["doc_id"] is None:
                        text = (d["text"] or "").encode("utf-8", "surrogatepass")
                        out.append((None, len(text), [], text))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.int64()),
                        pa.array([o[1] for o in out], pa.int64()),
                        pa.array([o[2] for o in out], runs),
                        pa.array([o[3] for o in out], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "removed", "kept"],
                )

    marked = with_replies.join(verdicts, "block", "left")
    return marked.mapInArrow(mark, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
