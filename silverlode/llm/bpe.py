"""Byte-level BPE by recursive SQL: merges run in a DuckDB database inside each Spark task."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverlode.llm.common import give_back, kept

# Words longer than this (in bytes) are merged with a heap: one merge a round would make their rounds quadratic.
LONG_WORD = 256
# A query holds the state of all its rounds until it ends: n (n + 1) / 2 rows at most for a word of n bytes. So many rows
# take some 50 MB, whatever the words are like.
ROWS_PER_QUERY = 1_000_000
CHARS_PER_STEP = 1 << 19
TOKENS_PER_STEP = 1 << 19
CACHED_WORDS = 150_000

# A round merges, in every word that has a pair of the merge table, its pair of least rank, the leftmost of equals
# (rank and place as one number; places run through all words). Words without such a pair add no rows to the next
# round: their last is their result. A row knows the place and token of the one that follows it in its word, or -1.
ENCODE = """
WITH RECURSIVE state AS (
    SELECT 0 AS round, word, pos, token, next, after FROM start
    UNION ALL
    SELECT s.round + 1, s.word, s.pos,
        CASE WHEN s.pos = first_pos THEN made ELSE s.token END,
        CASE WHEN s.pos = first_pos THEN m.next ELSE s.next END,
        CASE WHEN s.pos = first_pos THEN m.after WHEN s.next = first_pos THEN made ELSE s.after END
    FROM state s JOIN (
        SELECT best.word, made, first_pos, gone, q.next, q.after
        FROM (
            SELECT word, (min(ranked) >> 32)::INTEGER AS made, (min(ranked) & 4294967295)::INTEGER AS first_pos,
                arg_min(next, ranked) AS gone
            FROM (
                SELECT word, next, (id::BIGINT << 32) | pos AS ranked
                FROM state JOIN merges ON pair = (token::BIGINT << 32) | after
            )
            GROUP BY word
        ) best JOIN state q ON q.pos = gone
    ) m ON s.word = m.word
    WHERE s.pos <> gone
)
SELECT s.word, token
FROM state s JOIN (SELECT word, max(round) AS round FROM state GROUP BY word) last
    ON s.word = last.word AND s.round = last.round
ORDER BY pos
"""

DECODE = "SELECT bytes FROM tokens JOIN vocabulary USING (token) ORDER BY pos"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _database():
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})


class Encoder:
    """Encodes words by a rank table; keeps the words met last, and the merge table, in memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self._ranks = ranks
        self._split = regex.compile(pattern).findall
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._db = _database()
        pairs = array("i")  # flat, as a list of tuples would take more memory than all else here
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                first, second = ranks.get(token[:i]), ranks.get(token[i:])
                if first is not None and second is not None:
                    pairs.extend((first, second, rank))
        columns = np.frombuffer(pairs, np.int32).reshape(-1, 3).T.copy()
        self._db.register("pairs", pa.table(dict(zip(("first", "second", "id"), columns, strict=True))))
        self._db.execute("CREATE TABLE merges AS SELECT (first::BIGINT << 32) | second AS pair, id FROM pairs")
        self._db.unregister("pairs")
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        split = [self._split(t) if t else [] for t in texts]
        known, old = self._young, self._old
        missing = set().union(*split).difference(known)
        met = {w: old[w] for w in missing if w in old}
        known.update(met)
        known.update(self._encode([w for w in missing if w not in met]))
        ids = [b"".join(map(known.__getitem__, s)) for s in split]
        if len(known) > CACHED_WORDS:  # words not met since the last time go
            self._young, self._old = {}, known
        return ids

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        done, rest = {}, []
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            rank = self._ranks.get(raw)
            if rank is not None:
                done[word] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_WORD:
                done[word] = self._merge_long(raw)
            else:
                rest.append((word, raw))
        for step in _steps([len(raw) * (len(raw) + 1) // 2 for _, raw in rest], ROWS_PER_QUERY):
            done.update(self._merge(rest[step]))
        return done

    def _merge(self, words: list[tuple[str, bytes]]) -> Iterator[tuple[str, bytes]]:
        lengths = np.array([len(raw) for _, raw in words])
        ends = lengths.cumsum()
        pos = np.arange(ends[-1], dtype=np.int32)
        token = self._byte[np.frombuffer(b"".join(raw for _, raw in words), np.uint8)]
        next_, after = pos + 1, np.append(token[1:], -1).astype(np.int32)
        next_[ends - 1] = after[ends - 1] = -1
        start = {
            "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": pos,
            "token": token,
            "next": next_,
            "after": after,
        }
        self._db.register("start", pa.table(start))
        found = self._db.execute(ENCODE).fetchnumpy()
        self._db.unregister("start")
        ids = np.asarray(found["token"]).astype("<u4").tobytes()
        stops = np.searchsorted(np.asarray(found["word"]), np.arange(len(words)), "right") * 4
        begin = 0
        for (word, _), stop in zip(words, stops.tolist(), strict=True):
            yield word, ids[begin:stop]
            begin = stop

    def _merge_long(self, raw: bytes) -> bytes:
        """The same merges for one long word, in time n log n: pairs wait in a heap by rank and place."""
        ranks = self._ranks
        n = len(raw)
        end, left = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that starts here
        alive = [True] * n

        def pair(at: int) -> tuple[int, int, int] | None:
            stop = end[at]
            rank = ranks.get(raw[at : end[stop]]) if stop < n else None
            return None if rank is None else (rank, at, end[stop])

        heap = [p for p in map(pair, range(n)) if p]
        heapify(heap)
        while heap:
            _, at, stop = heappop(heap)
            middle = end[at]
            if not alive[at] or middle >= n or end[middle] != stop:
                continue
            alive[middle], end[at] = False, stop
            if stop < n:
                left[stop] = at
            for p in (pair(at), pair(left[at]) if left[at] >= 0 else None):
                if p:
                    heappush(heap, p)
        ids = [ranks[raw[i : end[i]]] for i in range(n) if alive[i]]
        return np.array(ids, "<u4").tobytes()


class Decoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._db = _database()
        tokens = pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})
        self._db.register("given", tokens)
        self._db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self._db.unregister("given")

    def texts(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids; fails on an id that is not in the vocabulary."""
        lengths = np.array([len(x) // 4 for x in ids])
        if not lengths.sum():
            return [b""] * len(ids)
        tokens = {
            "pos": np.arange(lengths.sum(), dtype=np.int32),
            "token": np.frombuffer(b"".join(ids), "<u4").astype(np.int32),
        }
        self._db.register("tokens", pa.table(tokens))
        found = self._db.sql(DECODE).to_arrow_table().column("bytes").combine_chunks()
        self._db.unregister("tokens")
        if len(found) != lengths.sum():
            raise ValueError("an id is not in the vocabulary")
        # In order, the bytes of all tokens lie end to end in the buffer of the result: a text is one slice of it.
        found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
        bounds = np.frombuffer(found.buffers()[1], np.int32)[found.offset :]
        data = memoryview(found.buffers()[2])
        cuts = bounds[np.append(0, lengths.cumsum())].tolist()
        return [bytes(data[begin:end]) for begin, end in zip(cuts[:-1], cuts[1:], strict=True)]


def _steps(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of at most so much in sum, of one item at least."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if len(sizes) > begin:
        yield slice(begin, len(sizes))


def _with_column(batch: pa.RecordBatch, name: str, values: list[bytes]) -> pa.RecordBatch:
    kept = [i for i, c in enumerate(batch.schema.names) if c != name]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(i) for i in kept], pa.array(values, pa.binary())],
        [*[batch.schema.names[i] for i in kept], name],
    )


def _schema_with(df: DataFrame, *names: str) -> T.StructType:
    return T.StructType([*[f for f in df.schema if f.name not in names], *[T.StructField(n, T.BinaryType(), False) for n in names]])


def _sent(df: DataFrame, path: str) -> Broadcast:
    """The vocabulary file's digest and ranks, sent to the executors: a file of bounded size."""
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((digest, read_ranks(path)))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids, as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded alone. A match that is a token as a whole is that token; in others
    the leftmost pair of least rank is merged until none is left. The merges of all new words of some documents
    run as one recursive query in the task; words met before are looked up. No exchange: rows are
    independent, and ``path`` is read by the driver only (a vocabulary file, of bounded size).

    Null and empty texts have no tokens; repeated rows are encoded alike; an empty table gives no rows. Other columns
    are carried, but for one named ``out``, which is replaced.
    """
    table = _sent(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table, pattern)
        for batch in batches:
            yield from _encoded(batch, encoder, text, out)

    return docs.mapInArrow(run, _schema_with(docs, out))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with a column of the bytes that its ids stand for: tokens join the vocabulary, and
    in their order the bytes add up to the texts.

    A null list of ids gives no bytes; an id outside the vocabulary fails the job.
    """
    table = _sent(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(table)
        for batch in batches:
            yield from _decoded(batch, decoder, ids, out)

    return encoded.mapInArrow(run, _schema_with(encoded, out))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task, where the two after each other would hold two."""
    table = _sent(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(table, pattern), _decoder(table)
        for batch in batches:
            for piece in _encoded(batch, encoder, text, ids):
                yield from _decoded(piece, decoder, ids, out)
            del batch, piece
            give_back()  # for each batch, as what several have let go adds up to more than one of them

    return docs.mapInArrow(run, _schema_with(docs, ids, out))


def _encoder(table: Broadcast, pattern: str) -> Encoder:
    digest, ranks = table.value
    return kept("bpe", ("encode", digest, pattern), lambda: Encoder(ranks, pattern))


def _decoder(table: Broadcast) -> Decoder:
    digest, ranks = table.value
    return kept("bpe", ("decode", digest), lambda: Decoder(ranks))


def _encoded(batch: pa.RecordBatch, encoder: Encoder, text: str, out: str) -> Iterator[pa.RecordBatch]:
    """The batch with its ids, in pieces of bounded size."""
    column = batch.column(batch.schema.get_field_index(text))
    for step in _steps(pc.fill_null(pc.utf8_length(column), 0).to_pylist(), CHARS_PER_STEP):
        yield _with_column(batch[step], out, encoder.texts(column[step].to_pylist()))


def _decoded(batch: pa.RecordBatch, decoder: Decoder, ids: str, out: str) -> Iterator[pa.RecordBatch]:
    """The batch with what its ids stand for, in pieces of bounded size."""
    column = batch.column(batch.schema.get_field_index(ids))
    for step in _steps([n // 4 for n in pc.fill_null(pc.binary_length(column), 0).to_pylist()], TOKENS_PER_STEP):
        yield _with_column(batch[step], out, decoder.texts([x or b"" for x in column[step].to_pylist()]))
