"""Token counts of texts of any length: huge ones are encoded in overlapping chunks, joined where both sides agree."""

from __future__ import annotations

import hashlib
import os
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import kept, stored

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9
WIDER = 4
# Signs before a chunk's cut end that no seam relies on.
MARGIN = 32
CACHED_WORDS = 500_000
ROWS_PER_CALL = 64

KEYS = "array<struct<start:int,end:int,id:int>>"
CHUNK = "digest string, chunk int, begin int, last boolean, piece string"
ENCODED = f"digest string, chunk int, last boolean, n long, head {KEYS}, head_through array<int>, tail {KEYS}, tail_through array<int>"


def count(
    docs: DataFrame,
    path: str,
    keep: list[str] | None = None,
    text: str = "text",
    out: str = "n_tokens",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and the number of tokens of ``text``, as the library counts them.

    ``path`` is a BPE tokenizer file of the ``tokenizers`` library that drops white space and whose special tokens hold
    none. Their strings in a text count as one token each, the library's default; none is added.

    Texts of up to ``chunk_chars`` code points are counted in one piece, word by word: a cut at a white space sign
    changes no token, so the counts of words met before are looked up. Longer ones are encoded in chunks that
    overlap, which other tasks share, with the code points that each token spans. Two neighbouring
    chunks are joined behind the first token (same id, same span) that both have in their overlap. That is
    exact: the splitting pattern goes on from any place without looking back, and a sequence of tokens of one
    word is its encoding if each two that follow each other are the encoding of what they spell, which holds left
    of the joint by one chunk, and right of it by the other. Where an overlap has no such token (one sign repeated, as
    a rule), the texts concerned are cut again into chunks and overlaps of four times the size, and in the end one.

    Equal long texts are encoded once. Null, empty and blank texts have no tokens; repeated rows are counted alike;
    an empty table gives no rows. Other columns are carried, but for one named ``out``, which is replaced.
    """
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c != out]
    tokenizer = _sent(docs, path)
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    size = F.char_length("text")
    short = _counted(rows.where(size.isNull() | (size <= chunk_chars)), tokenizer)
    long = rows.where(size > chunk_chars).withColumn("digest", F.sha2("text", 256))
    found = long.select("row", "digest").join(_long_counts(long, tokenizer, chunk_chars, overlap_chars), "digest")
    return short.unionByName(found.select("row", "n")).select("row.*", F.col("n").alias(out))


def _sent(df: DataFrame, path: str) -> Broadcast:
    """The tokenizer file's digest and content, sent to the executors: a file of bounded size."""
    with open(path, "rb") as file:
        content = file.read()
    return df.sparkSession.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))


class Counter:
    """Counts and encodes with the library; keeps the counts of the words met last."""

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(content.decode())
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._young: dict[bytes, int] = {}
        self._old: dict[bytes, int] = {}

    def encode(self, texts: list[str]) -> list:
        return self._tokenizer.encode_batch(texts, add_special_tokens=False)

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [(t or "").encode().split() for t in texts]
        known, old = self._young, self._old
        missing = list(set().union(*split).difference(known))
        known.update((w, old[w]) for w in missing if w in old)
        missing = [w for w in missing if w not in known]
        for i in range(0, len(missing), 10_000):
            some = missing[i : i + 10_000]
            encoded = self._tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            known.update(zip(some, map(len, encoded), strict=True))
        counts = [sum(map(known.__getitem__, words)) for words in split]
        if len(known) > CACHED_WORDS:  # words not met since the last time go
            self._young, self._old = {}, known
        return counts


def _counter(tokenizer: Broadcast) -> Counter:
    digest, content = tokenizer.value
    return kept("token_counts", digest, lambda: Counter(content))


def _counted(rows: DataFrame, tokenizer: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_PER_CALL):
                piece = batch.slice(begin, ROWS_PER_CALL)
                counts = counter.counts(piece.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts, pa.int64())], ["row", "n"])

    return rows.select("row", "text").mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("n", T.LongType())]))


def _long_counts(long: DataFrame, tokenizer: Broadcast, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """Digest and number of tokens of every different text."""
    done = []
    open_ = long.select("digest", "text")
    while True:
        chunks = open_.mapInArrow(_chunks(chunk_chars, overlap_chars), CHUNK)
        # Copies go, and the chunks of one text spread over all tasks.
        chunks = chunks.dropDuplicates(["digest", "chunk"])
        encoded = stored(chunks.mapInArrow(_encoded(tokenizer, overlap_chars), ENCODED), "encoded_chunks")
        texts = stored(_joined(encoded), "long_counts")
        done.append(texts.where("found").select("digest", "n"))
        failed = texts.where("not found").select("digest")
        if failed.isEmpty():
            return reduce(DataFrame.unionAll, done)
        open_ = long.select("digest", "text").join(failed, "digest", "left_semi")
        chunk_chars, overlap_chars = WIDER * chunk_chars, WIDER * overlap_chars


def _joined(encoded: DataFrame) -> DataFrame:
    """Per text whether all seams hold, and its number of tokens then: chunks from one seam to the next, added up."""
    right = encoded.select(
        "digest", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("right"), F.col("head_through").alias("right_through")
    )
    common = F.try_element_at(F.array_intersect("tail", "right"), F.lit(1))
    seam = encoded.join(right, ["digest", "chunk"], "left").withColumn("common", common)

    def through(keys: str, counts: str) -> F.Column:
        return F.try_element_at(counts, F.array_position(keys, F.col("common")).cast("int"))

    # Tokens of a chunk up to its seam, without those of the next chunk that lie before the seam.
    own = F.when(F.col("last"), F.col("n")).when(
        F.col("common").isNotNull(), through("tail", "tail_through") - through("right", "right_through")
    )
    return (
        seam.select("digest", own.alias("own"))
        .groupBy("digest")
        .agg(F.bool_and(F.col("own").isNotNull()).alias("found"), F.sum("own").alias("n"))
    )


def _joins_the_sign_before(sign: str) -> bool:
    """Whether normalisation may join a sign with what stands before it: marks, and vowels and ends of Hangul syllables."""
    return unicodedata.category(sign)[0] == "M" or "ᅠ" <= sign <= "ᇿ" or "ힰ" <= sign <= "퟿"


def cuts(text: str, chunk_chars: int) -> list[int]:
    """Places about ``chunk_chars`` apart, the first at the start, where normalisation can be cut."""
    found, at, n = [0], 0, len(text)
    while (at := max(at, found[-1] + chunk_chars)) < n:
        at = _safe(text, at)
        if at < n:
            found.append(at)
    return found


def _safe(text: str, at: int) -> int:
    while at < len(text) and _joins_the_sign_before(text[at]):
        at += 1
    return min(at, len(text))


def _chunks(chunk_chars: int, overlap_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("digest", pa.string()), ("chunk", pa.int32()), ("begin", pa.int32()), ("last", pa.bool_()), ("piece", pa.string())]
        )
        for batch in batches:
            for row in range(batch.num_rows):
                digest, text = (batch.column(i)[row].as_py() for i in range(2))
                begins = cuts(text, chunk_chars)
                for i, begin in enumerate(begins):
                    last = i + 1 == len(begins)
                    stop = len(text) if last else _safe(text, begins[i + 1] + overlap_chars)
                    yield pa.RecordBatch.from_pylist(
                        [{"digest": digest, "chunk": i, "begin": begin, "last": last, "piece": text[begin:stop]}], schema
                    )

    return run


def _encoded(tokenizer: Broadcast, overlap_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        key = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("id", pa.int32())])
        counts = pa.list_(pa.int32())
        schema = pa.schema(
            [("digest", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("n", pa.int64())]
            + [("head", pa.list_(key)), ("head_through", counts), ("tail", pa.list_(key)), ("tail_through", counts)]
        )
        for batch in batches:
            for row in range(batch.num_rows):
                digest, chunk, begin, last, piece = (batch.column(i)[row].as_py() for i in range(5))
                encoding = counter.encode([piece])[0]
                spans = np.array(encoding.offsets, np.int64).reshape(-1, 2)
                ids, at = np.array(encoding.ids, np.int64), np.arange(len(spans))
                # Tokens that share a sign with a neighbour have no span of their own.
                parted = np.append(True, spans[1:, 0] >= spans[:-1, 1])[: len(ids)]
                clear = parted & np.append(parted[1:], True)[: len(ids)] & (spans[:, 0] < spans[:, 1])
                overlap = len(piece) - 2 * overlap_chars
                head = at[clear & (spans[:, 1] <= 2 * overlap_chars)] if chunk else at[:0]
                tail = at[clear & (spans[:, 0] >= overlap) & (spans[:, 1] <= len(piece) - MARGIN)] if not last else at[:0]

                def keys(chosen: np.ndarray) -> list[dict]:
                    return [
                        {"start": s + begin, "end": e + begin, "id": i}
                        for (s, e), i in zip(spans[chosen].tolist(), ids[chosen].tolist(), strict=True)
                    ]

                found = {"digest": digest, "chunk": chunk, "last": last, "n": len(ids)}
                found |= {"head": keys(head), "head_through": (head + 1).tolist()}
                found |= {"tail": keys(tail), "tail_through": (tail + 1).tolist()}
                yield pa.RecordBatch.from_pylist([found], schema)

    return run
