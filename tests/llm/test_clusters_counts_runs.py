"""Clustering, token counts and periodic runs against brute force, and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverlode.llm import orchard, periodic_runs, queries, token_counts
from silverlode.llm.common import table


# -- clustering


def test_clusters_are_those_of_the_sql(spark, sf_dir):
    name = "op11_orchard_clusters"
    assert assert_same(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) > 0


def test_orchard_finds_the_nearest_of_least_number():
    draw = np.random.default_rng(3)
    for largest in (2, 5, 300):
        centroids = draw.integers(-largest, largest, (40, 3))
        vectors = draw.integers(-largest, largest, (2000, 3))
        every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
        best, distance = orchard.Orchard(centroids).nearest(vectors)
        assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_odd_vectors(spark):
    base = [0.5] * 64
    rows = [
        (1, base, "a"), (1, base, "a"), (2, [-0.25] * 64, "b"), (None, [0.75] * 64, "c"), (3, None, "d"), (4, [], "e"),
        (5, [0.1] * 63, "f"), (6, [None] * 64, "g"), (7, [float("nan")] * 64, "h"), (8, [float("inf")] * 64, "i"),
        (9, [1e30] * 64, "j"), (10, [0.0] * 64, "k"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, centroid string")
    found = orchard.cluster(vectors, clusters=2).select("vec_id", "centroid.*").collect()
    assert sorted((r.vec_id for r in found), key=str) == sorted([1, 1, 2, None, 10], key=str)
    assert len({r.cluster for r in found if r.vec_id == 1}) == 1
    assert sum(r.distance for r in found) == found[0].inertia
    all_ = orchard.cluster(vectors).select("vec_id", "centroid.*").collect()  # fewer vectors than centroids
    assert all(r.inertia == 0 for r in all_)
    assert orchard.cluster(vectors.limit(0)).collect() == []
    assert orchard.cluster(vectors.where("vec_id > 2 and vec_id < 9")).columns == vectors.columns


def test_a_round_keeps_centroids_that_get_no_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("embedding").alias("vector")).where(F.size("vector") == 64)
    moved = orchard._moved(vectors, np.zeros((40, 64), np.int64), 256)
    rows = np.floor(256 * np.stack([r.vector for r in vectors.collect()])).astype(int)
    assert (moved[0] == rows.sum(0) // len(rows)).all() and (moved[1:] == 0).all()


# -- token counts


ODD = [
    "", None, " \n\t ", "x" * 5000, "ab" * 3000, "日本語テキスト" * 400, "🙂👨‍👩‍👧" * 300, "<|endoftext|>" * 200, "a <|startoftext|>b" * 99,
    "<|ENDOFTEXT|> <|endof", "don't we'll I'm!'s!'s!!'re" * 90, "é" * 900, "́" * 700, "İstanbul ß ﬁ Å" * 80,
    "각" * 300, "\x85\xa0  x　y" * 200, "!" * 999 + "<|endoftext|>" + "!" * 999, "1234567890" * 120,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.WORD_TOKENIZER)


@pytest.mark.parametrize("chunk, overlap", [(token_counts.CHUNK_CHARS, token_counts.OVERLAP_CHARS), (100, 40), (400, 64), (64, 64)])
def test_counts_are_those_of_the_library(spark, sf_dir, library, chunk, overlap):
    docs = table(spark, sf_dir, "documents").select("text")
    odd = spark.createDataFrame([(t,) for t in ODD + ODD[:7]], "text string")
    draw = random.Random(chunk)
    signs = "aab 'sTre!?<|>0éÉ日 \n"
    mixed = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 900))) for _ in range(60)]
    docs = docs.where(F.length("text") < 6000) if chunk < 1000 else docs
    docs = docs.unionByName(odd).unionByName(spark.createDataFrame([(t,) for t in mixed], "text string"))
    rows = token_counts.count(docs, queries.WORD_TOKENIZER, chunk_chars=chunk, overlap_chars=overlap).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False)), r.text


def test_a_seam_that_fails_is_widened(spark, library):
    """One sign repeated has no token that both sides of a seam have, until one chunk holds it all."""
    text = "word " * 50 + "x" * 3001 + " word" * 50
    pieces = spark.createDataFrame([("d", text)], "digest string, text string").mapInArrow(
        token_counts._chunks(250, 60), token_counts.CHUNK
    )
    tokenizer = token_counts._sent(pieces, queries.WORD_TOKENIZER)
    joined = token_counts._joined(pieces.mapInArrow(token_counts._encoded(tokenizer, 60), token_counts.ENCODED))
    assert [r.found for r in joined.collect()] == [False]
    docs = spark.createDataFrame([(text,)], "text string")
    found = token_counts.count(docs, queries.WORD_TOKENIZER, chunk_chars=250, overlap_chars=60).first()
    assert found.n_tokens == len(library.encode(text, add_special_tokens=False))


def test_chunks_are_cut_where_normalisation_can_be():
    text = "ab" + "é̂" * 10 + "각"
    found = token_counts.cuts(text, 3)
    assert found[0] == 0 and all(not token_counts._joins_the_sign_before(text[i]) for i in found[1:])
    assert token_counts.cuts("́" * 20, 3) == [0] and token_counts.cuts("", 3) == [0]


# -- runs


def plain_runs(words):
    """All runs by comparing the words at every distance."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, found = np.array([number[w] for w in words], np.int64), []
    for q in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        change = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            length = end - begin + q
            if length >= max(12, 2 * q) and not any(s <= begin and s + n >= end + q for s, n, _ in found):
                found.append((begin, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_runs_are_those_of_brute_force(spark, sf_dir):
    rows = queries.queries()["op13_lyndon_runs"](spark, sf_dir).collect()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, rows)) == sorted(plain_row(*d) for d in docs)
    assert sum(r.n_runs > 0 for r in rows) > 10


def test_lyndon_lengths():
    draw = random.Random(1)
    for _ in range(400):
        w = [draw.randint(0, draw.choice([1, 2, 4])) for _ in range(draw.randint(1, 25))]
        ends = [next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) for i in range(len(w))]
        assert periodic_runs.lyndon_lengths(np.array(w)).tolist() == [e - i for i, e in enumerate(ends)]


@pytest.mark.parametrize("modulus", [2, 5, periodic_runs.MODULUS])
def test_runs_of_random_words(monkeypatch, modulus):
    """With a small modulus most fingerprints collide, and results stay the same."""
    monkeypatch.setattr(periodic_runs, "MODULUS", modulus)
    draw = random.Random(modulus)
    for _ in range(300):
        texts = []
        for _ in range(draw.randint(1, 4)):
            n, most = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 10])
            words = [draw.randint(1, most) for _ in range(n)]
            if n and draw.random() < 0.5:
                p = draw.randint(1, max(1, n // 2))
                words = [words[i % p] for i in range(n)]
                words[draw.randrange(n)] = draw.randint(1, most + 1)
            texts.append(words)
        first = np.cumsum([0, *map(len, texts)]).tolist()
        wanted = [(first[i] + s, n, q) for i, words in enumerate(texts) for s, n, q in plain_runs(words)]
        ids = np.array(sum(texts, []), np.int64)
        found = periodic_runs.runs_of(ids, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        assert list(zip(*(x.tolist() for x in found), strict=True)) == wanted


def test_odd_texts(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("periodic", F.lit("p")).withColumn("n_tokens", F.lit("t"))
    found = {r.doc_id: r.periodic for r in periodic_runs.with_runs(docs).collect()}
    assert periodic_runs.with_runs(docs).count() == 10
    assert all(found[i].runs == [] and found[i].collapsed == "" for i in (2, 3, 4))
    assert [tuple(r) for r in found[7].runs] == [(0, 30_000, 1)] and found[7].collapsed == "word"
    assert found[1].runs == found[5].runs == found[None].runs and [tuple(r) for r in found[1].runs] == [(0, 99, 11)]
    assert periodic_runs.with_runs(no_docs).collect() == []
    counted = token_counts.count(docs, queries.WORD_TOKENIZER)
    assert {r.doc_id: r.n_tokens for r in counted.collect()}.keys() == found.keys() and counted.count() == 10
    assert [r.n_tokens for r in counted.where("doc_id in (2, 3, 4)").collect()] == [0, 0, 0]
    assert token_counts.count(no_docs, queries.WORD_TOKENIZER).collect() == []
    assert queries.with_repeats(odd_docs).count() == 10
