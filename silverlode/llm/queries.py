"""The registered queries of this package: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import (
    attention,
    bpe,
    bwt_dedup,
    minhash,
    mixing,
    orchard,
    periodic_runs,
    perplexity,
    pii,
    rotated_codes,
    sharding,
    templates,
    token_counts,
)
from silverlode.llm.common import ship, table, word_count


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(place: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == place)).cast("long")

    counts = [count(place).alias(f"n_{kind}") for place, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, "base_sha256", pii.listed("spans").alias("spans"))


def op2_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = F.transform("removed", lambda run: run["end"] - run["start"])
    return bwt_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_minhash_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_codes.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"), ["page_id", "url"]).select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars")
    )


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken"
    )


def op7_kneser_ney_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.rules(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "quality.*")


def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``. The payload shuffled is the whole document."""
    return sharding.shuffled(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "place.shard",
        "place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_attention_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = attention.train(docs, table(spark, sf_dir, "labels"))
    scored = attention.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        attention.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def bpe_digest(docs: DataFrame) -> DataFrame:
    """doc_id, number and digest of a text's ids, and the digest of the bytes that these decode to."""
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.array_join(F.col("centroid.components").cast("array<string>"), ",")
    return orchard.cluster(table(spark, sf_dir, "embeddings"), ["vec_id"]).select(
        "vec_id",
        "centroid.cluster",
        "centroid.distance",
        "centroid.cluster_inertia",
        "centroid.inertia",
        F.sha2(listed, 256).alias("centroid_sha256"),
    )


def op12_resynchronised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = token_counts.count(docs, WORD_TOKENIZER, ["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    runs = F.col("periodic.runs")
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # The longest run, then the one that starts first, then that of the least period.
    ranked = F.transform(
        runs,
        lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("place"), (-r["period"]).alias("size"), r.alias("run")
        ),
    )
    best = F.array_max(ranked)["run"]
    return periodic_runs.with_runs(docs).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, where a tenth of the ids have all words from some place on replaced by those of one period from there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # Arrays of one element give names to what is used more than once.
    known = F.transform(F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g"))), lambda x: x.withField("n", F.size(x["words"])))
    known = F.transform(known, lambda x: x.withField("a", x["g"] % x["n"]))
    known = F.transform(known, lambda x: x.withField("p", 1 + F.floor((x["n"] - x["a"]) / (3 + x["g"] % 8))))

    def repeated(x: Column) -> Column:
        place = F.sequence(F.lit(0).cast("long"), x["n"] - 1)
        at = F.transform(place, lambda i: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]))
        return F.array_join(F.transform(at, lambda i: F.get(x["words"], i.cast("int"))), " ")

    affected = (h % 10 == 0) & (word_count(F.col("text")) > 0)
    return docs.withColumn("text", F.when(affected, F.get(F.transform(known, repeated), F.lit(0))).otherwise(F.col("text")))


QUERIES = (
    op1_bootstrapped_pii,
    op2_bwt_repeats,
    op3_minhash_one_permutation,
    op4_rotated_codes,
    op5_site_templates,
    op6_sainte_lague_mix,
    op7_kneser_ney_bands,
    op8_two_pass_shuffle,
    op9_attention_bags,
    op10_byte_bpe,
    op11_orchard_clusters,
    op12_resynchronised_counts,
    op13_lyndon_runs,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {q.__name__: shipped(q) for q in QUERIES}


def clusters_sql() -> str:
    """``op11_orchard_clusters``: every vector against every centroid, in whole numbers that doubles hold exactly."""
    assign = """
        SELECT v.id, min(list_inner_product(list_transform(list_zip(v.x, c.x), lambda p: p[1] - p[2]),
                                            list_transform(list_zip(v.x, c.x), lambda p: p[1] - p[2]))::BIGINT * 64 + c.cluster) AS found
        FROM vectors v CROSS JOIN centroids{r} c GROUP BY v.id"""
    step = """
    assigned{r} AS MATERIALIZED (SELECT id, (found % 64)::INTEGER AS cluster, found // 64 AS distance FROM ({assign})),
    summed{r} AS (
        SELECT cluster, place, sum(component::BIGINT) AS total, count(*) AS size
        FROM (SELECT a.cluster, unnest(v.x) AS component, generate_subscripts(v.x, 1) AS place
              FROM assigned{r} a JOIN vectors v USING (id))
        GROUP BY cluster, place
    ),
    centroids{next} AS MATERIALIZED (
        SELECT c.cluster, coalesce(m.x, c.x) AS x
        FROM centroids{r} c LEFT JOIN (
            SELECT cluster, list(((total - ((total % size) + size) % size) // size)::DOUBLE ORDER BY place) AS x
            FROM summed{r} GROUP BY cluster
        ) m USING (cluster)
    ),"""
    rounds = "".join(
        step.format(r=r, next=r + 1, assign=assign.format(r=r)) for r in range(orchard.ROUNDS)
    )
    last = orchard.ROUNDS
    return f"""
    WITH vectors AS MATERIALIZED (
        SELECT row_number() OVER () AS id, vec_id, x FROM (
            SELECT vec_id, list_transform(embedding, lambda e: floor({orchard.SCALE} * e::DOUBLE)) AS x FROM embeddings
            WHERE len(embedding) = {orchard.DIMENSIONS}
                AND len(list_filter(embedding, lambda e: coalesce(isfinite(e), false))) = {orchard.DIMENSIONS}
        )
    ),
    centroids0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY sha256(concat('{orchard.SEED}:', vec_id)), x) - 1)::INTEGER AS cluster, x
        FROM vectors QUALIFY cluster < {orchard.CLUSTERS}
    ),{rounds}
    assigned AS MATERIALIZED (SELECT id, (found % 64)::INTEGER AS cluster, found // 64 AS distance FROM ({assign.format(r=last)}))
    SELECT vec_id, a.cluster, distance,
        (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
        (sum(distance) OVER ())::BIGINT AS inertia,
        sha256(array_to_string(list_transform(c.x, lambda e: e::BIGINT), ',')) AS centroid_sha256
    FROM assigned a JOIN vectors USING (id) JOIN centroids{last} c ON a.cluster = c.cluster"""


def oracle_sql() -> dict[str, str]:
    return {"op11_orchard_clusters": clusters_sql()}
