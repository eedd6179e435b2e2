"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks, then seeded block selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import WORD, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
SEED = 17
# Steps of a golden section of the cycle fall evenly into it, however many are made.
GOLDEN_CYCLE = 1 << 31
GOLDEN_STEP = 1_327_217_885
# A word with the white space behind it, so that cut texts keep their line ends.
PIECE = WORD + r"[\x20\x09-\x0D]*"


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``sizes``, which has a row (source, source_size) per source, with a column target.

    Sources in code point order, null last, take ``weights`` in turn and share the sum of all sizes.
    A target stops at ``max_repeats`` times its source's size; what that leaves over is shared by
    weight again. In the order of size by weight, the sources that stop come first: the level (words
    per unit of weight) is the first one that the next source in that order can bear.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    )
    ceiling = F.col("source_size") * max_repeats
    by_bearing = Window.orderBy(F.col("bearing"), F.col("source").asc_nulls_last())
    before = by_bearing.rowsBetween(Window.unboundedPreceding, -1)
    here_on = by_bearing.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = ranked.withColumn("bearing", ceiling / F.col("weight")).withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(ceiling).over(before), F.lit(0)))
        / F.sum("weight").over(here_on),
    )
    borne = F.min(F.when(F.col("level") <= F.col("bearing"), F.struct("bearing", "level"))).over(everything)["level"]
    return levels.withColumn("borne", borne).select(
        *sizes.columns, F.least(ceiling.cast("double"), F.col("borne") * F.col("weight")).alias("target")
    )


def _dither(shard: Column, salt: Column) -> Column:
    """Even steps through [0, 1) from shard to shard, from a start that ``salt`` (a hash) sets."""
    step = F.pmod(shard * GOLDEN_STEP + F.pmod(salt, F.lit(GOLDEN_CYCLE)), F.lit(GOLDEN_CYCLE))
    return step / GOLDEN_CYCLE


def quotas(cells: DataFrame, block_words: int, max_repeats: int, seed: int = SEED) -> DataFrame:
    """Words for each cell (shard, key): blocks by highest quotients ``weight / (2k + 1)`` within its shard.

    ``cells`` has (shard, key, cell_size, aim); the result adds quota, the words taken. A cell has seats up to
    ``max_repeats`` times its size, of a block each; the last one counts by its real length, so an aim in it is so many of its own
    words. Rounding would go the same way in all shards where cells are alike, so each weight is the aim in
    seats, moved by less than half a seat either way, evenly from shard to shard. A shard with m sources and n seats gives a source
    between ``round(weight * (n - m/2) / all)`` and ``round(weight * (n + m/2) / all)``, so only the
    seats between these are ranked. Groups are as large as there are sources in a shard.
    """
    shard = Window.partitionBy("shard")
    most_words = F.col("cell_size") * max_repeats
    before_last = F.greatest(F.ceil(most_words / block_words) - 1, F.lit(0))
    last = most_words - before_last * block_words
    seats = F.when(F.col("aim") <= before_last * block_words, F.col("aim") / block_words).otherwise(
        before_last + F.when(last > 0, (F.col("aim") - before_last * block_words) / last).otherwise(0.0)
    )
    moved = F.col("exact") + _dither(F.col("shard"), F.xxhash64(F.lit(seed), "key")) - 0.5
    framed = (
        cells.withColumn("exact", seats)
        # Never 0 where something is aimed at, so that all seats of a shard find a taker.
        .withColumn("weight", F.greatest(moved, F.col("exact") * 1e-3))
        .withColumns(
            {
                "all_weights": F.sum("weight").over(shard),
                "members": F.count(F.lit(1)).over(shard),
                "seats": F.floor(F.sum("exact").over(shard) + _dither(F.col("shard"), F.xxhash64(F.lit(seed)))),
            }
        )
    ).withColumn("weight", F.when(F.col("exact") > 0, F.col("weight")).otherwise(0.0))
    share = F.when(F.col("all_weights") > 0, F.col("weight") / F.col("all_weights")).otherwise(0.0)
    bounded = framed.withColumns(
        {
            "sure": F.greatest(
                F.lit(0), F.floor(share * (F.col("seats") - F.col("members") / 2) - 0.5)
            ).cast("long"),
            "most": F.ceil(share * (F.col("seats") + F.col("members") / 2) + 0.5).cast("long"),
        }
    )
    ranked = (
        bounded.withColumn("open", F.col("seats") - F.sum("sure").over(shard))
        .withColumn("k", F.explode(F.sequence("sure", F.greatest(F.col("sure"), F.col("most")))))
        .withColumn(
            "place",
            F.row_number().over(
                shard.orderBy((F.col("weight") / (2 * F.col("k") + 1)).desc(), "key", "k")
            ),
        )
    )
    won = F.first("sure") + F.count(F.when((F.col("place") <= F.col("open")) & (F.col("weight") > 0), 1))
    return (
        ranked.groupBy(*cells.columns)
        .agg(won.alias("won"))
        .withColumn("quota", F.least(F.col("won") * block_words, most_words))
        .drop("won")
    )


def _picked(word: Column, m: Callable[[str], Column]) -> tuple[Column, Column, Column]:
    """Of the words taken once more: how many lie before this word's block, how many in it, and the word's place in the block.

    ``picks`` of a cell's ``full`` blocks are taken at even steps from a seeded start, and of each the first words, as many as
    make up ``spread`` in all; of the words behind the full blocks, the first ``tail``.
    """
    block = F.least(F.floor(word / m("block_words")), m("full"))
    upto = lambda b: F.floor((b * m("picks") + m("start")) / F.greatest(m("full"), F.lit(1)))
    words = lambda picks: F.floor(picks * m("spread") / F.greatest(m("picks"), F.lit(1)))
    before = words(upto(block))
    here = F.when(block < m("full"), words(upto(block + 1)) - before).otherwise(m("tail"))
    return before, here, word - block * m("block_words")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with a struct column ``mix``: what a mix of all sources to their targets takes of each row.

    Documents are dealt by a seeded hash into shards of about ``shard_words`` words. In each shard a
    source's documents, in seeded order, form one run of words, cut into blocks of ``block_words``.
    The source's target is shared over its shards by size, and every shard gives whole numbers of
    blocks to its sources by Sainte-Lague; a last block counts by its real length. A quota above the cell's size takes all of it
    ``mix.copies`` times; the rest, counted in words, picks blocks at even steps from a seeded start, each once more.

    ``mix`` has size, source_size, target, copies, taken (words, repeats counted) and what
    ``mixed_texts`` needs. A null text has size 0 and nothing is taken of it; a null source is a source of its own, and
    comes last; null and repeated ids are rows like others; ties go by id and text hash; an empty table gives no
    rows. Columns of ``docs`` other than doc_id, text and source are only carried, but for one
    named mix, which is replaced.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "mix"]).alias("row"),
        F.col("source"),
        # Never null, so that one exchange serves the running sum and the join.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id").alias("place"),
        F.xxhash64("text").alias("tie"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(total // shard_words + 1)))
    cells = rows.groupBy("shard", "key", "source").agg(F.sum("size").alias("cell_size"))
    targets = source_targets(
        cells.groupBy("key", "source").agg(F.sum("cell_size").alias("source_size")), weights, max_repeats
    )
    aimed = cells.drop("source").join(targets, "key").withColumn(
        "aim",
        F.when(F.col("source_size") > 0, F.col("target") * F.col("cell_size") / F.col("source_size")).otherwise(0.0),
    )
    cell = F.col("cell_size")
    more = F.when(cell > 0, F.col("quota") % cell).otherwise(0)
    full = F.floor(cell / block_words)
    plan = quotas(aimed, block_words, max_repeats, seed).select(
        "shard",
        "key",
        "source_size",
        "target",
        F.when(cell > 0, F.floor(F.col("quota") / cell)).otherwise(0).alias("copies"),
        full.alias("full"),
        F.least(F.ceil(more / block_words), full).alias("picks"),
        F.least(more, full * block_words).alias("spread"),
        F.greatest(more - full * block_words, F.lit(0)).alias("tail"),
        F.pmod(F.xxhash64(F.lit(seed), "shard", "key"), F.greatest(full, F.lit(1))).alias("start"),
        F.lit(block_words).alias("block_words"),
    )
    run = Window.partitionBy("shard", "key").orderBy("place", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("first", F.coalesce(F.sum("size").over(run), F.lit(0))).join(plan, ["shard", "key"])

    def before(word: Column) -> Column:
        done, here, at = _picked(word, F.col)
        return done + F.least(here, at)

    taken = F.col("copies") * F.col("size") + before(F.col("first") + F.col("size")) - before(F.col("first"))
    return placed.select(
        "row.*",
        F.struct(
            "size",
            "source_size",
            "target",
            F.col("copies").cast("long").alias("copies"),
            taken.cast("long").alias("taken"),
            "first",
            "full",
            "picks",
            "spread",
            "tail",
            "start",
            "block_words",
        ).alias("mix"),
    )


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """The rows that a mix holds: a document once for each whole copy, then once with the words of its blocks taken once more.

    Rows of which nothing is taken go. Words keep the white space behind them. The column ``mix`` goes, and a column
    ``n_chars`` is counted anew where there is one.
    """
    m = lambda name: F.col(f"mix.{name}")

    def is_picked(word: Column) -> Column:
        _, here, at = _picked(word, m)
        return at < here

    part = F.array_join(
        F.filter(
            F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)),
            lambda _, i: is_picked(m("first") + i),
        ),
        "",
    )
    rest = m("taken") - m("copies") * m("size")
    whole = F.array_repeat("text", m("copies").cast("int"))
    columns = [c for c in mixed.columns if c != "mix"]
    texts = mixed.where(m("taken") > 0).withColumn(
        "text", F.explode(F.when(rest > 0, F.concat(whole, F.array(part))).otherwise(whole))
    )
    if "n_chars" in columns:
        texts = texts.withColumn("n_chars", F.char_length("text").cast("long"))
    return texts.select(*[f"`{c}`" for c in columns])
