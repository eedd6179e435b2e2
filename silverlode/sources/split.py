"""Reading one large CSV file in many tasks, though quoted fields may hold line breaks.

Whether a line break ends a record depends on all the text before it. Each line is therefore
reduced to its *effect*: whether a quoted field is open after the line, given that none was open
before it (``opens``), and given that one was (``stays``). Effects compose, so those of a block's
lines give the effect of the block, and those of a file's blocks tell how each block begins. Lines
at the head of a block that finish a record begun earlier then move to the block where it began,
and every block is cut into whole records on its own. No group of lines is larger than a block of
text and one record, however large the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silverlode.session import Scratch

CSV_FORMAT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}

# Text of a record whose field count is not the header's; null for all others.
RECORD = "_record"

# A block's bounds take some 200 bytes, so this many stay far below a broadcast's limit. It is
# reached at 60 TB of CSV in blocks of the usual size; beyond it the join shuffles.
BROADCAST_BLOCKS = 500_000

# Text that one task of the shuffle sorts, spilling as needed, and cuts into records.
BYTES_PER_PARTITION = 1024 * 1024 * 1024

_BLANK = r"^[ \t\r]*$"

# Where a quote may stand: at the start of a field, further on in one, or in a quoted one.
_START, _PLAIN, _QUOTED = range(3)


def split_records(spark: SparkSession, path: list[str], header: list[str], size: int, scratch: Scratch) -> DataFrame:
    """All records as one string column per cell of the header, plus ``RECORD``; headers left out.

    ``size`` is that of all files together, in bytes.
    """
    partitions = size // BYTES_PER_PARTITION + 1
    if partitions <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        partitions = None
    lines = _staged_lines(spark, path, scratch)
    records = _records(lines, _staged_heads(spark, lines, partitions, scratch), partitions)
    cells = [f"_c{i}" for i in range(len(header))]
    schema = ", ".join(f"{name} STRING" for name in [*cells, RECORD])
    options = {"quote": CSV_FORMAT["quote"], "escape": CSV_FORMAT["escape"], "columnNameOfCorruptRecord": RECORD}
    # inline keeps the parse to one evaluation per record.
    parsed = records.select("is_header", F.inline(F.array(F.from_csv("text", schema, options))))
    return parsed.where(_is_data(cells, header)).select(*cells, RECORD)


def _staged_lines(spark: SparkSession, path: list[str], scratch: Scratch) -> DataFrame:
    """Every line with its place and effect, as a table in the shared folder.

    Block bounds and line numbers come from the way this one scan was planned. Writing them down
    keeps them the same for both later passes, also after an executor is lost.
    """
    return _staged(spark, line_effects(spark, path), scratch.path("lines"))


def line_effects(spark: SparkSession, path: str | list[str], *more: Column) -> DataFrame:
    """Every line with its place and effect.

    Doubled quotes never change the state, so they are taken out first. What is left is told from the parts between the quotes.
    """
    quotes = F.octet_length("single") - F.octet_length(F.replace(F.col("single"), F.lit('"'), F.lit("")))
    return (
        spark.read.text(path, lineSep="\n")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
            F.replace(F.col("value"), F.lit('""'), F.lit("")).alias("single"),
            *more,
        )
        .withColumn("quotes", quotes)
        .withColumn("parts", F.when(F.col("quotes") > 1, F.split("single", '"', -1)))
        .withColumn("opens", _opens())
        .withColumn("stays", _stays())
        .drop("single", "quotes", "parts")
    )


def _staged(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def _opens() -> Column:
    """True if a quoted field is open after the line, given that none was open before it."""
    starts_field = F.col("single").startswith('"') | F.col("single").contains(',"')
    return F.when(F.col("quotes") == 0, False).when(F.col("quotes") == 1, starts_field).otherwise(leaves_open(_START))


def _stays() -> Column:
    """The same, given that one was open before it."""
    return F.when(F.col("quotes") < 2, F.col("quotes") == 0).otherwise(leaves_open(_QUOTED))


def leaves_open(state: int) -> Column:
    """True if a quoted field is open at the end of a line that begins in the state given.

    Each of the line's ``parts`` but the last ends with a quote, which closes a field that is open, opens one at the start of
    a field, and counts as text anywhere else.
    """
    return F.aggregate(
        F.slice("parts", F.lit(1), F.col("quotes")),
        F.lit(state),
        lambda at, part: F.when(at == _QUOTED, _PLAIN)
        .when(part.endswith(",") | ((at == _START) & (part == "")), _QUOTED)
        .otherwise(_PLAIN),
    ) == F.lit(_QUOTED)


def _with_open_before(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Adds ``open_before``: whether a quoted field is open before this row, if none is at the start.

    An effect either fixes the state (``opens`` equals ``stays``), flips it, or leaves it. So the
    state follows from the last row that fixed it and the number of flips since.
    """
    w = W.partitionBy(*partition).orderBy(*order)
    before, through = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, 0)
    flip = (F.col("opens") & ~F.col("stays")).cast("int")
    fixed = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").cast("int").alias("to"), "flips_through"))
    return (
        df.withColumn("flips", F.coalesce(F.sum(flip).over(before), F.lit(0)))
        .withColumn("flips_through", F.sum(flip).over(through))
        .withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
        .withColumn(
            "open_before",
            F.coalesce(F.col("fixed.to") + F.col("flips") - F.col("fixed.flips_through"), F.col("flips")) % 2 == 1,
        )
        .drop("flips", "flips_through", "fixed")
    )


def _no_effect() -> Column:
    return F.struct(F.lit(False).alias("opens"), F.lit(True).alias("stays"))


def _then(so_far: Column, opens: Column, stays: Column) -> Column:
    """The effect of some text followed by text that has the effect ``opens`` and ``stays``."""
    return F.struct(
        F.when(so_far["opens"], stays).otherwise(opens).alias("opens"),
        F.when(so_far["stays"], stays).otherwise(opens).alias("stays"),
    )


def block_effect() -> Column:
    """Of the lines of a group. Only those that change the state are collected, as one number each."""
    packed = F.col("line") * 4 + F.col("opens").cast("int") * 2 + F.col("stays").cast("int")
    changes = F.array_sort(F.collect_list(F.when(F.col("opens") | ~F.col("stays"), packed)))
    return F.aggregate(
        changes,
        _no_effect(),
        lambda so_far, line: _then(so_far, line.bitwiseAND(2) > 0, line.bitwiseAND(1) > 0),
    )


def file_effect() -> Column:
    """Of the blocks of a group: ``effect`` by ``block``."""
    in_order = F.array_sort(F.collect_list(F.struct("block", "effect")))
    return F.aggregate(in_order, _no_effect(), lambda so_far, b: _then(so_far, b["effect"]["opens"], b["effect"]["stays"]))


def _staged_heads(spark: SparkSession, lines: DataFrame, partitions: int | None, scratch: Scratch) -> DataFrame:
    """Blocks that begin inside a record: the head's last line, and the block it belongs to.

    A group is one block.
    """
    effects = lines.select("file", "block", "line", "opens", "stays")
    if partitions:
        effects = effects.repartition(partitions, "file", "block")
    blocks = effects.groupBy("file", "block").agg(
        block_effect().alias("effect"),
        F.min(F.when(~F.col("stays"), F.col("line"))).alias("closes"),
        F.max("line").alias("last_line"),
    )
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    has_start = ~F.col("open_before") | (F.col("closes") < F.col("last_line"))
    states = (
        _with_open_before(blocks.select("file", "block", "effect.*", "closes", "last_line"), ["file"], ["block"])
        .withColumn("home", F.last(F.when(has_start, F.col("block")), ignorenulls=True).over(earlier))
        .withColumn("head_end", F.coalesce("closes", "last_line"))
        .select("file", "block", "home", "head_end", "open_before")
    )
    staged = _staged(spark, states, scratch.path("blocks"))
    heads = staged.where("open_before").select("file", "block", "home", "head_end")
    return F.broadcast(heads) if heads.count() <= BROADCAST_BLOCKS else heads


def _records(lines: DataFrame, heads: DataFrame, partitions: int | None) -> DataFrame:
    """The text of every record, and whether it is the first of its file. Blank lines are left out."""
    place = ["block", "line"]
    own = F.coalesce(F.when(F.col("line") <= F.col("head_end"), F.col("home")), F.col("block"))
    moved = lines.join(heads, ["file", "block"], "left").withColumn("own_block", own).drop("home", "head_end")
    if partitions:
        moved = moved.repartition(partitions, "file", "own_block")
    so_far = W.partitionBy("file", "own_block").orderBy(*place).rowsBetween(W.unboundedPreceding, 0)
    joined = F.expr("listagg(value, '\n') WITHIN GROUP (ORDER BY block, line)")
    return (
        _with_open_before(moved, ["file", "own_block"], place)
        .where(F.col("open_before") | ~F.col("value").rlike(_BLANK))
        .withColumn("record", F.sum((~F.col("open_before")).cast("int")).over(so_far))
        .groupBy("file", "own_block", "record")
        .agg(joined.alias("text"))
        .select(
            ((F.col("own_block") == 0) & (F.col("record") == 1)).alias("is_header"),
            F.regexp_replace("text", r"\r\z", "").alias("text"),
        )
    )


def _is_data(cells: list[str], header: list[str]) -> Column:
    """False for a header; fails on one that differs, as its columns would be mixed up."""
    found = F.array(*[F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", "") for c in cells])
    differs = F.raise_error(F.concat(F.lit("CSV files differ in their headers: "), F.to_json(found))).cast("boolean")
    same = found == F.array(*[F.lit(name) for name in header])
    return F.when(~F.col("is_header"), True).when(same, False).otherwise(differs)
