"""Reading landed CSV files as typed tables."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from silverlode.functions import blank_null_words, quoted, typed
from silverlode.functions.text import FALSE_WORDS, INTEGER_TEXT, NUMBER_TEXT, TRUE_WORDS
from silverlode.session import Scratch
from silverlode.sources.split import CSV_FORMAT, RECORD, block_effect, file_effect, line_effects, split_records

# A file up to this size is one task's work, of seconds to a minute; a larger one is read in
# parallel pieces. That takes more work per byte, so it is not the way for small files.
SPLIT_ABOVE = 2 * 1024 * 1024 * 1024

# Text that is worth a task of its own once it is parsed.
SPREAD_BYTES = 8 * 1024 * 1024

# Ends of names of files that Spark reads decompressed, and cannot cut.
COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".xz")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    split_above: int = SPLIT_ABOVE,
    scratch: Scratch | None = None,
    spread: bool = False,
    losses: Observation | None = None,
) -> DataFrame:
    """CSV files with a header, quoted fields that may span lines, and null words.

    With a ``schema``, its columns are taken from the file by name and cast; text that is not of
    the declared type becomes null. Without one, all columns are kept and their types are found in
    one pass over the data. A record shorter than the header is padded with nulls, a longer one
    fails the job, as does a quoted field that is never closed; blank lines are skipped. The files
    under ``path`` must have the same header.

    Each file is dealt to one of three ways by its own size and line ends (``_deal``), and the rest is left as it is: one
    large or CR LF file does not change how others are read. Files larger than ``split_above`` bytes are read in
    parallel pieces; the result then reads tables in ``scratch``, which the caller may clear when
    done with it. With ``spread``, records of a few smaller files are shared among all cores, which
    is worth a shuffle where costly work such as a write follows. ``losses`` gets the number of ``rows``
    and, as ``lost <column>``, how many texts became null for want of the declared type, when the result is run.
    """
    header = _header(spark, path)
    names = _column_names(header)
    record = _free(RECORD, names)
    found = _look_over(spark, path, names != header or any("\n" in name for name in header))
    whole, zipped, split = _deal(found, split_above)
    parts = []
    if whole:
        at = path if len(whole) == len(found["all"]) else _paths(whole)
        rows = _whole_files(spark, at, names, names == header, record)
        parts.append(_spread(rows, len(whole), sum(f["size"] for f in whole)) if spread else rows)
    if zipped:
        parts.append(_line_ends_taken(_whole_files(spark, _paths(zipped), names, False, record), names, record))
    if split:
        size = sum(f["size"] for f in split)
        parts.append(split_records(spark, _paths(split), header, size, scratch or Scratch(spark)).toDF(*names, record))
    records = reduce(DataFrame.unionAll, parts).where(_is_record(names, record))
    text = records.select(*[blank_null_words(n) for n in names])
    if schema is None:
        schema = infer_schema(text)
    if losses is None:
        return text.select(*[typed(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in schema])
    return _with_losses(text, schema, losses)


def _with_losses(text: DataFrame, schema: StructType, losses: Observation) -> DataFrame:
    """The typed rows; texts that are not of the declared type are counted as the rows go by."""
    place = {f.name: f"_{i}" for i, f in enumerate(schema)}
    may_fail = [f for f in schema if not isinstance(f.dataType, StringType)]
    both = text.select(
        *[typed(F.col(quoted(f.name)), f.dataType).alias(place[f.name]) for f in schema],
        *[F.col(quoted(f.name)).isNotNull().alias(f"given{place[f.name]}") for f in may_fail],
    )
    counts = [
        F.count_if(F.col(f"given{place[f.name]}") & F.col(place[f.name]).isNull()).alias(f"lost {f.name}") for f in may_fail
    ]
    seen = both.observe(losses, F.count(F.lit(1)).alias("rows"), *counts)
    return seen.select(*[F.col(place[f.name]).alias(f.name) for f in schema])


def _free(name: str, taken: list[str]) -> str:
    """A name that no column has, whatever the case of its letters."""
    lower = {t.lower() for t in taken}
    while name in lower:
        name += "_"
    return name


def _deal(found: Row, split_above: int) -> tuple[list[Row], list[Row], list[Row]]:
    """The files that are read whole, zipped and split.

    One task reads a file from end to end, but for large files, and such as have a line that ends in CR LF, of which
    that task would not take the line ends off: those are split. Compressed files cannot be cut; with such line
    ends they are read from end to end too, and the line ends taken off afterwards (zipped). Where first lines differ
    that a schema cannot state, all are split, which compares them.
    """
    ways = [], [], []
    for file in found["all"]:
        cannot_be_cut = file["file"].endswith(COMPRESSED)
        split = found["heads"] > 1 or not cannot_be_cut and (file["cr_lf"] or file["size"] > split_above)
        ways[2 if split else 1 if file["cr_lf"] else 0].append(file)
    return ways


def _paths(files: list[Row]) -> list[str]:
    """Paths that name just these files: metadata has them as URLs, and readers take some signs for patterns."""
    return [re.sub(r"([][{}*?\\])", r"\\\1", unquote(f["file"])) for f in files]


def _header(spark: SparkSession, path: str) -> list[str]:
    """The cells of the first record of one file."""
    first = spark.read.text(path, lineSep="\n").where(~F.col("value").rlike(r"^[ \t\r]*$")).first()
    line = first["value"] if first else ""
    if line.count('"') % 2:  # a name goes on in the next line
        header = spark.read.options(**CSV_FORMAT).csv(path, header=True, multiLine=True).columns
    elif "\r" in line.removesuffix("\r"):
        raise ValueError(f"{path}: lines that end in a carriage return alone are not read")
    else:
        header = next(csv.reader([line.removesuffix("\r").removeprefix("\ufeff")]), [])
    if not header:
        raise ValueError(f"{path}: the first line holds no column names")
    return header


def _column_names(header: list[str]) -> list[str]:
    """Unnamed columns are named by their place, and repeated names numbered."""
    names: list[str] = []
    for i, cell in enumerate(header):
        name = base = cell or f"Unnamed: {i}"
        repeat = 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names


def _look_over(spark: SparkSession, path: str, compare_heads: bool) -> Row:
    """One pass over the text, which any number of tasks can share: every file's size and line ends.

    Fails if a file ends within a quoted field, as a task that reads it from end to end would take the rest of the file
    for that field's value. That is told exactly from the effects of the lines (``split.leaves_open``), composed by block
    and then by file; what is grouped is a number for each line that changes the state, and then a few numbers a block.
    With ``compare_heads``, ``heads`` is the number of different first lines.
    """
    text, line = F.col("value"), F.col("line")
    head = F.btrim(text, F.lit(" \t\r\ufeff"))
    is_head = (F.col("block") == 0) & (head != "")
    lines = line_effects(spark, path, F.col("_metadata.file_size").alias("size"))
    blocks = lines.groupBy("file", "block").agg(
        block_effect().alias("effect"),
        F.max("size").alias("size"),
        F.max(text.endswith("\r")).alias("cr_lf"),
        (F.min_by(F.xxhash64(head), F.when(is_head, line)) if compare_heads else F.lit(0)).alias("head"),
    )
    files = blocks.groupBy("file").agg(
        file_effect().alias("effect"),
        F.max("size").alias("size"),
        F.max("cr_lf").alias("cr_lf"),
        F.min_by("head", "block").alias("head"),
    )
    found = files.agg(
        F.max(F.when(F.col("effect.opens"), F.col("file"))).alias("unclosed"),
        F.count_distinct("head").alias("heads"),
        # The driver lists all files of a scan anyway.
        F.collect_list(F.struct("file", "size", "cr_lf")).alias("all"),
    ).first()
    if found["unclosed"]:
        raise ValueError(f"{found['unclosed']}: a quoted field is never closed")
    return found


def _spread(raw: DataFrame, files: int, size: int) -> DataFrame:
    """Shares the records of few, sizeable files among all cores, if that gives four times the tasks.

    Otherwise there is no shuffle. Records go by their number in the input, which stays the same
    when a lost task is run again.
    """
    partitions = min(raw.sparkSession.sparkContext.defaultParallelism, size // SPREAD_BYTES + 1)
    if partitions < 4 * files:
        return raw
    row = _free("_row", raw.columns)
    return raw.withColumn(row, F.monotonically_increasing_id()).repartition(partitions, row).drop(row)


def _whole_files(spark: SparkSession, path: str | list[str], names: list[str], check_header: bool, record: str) -> DataFrame:
    """One task reads a file from end to end.

    With ``check_header``, each file's header is checked here; a schema cannot state it if names are blank or
    repeated, and the caller has then compared those.
    """
    schema = StructType([StructField(n, StringType()) for n in [*names, record]])
    return spark.read.options(**CSV_FORMAT).csv(
        path,
        schema,
        header=True,
        multiLine=True,
        lineSep="\n",
        enforceSchema=not check_header,
        columnNameOfCorruptRecord=record,
    )


def _line_ends_taken(raw: DataFrame, names: list[str], record: str) -> DataFrame:
    """The last cell of each record without the carriage return of its line end.

    That is one at the end of the last column, or of the last cell of a short record. In a file where only some lines end in
    CR LF, a quoted last field that ends in a carriage return loses it too.
    """
    cells = []
    for name, after in zip(names, [*names[1:], None], strict=True):
        last = F.lit(True) if after is None else F.col(quoted(record)).isNotNull() & F.col(quoted(after)).isNull()
        cell = F.col(quoted(name))
        cells.append(F.when(last, F.regexp_replace(cell, r"\r\z", "")).otherwise(cell).alias(name))
    return raw.select(*cells, F.col(quoted(record)))


def _is_record(names: list[str], record_name: str) -> Column:
    """False for a blank line; fails on a record with more fields than the header.

    The column ``record_name`` holds the text of a record whose field count is not the header's, else null.
    """
    record = F.col(quoted(record_name))
    blank = record.rlike(r"^[ \t\r\n]*$") & F.coalesce(F.col(quoted(names[0])), F.lit("")).rlike(r"^[ \t\r\n]*$")
    commas = F.regexp_replace(F.regexp_replace(record, r'"[^"]*+"', ""), r"[^,]++", "")
    too_long = F.raise_error(
        F.concat(F.lit(f"CSV record has more than the {len(names)} fields of the header: "), record)
    ).cast("boolean")
    return (
        F.when(record.isNull(), True)
        .when(blank, False)
        .when(F.length(commas) >= len(names), too_long)
        .otherwise(True)
    )


def infer_schema(text: DataFrame) -> StructType:
    """The narrowest type that holds every value of each all-text column, in one aggregation.

    Whole numbers without gaps are bigint, any other numbers double (also an all-null column),
    true/false words boolean, and the rest string, as is a number too large for a double. Whole
    numbers past bigint are decimal(20,0) if they fit 64 unsigned bits.
    """
    measures = []
    for i, name in enumerate(text.columns):
        c = F.col(quoted(name))
        whole = c.rlike(INTEGER_TEXT)
        wide = F.when(whole, F.trim(c)).try_cast("decimal(20,0)")
        overflows = F.abs(c.try_cast("double")) == F.lit(float("inf"))
        measures += [
            F.count(c).alias(f"values_{i}"),
            F.count_if(whole).alias(f"whole_{i}"),
            F.count_if(whole & c.try_cast("bigint").isNotNull()).alias(f"bigint_{i}"),
            F.count_if(wide.between(0, F.lit(str(2**64 - 1)).cast("decimal(20,0)"))).alias(f"unsigned_{i}"),
            F.count_if(c.rlike(NUMBER_TEXT) & (c.rlike("(?i)inf") | ~overflows)).alias(f"number_{i}"),
            F.count_if(c.isin(*TRUE_WORDS, *FALSE_WORDS)).alias(f"boolean_{i}"),
        ]
    seen = text.agg(F.count(F.lit(1)).alias("rows"), *measures).first().asDict()
    return StructType(
        [
            StructField(
                name,
                _narrowest(
                    seen["rows"],
                    **{m: seen[f"{m}_{i}"] for m in ("values", "whole", "bigint", "unsigned", "number", "boolean")},
                ),
            )
            for i, name in enumerate(text.columns)
        ]
    )


def _narrowest(
    rows: int, values: int, whole: int, bigint: int, unsigned: int, number: int, boolean: int
) -> DataType:
    if rows == 0:
        return StringType()
    if values == rows and bigint == rows:
        return LongType()
    if values == rows and unsigned == rows:
        return DecimalType(20, 0)
    if whole == values > bigint:
        return StringType()
    if number == values:
        return DoubleType()
    if boolean == values:
        return BooleanType()
    return StringType()
