"""Writing Bronze and Silver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from silverlode.model import check_schema
from silverlode.session import delete, exists, replace_folder

# Documents run to kilobytes, so this keeps files in the hundreds of megabytes.
ROWS_PER_FILE = 100_000

# Bounds of long texts are cut off; whole ones would make writers leave a column's statistics out, with its number of nulls.
FOOTERS = {"parquet.statistics.truncate.length": "64"}


def write_bronze(
    df: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "overwrite",
    accept: Callable[[], None] = lambda: None,
) -> None:
    """A directory of Parquet files of at most ``rows_per_file`` rows.

    ``mode`` is ``overwrite``, which replaces the whole directory and so leaves no rows of an
    earlier, longer load, or ``errorifexists``. An empty table leaves one file with the schema.
    New files are written beside old ones and take their place when all are there, so a load that
    fails leaves the old table as it was. The rename is a copy in stores that have none. ``accept`` is called
    when all files are written, and may raise to give them up.
    """
    if rows_per_file < 1:
        raise ValueError(f"rows_per_file must be positive, not {rows_per_file}")
    spark, path = df.sparkSession, path.rstrip("/")
    replaces = mode == "overwrite" and exists(spark, path)
    target, written = f"{path}-{uuid.uuid4().hex}.new" if replaces else path, False
    try:
        writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).options(**FOOTERS)
        writer.parquet(target, compression="zstd")
        written = True
        accept()
    except BaseException:
        if replaces or written:
            delete(spark, target)
        raise
    if replaces:
        replace_folder(spark, path, target)


def write_silver(df: DataFrame, path: str, schema: StructType, fmt: str = "delta") -> None:
    """Overwrite one Silver table at a path of its own, after checking it against its declared schema.

    ``fmt`` is ``delta``, which fails where Delta cannot be loaded, or ``parquet``, which must be asked for by name and is
    refused on a path that holds a Delta table. A Delta overwrite is atomic. A plain Parquet one is not: the old files
    go first, so a reader may find the table missing, and it must not be a path that ``df`` reads from;
    ``write_release`` has neither fault.
    """
    check_schema(df.schema, schema, path)
    if fmt == "parquet" and exists(df.sparkSession, f"{path.rstrip('/')}/_delta_log"):
        raise ValueError(f"{path} is a Delta table; a Parquet overwrite would delete its history")
    df.write.format(fmt).mode("overwrite").save(path)

