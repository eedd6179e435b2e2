"""Reading Bronze tables."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverlode.functions import quoted
from silverlode.model import check_schema
from silverlode.session import own_session

# Aggregates that a scan takes from footers alone, which only the newer reader of Parquet files does.
FOOTER_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.parquet.mergeSchema": "true",
}

# Files of one load are alike, and the shares only set the size of splits.
SAMPLED_FOOTERS = 2


def scan_bronze(spark: SparkSession, path: str, schema: StructType, check: bool = True) -> DataFrame:
    """A Bronze Parquet directory under its declared schema.

    A declared column that a file lacks would read as null, so ``check`` compares the declared schema with the
    footers of all files, in any column order. Columns not used later are never read.
    """
    if check:
        check_footers(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def check_footers(spark: SparkSession, path: str, schema: StructType) -> int:
    """Raise unless every file has the declared columns and no others; the number of rows.

    Two jobs whose tasks read nothing but footers. The first merges the schemas of all files, and so finds columns
    that are not declared or of another type in any of them. The second counts the values of all columns by the footers, which
    fails on a file that has rows and fewer columns. It fails too where a writer left the number of nulls out, as some
    do for long texts (``write_bronze`` does not). Then threads of the driver read the footers, a thousand at a time, and
    tell which file lacks what, if any does.
    """
    own = own_session(spark, FOOTER_SETTINGS)
    try:
        found = own.read.parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        raise ValueError(f"{path}: files differ in the type of a column: {str(error)[:500]}") from error
    in_order = [found[name] for name in schema.names if name in found.names]
    extra = [column for column in found if column.name not in schema.names]
    check_schema(StructType(in_order + extra), schema, path)
    counts = [F.count(F.col(quoted(name))) for name in schema.names]
    counted = own.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"), *counts)
    if "PushedAggregation: [COUNT" not in counted._jdf.queryExecution().executedPlan().toString():
        raise RuntimeError(f"{path}: counts would not come from footers")
    try:
        return counted.first()["rows"]
    except (PySparkException, Py4JJavaError) as error:
        _check_files(spark, path, schema.names)
        if "Number of nulls not set" not in str(error):
            raise
    return spark.read.schema(schema).parquet(path).count()


def _check_files(spark: SparkSession, path: str, names: list[str], at_once: int = 1000) -> None:
    """Raise if a file lacks one of the columns; footers are read by a few threads of the driver."""
    jvm = spark._jvm
    relation = spark.read.parquet(path)._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation()
    files = jvm.scala.jdk.javaapi.CollectionConverters.asJava(relation.location().allFiles())
    conf, good = spark._jsparkSession.sessionState().newHadoopConf(), set()
    for begin in range(0, files.size(), at_once):
        some = jvm.java.util.ArrayList(files.subList(begin, min(begin + at_once, files.size())))
        for footer in jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel(conf, some, True):
            columns = footer.getParquetMetadata().getFileMetaData().getSchema()
            written = columns.toString()
            if written not in good:
                missing = [name for name in names if not columns.containsField(name)]
                if missing:
                    raise ValueError(f"{path}: a file lacks a declared column: {footer.getFile().toString()}, {missing}")
                good.add(written)


def column_shares(spark: SparkSession, path: str) -> dict[str, float]:
    """The share of its files' bytes that each column takes, from the footers of a few files; empty if there are none."""
    files = sorted(spark.read.parquet(path).inputFiles())
    jvm, sizes, total = spark._jvm, {}, 0
    for file in files[:: max(1, len(files) // SAMPLED_FOOTERS)][:SAMPLED_FOOTERS]:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            footer = json.loads(jvm.org.apache.parquet.hadoop.metadata.ParquetMetadata.toJSON(reader.getFooter()))
        finally:
            reader.close()
        total += source.getLength()
        for block in footer["blocks"]:
            for column in block["columns"]:
                name = _path(column["path"])[0]
                sizes[name] = sizes.get(name, 0) + column["totalSize"]
    return {name: size / total for name, size in sizes.items()} if total else {}


def _path(found: list | str) -> list[str]:
    return found if isinstance(found, list) else [part.strip() for part in found.strip("[]").split(",")]
