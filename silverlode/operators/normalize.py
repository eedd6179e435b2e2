"""Turning Bronze rows into Silver rows. Every operator here is map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from silverlode.model import DOCUMENT, MOVIES_CORE, REASON, REJECTED, JsonTable

# Why a document gives no rows although it holds text.
MALFORMED, OTHER_TYPE = "malformed", "not an array of objects"


def normalize(df: DataFrame, table: JsonTable) -> DataFrame:
    """One row per element of the JSON array in ``table.column``, beside its parent columns.

    ``inline`` over the parsed column reads each document once; ``explode`` of a parsed column
    would add an inferred filter that parses it again. Parents with a null, empty or unreadable
    document give no rows. The parent key is renamed in the same select as the generator, as
    elements often hold an ``id`` of their own.
    """
    rows = df.select(
        *[F.col(name).alias(out) for name, out in table.parents.items()],
        F.inline(F.from_json(F.col(table.column), table.parse_type)),
    ).select(*table.parents.values(), *table.fields)
    return fill_defaults(rows, table.fill)


def normalize_marked(df: DataFrame, table: JsonTable) -> DataFrame:
    """The rows of ``normalize``, and one for each document that it cannot read, from one parse of each document.

    Rows have all columns of both: ``rejected`` tells them apart, and those rejected have the parent columns, ``reason`` and
    ``document``. Null and blank texts and a JSON null are documents that hold nothing, and are not rejected. A document
    that is cut off is rejected as a whole, as ``normalize`` takes none of its elements.
    """
    clashing = {REJECTED, REASON, DOCUMENT} & {*table.parents.values(), *table.fields}
    if clashing:
        raise ValueError(f"{table.name}: these names are needed for rejects: {sorted(clashing)}")
    document = F.col(table.column)
    element = table.parse_type.elementType
    marked = StructType([*element, StructField(REJECTED, BooleanType()), StructField(REASON, StringType()), StructField(DOCUMENT, StringType())])

    def rows(parsed: Column) -> Column:
        """What one document gives; ``parsed`` is a name for its parse, which runs once."""
        reject = F.struct(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in element],
            F.lit(True).alias(REJECTED), _reason(document).alias(REASON), document.alias(DOCUMENT),
        )
        found = F.transform(
            parsed,
            lambda e: F.struct(
                *[e[f.name].alias(f.name) for f in element],
                F.lit(False).alias(REJECTED), F.lit(None).cast("string").alias(REASON), F.lit(None).cast("string").alias(DOCUMENT),
            ),
        )
        return F.when(parsed.isNotNull(), found).when(_holds_text(document), F.array(reject)).cast(ArrayType(marked))

    named = F.transform(F.array(F.from_json(document, table.parse_type)), rows)
    out = df.select(*[F.col(name).alias(out) for name, out in table.parents.items()], F.inline(F.flatten(named)))
    filled = {
        f: F.when(F.col(REJECTED), F.col(f)).otherwise(F.coalesce(F.col(f), F.lit(value).cast(out.schema[f].dataType)))
        for f, value in table.fill.items()
    }
    columns = [*table.parents.values(), *table.fields]
    return out.select(*[filled.get(c, F.col(c)).alias(c) for c in columns], REASON, DOCUMENT, REJECTED)


def rejected(df: DataFrame, table: JsonTable) -> DataFrame:
    """The documents that ``normalize`` cannot read: parent columns, reason and text."""
    document = F.col(table.column)
    return df.where(F.from_json(document, table.parse_type).isNull() & _holds_text(document)).select(
        *[F.col(name).alias(out) for name, out in table.parents.items()],
        _reason(document).alias(REASON),
        document.alias(DOCUMENT),
    )


def _holds_text(document: Column) -> Column:
    """Neither null nor blank nor a JSON null."""
    return document.isNotNull() & ~document.rlike(r"^\s*(null\s*)?$")


def _reason(document: Column) -> Column:
    return F.when(F.try_parse_json(document).isNull(), MALFORMED).otherwise(OTHER_TYPE)


def fill_defaults(df: DataFrame, defaults: dict[str, str | int]) -> DataFrame:
    """Replace nulls in the named columns; an unknown column raises."""
    return df.fillna(defaults) if defaults else df


def core_movies(df: DataFrame) -> DataFrame:
    """The scalar columns of the movies table, with its key renamed."""
    return df.select(*[F.col(name).alias(out) for name, out in MOVIES_CORE.items()])
