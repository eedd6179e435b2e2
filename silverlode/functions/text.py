"""Column functions that give raw text its nulls and its types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType

# --- Fixed values: the words a CSV cell may hold to mean "no value" or a boolean ---
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")
# -----------------------------------------------------------------------------------

# A plain cast would also take Java forms such as "1d" or "0x1p3".
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity)\s*$"


def quoted(name: str) -> str:
    """The name as a SQL identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def blank_null_words(name: str) -> Column:
    """A raw text column, null where it is one of the null words, quoted in the file or not.

    A length in bytes is known at once, so long texts are not hashed to look them up. One SQL
    expression stands for what would be dozens of column calls in a wide table.
    """
    text = quoted(name)
    words = ", ".join(f"'{word}'" for word in NULL_WORDS)
    longest = max(map(len, NULL_WORDS))
    return F.expr(f"CASE WHEN octet_length({text}) > {longest} OR {text} NOT IN ({words}) THEN {text} END").alias(name)


def typed(text: Column, to: DataType) -> Column:
    """The text as a value of type ``to``; null where it is not one, whatever the ANSI setting."""
    if isinstance(to, StringType):
        return text
    if isinstance(to, BooleanType):
        return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)
    if isinstance(to, (DoubleType, FloatType)):
        return F.when(text.rlike(NUMBER_TEXT), text.try_cast(to))
    if isinstance(to, (LongType, IntegerType)):
        # Whole numbers arrive as "90.0" from tools that keep gappy integer columns as floats.
        return F.coalesce(text.try_cast(to), F.regexp_replace(text, r"\.0*\s*$", "").try_cast(to))
    return text.try_cast(to)
