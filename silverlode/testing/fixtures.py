"""Bronze-shaped inputs, derived from the benchmark tables row by row.

A movie is a row of ``part``; a credits record is a row of ``orders``. The elements of a row's
JSON arrays are computed from that row and the element's number ``i``, so an array is bounded by
the rule that makes it, no rows are gathered by key, and building the input shuffles parent rows
alone, by their number, whatever the keys look like. Each rule is plain SQL that Spark uses to build the documents and an
oracle uses, without any JSON, to list the rows that must come out of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.model import BRONZE, JSON_TABLES, MOVIES_SILVER, JsonTable, struct
from silverlode.session import scratch_path
from silverlode.sinks import write_bronze
from silverlode.sinks.tables import ROWS_PER_FILE
from silverlode.sources import scan_bronze


@dataclass(frozen=True)
class Elements:
    """How a row's array is made: no document at all where ``absent``, else ``size`` elements."""

    absent: str
    size: str
    fields: dict[str, str]


# Null fields are left out of the documents. A few ids do not fit an int, some names hold quotes,
# line breaks and accents, and some arrays are empty.
ELEMENTS = {
    "crew": Elements(
        absent="o_orderkey % 10 = 9",
        size="o_orderkey % 9",
        fields={
            "department": "o_orderstatus",
            "credit_id": "CASE WHEN i = 1 THEN NULL ELSE concat('c', o_custkey, '-', i) END",
            "gender": "i % 3",
            "id": "o_custkey * 10 + i",
            "name": "concat('P \"', o_custkey, '\" é', chr(10), i)",
            "job": "o_orderpriority",
        },
    ),
    "cast": Elements(
        absent="o_orderkey % 11 = 0",
        size="o_orderkey % 7",
        fields={
            "cast_id": "i",
            "character": "CASE WHEN i = 3 THEN NULL ELSE concat(o_orderstatus, ', ', i) END",
            "credit_id": "CASE WHEN (o_orderkey + i) % 5 = 0 THEN NULL ELSE concat('c', o_custkey) END",
            "gender": "i % 3",
            "id": "o_custkey + i",
            "name": "o_orderpriority",
            "order": "i - 1",
        },
    ),
    "genre": Elements(
        absent="p_size % 14 = 0",
        size="p_size % 7",
        fields={"id": "CASE WHEN i = 1 THEN NULL ELSE p_size * 10 + i END", "name": "p_type"},
    ),
    "keywords": Elements(
        absent="p_size = 13",
        size="p_size",
        fields={
            "id": "CASE WHEN i = 9 AND p_partkey % 5 = 0 THEN 3000000000 ELSE p_partkey * 100 END + i",
            "name": "concat(p_name, ' ', i)",
        },
    ),
    "production_companies": Elements(
        absent="p_partkey % 17 = 0",
        size="p_size % 5",
        fields={
            "id": "CASE WHEN p_size % 10 = 1 THEN NULL ELSE p_partkey * 10 + i END",
            "name": "concat(p_brand, ' \"', i, '\"')",
        },
    ),
    "production_countries": Elements(
        absent="p_partkey % 19 = 0",
        size="p_size % 4",
        fields={
            "iso_3166_1": "CASE WHEN i = 2 THEN NULL ELSE upper(substr(p_name, i, 2)) END",
            "name": "CASE WHEN p_size = 3 THEN NULL ELSE p_name END",
        },
    ),
    "spoken_languages": Elements(
        absent="p_partkey % 23 = 0",
        size="p_partkey % 6",
        fields={
            "iso_639_1": "CASE WHEN (p_partkey + i) % 3 = 0 THEN NULL ELSE lower(substr(p_type, i, 2)) END",
            "name": "concat(p_type, ' ñ', i)",
        },
    ),
}

PARENT_TABLE = {"movies": "part", "credits": "orders"}

# Scalar columns of each Bronze table, and with another key name those of the core movie table.
SCALARS = {
    "credits": {"movie_id": "o_orderkey", "title": "o_orderpriority"},
    "movies": {
        "id": "p_partkey",
        "title": "p_name",
        "budget": "CAST(p_size * 1000 AS BIGINT)",
        "homepage": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END",
        "original_language": "lower(substr(p_type, 1, 2))",
        "original_title": "p_name",
        "overview": "p_type",
        "popularity": "p_retailprice / 10",
        "release_date": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE concat('20', 10 + p_size % 10, '-01-15') END",
        "revenue": "p_partkey * 3",
        "runtime": "CASE WHEN p_size % 11 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END",
        "status": "'Released'",
        "tagline": "CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END",
        "vote_average": "CAST(p_size % 10 AS DOUBLE)",
        "vote_count": "CAST(p_size * 2 AS BIGINT)",
    },
}

# Text, languages and counts as CSV cells, with null words among the languages.
DOCUMENT_CELLS = """
    SELECT doc_id, text,
           CASE WHEN doc_id % 4 = 0 THEN 'NA' WHEN doc_id % 4 = 1 THEN 'null' ELSE lang END AS lang, source, n_chars
    FROM {documents}
"""


# Documents for orders, in turn by key, that are not what their type says: each with the (id, name) rows it gives.
ODD_DOCUMENTS = (
    ("""concat('[{"id":', o_orderkey, ',"name":"cut off"}')""", ()),
    ("""concat('[', o_orderkey, ',2]')""", ()),
    (
        """concat('[{"id":"x","name":"', o_orderstatus, '"},{"id":', o_orderkey, ',"name":"b"}]')""",
        (("NULL", "o_orderstatus"), ("o_orderkey", "'b'")),
    ),
    ("""concat('[null,{"id":', o_orderkey, '}]')""", (("NULL", "NULL"), ("o_orderkey", "NULL"))),
    (
        """concat('[{"id":1,"id":', o_orderkey, ',"name":"', o_orderpriority, '"}]')""",
        (("o_orderkey", "o_orderpriority"),),
    ),
    ("'   '", ()),
    ("""concat('[{"id":', o_orderkey, ',"name":"a"}] x')""", (("o_orderkey", "'a'"),)),
    ("NULL", ()),
    (
        """concat('{"id":', o_orderkey, ',"name":"', o_orderpriority, '"}')""",
        (("o_orderkey", "o_orderpriority"),),
    ),
    ("""concat('[{"id":3000000000,"name":"', o_orderstatus, '"}]')""", (("NULL", "o_orderstatus"),)),
    ("""concat('[{"ID":', o_orderkey, ',"name":{"q":1}}]')""", (("NULL", """'{"q":1}'"""),)),
)


# Cells of numbers and booleans by name, some of them planted: the text, and where it is not of the declared type.
NUMBERS = {
    "l_orderkey": ("CAST(l_orderkey AS STRING)", "FALSE"),
    "l_partkey": (
        "CASE WHEN l_partkey % 7 = 0 THEN concat(l_partkey, ' pieces') WHEN l_partkey % 7 = 1 THEN 'NA' "
        "WHEN l_partkey % 7 = 2 THEN concat(l_partkey, '.0') WHEN l_partkey % 7 = 3 THEN concat(l_partkey, '.5') "
        "ELSE CAST(l_partkey AS STRING) END",
        "l_partkey % 7 IN (0, 3)",
    ),
    "l_quantity": (
        "CASE WHEN l_suppkey % 5 = 0 THEN '1,5' WHEN l_suppkey % 5 = 1 THEN '' WHEN l_suppkey % 5 = 2 THEN '0x1p3' "
        "ELSE CAST(CAST(l_linenumber AS INT) AS STRING) END",
        "l_suppkey % 5 IN (0, 2)",
    ),
    "returned": (
        "CASE l_returnflag WHEN 'R' THEN 'true' WHEN 'A' THEN 'False' ELSE CASE WHEN l_linenumber = 1 THEN 'no' ELSE 'null' END END",
        "l_returnflag NOT IN ('R', 'A') AND l_linenumber = 1",
    ),
    "l_returnflag": ("l_returnflag", "FALSE"),
}
NUMBER_TYPES = struct(l_orderkey="long", l_partkey="long", l_quantity="double", returned="boolean", l_returnflag="string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_per_file(rows: int) -> int:
    """Files of a good size when there are many rows, and several files when there are few."""
    return min(ROWS_PER_FILE, max(500, rows // 32))


_built: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """The path of an input of this application, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        path = scratch_path(spark, name)
        build(path)
        _built[key] = path
    return _built[key]


def bronze(spark: SparkSession, sf_dir: str, name: str, check: bool = False) -> DataFrame:
    """The Bronze table ``movies`` or ``credits``, written to files once and read back."""

    def build(path: str) -> None:
        source = table(spark, sf_dir, PARENT_TABLE[name])
        rows = source.count()
        write_bronze(bronze_rows(dealt(source, rows), name), path, rows_per_file(rows))

    return scan_bronze(spark, _once(spark, sf_dir, f"bronze-{name}", build), BRONZE[name], check)


def dealt(source: DataFrame, rows: int) -> DataFrame:
    """The same rows, in as many partitions as fill files of four fifths of the size aimed at.

    A parent row is a few bytes of its file and makes a kilobyte of documents, so splits and row groups of the input are
    far too much work for a task each. Rows go by their number in the input, whatever the keys are, and before they grow.
    """
    return source.repartition(rows * 5 // (rows_per_file(rows) * 4) + 1, F.monotonically_increasing_id())


def bronze_rows(source: DataFrame, name: str) -> DataFrame:
    columns = dict(SCALARS[name])
    for json_table in JSON_TABLES.values():
        if json_table.source == name:
            columns[json_table.column] = _document(ELEMENTS[json_table.name])
    return source.selectExpr(*[f"{columns[c]} AS `{c}`" for c in BRONZE[name].names])


def _document(elements: Elements) -> str:
    fields = ", ".join(f"'{name}', {value}" for name, value in elements.fields.items())
    numbers = f"filter(sequence(1, greatest(1, CAST({elements.size} AS INT))), i -> i <= {elements.size})"
    return f"CASE WHEN {elements.absent} THEN NULL ELSE to_json(transform({numbers}, i -> named_struct({fields}))) END"


def texts_of_numbers(lineitem: DataFrame) -> DataFrame:
    """Cells of text, some of which are not of the type that ``NUMBERS`` declares."""
    return lineitem.selectExpr(*[f"{cell} AS {name}" for name, (cell, _) in NUMBERS.items()])


def odd_documents(orders: DataFrame) -> DataFrame:
    turns = " ".join(f"WHEN {i} THEN {document}" for i, (document, _) in enumerate(ODD_DOCUMENTS))
    return orders.selectExpr("o_orderkey", f"CASE o_orderkey % {len(ODD_DOCUMENTS)} {turns} END AS document")


def csv_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of CSV files with the rows of ``movies``, ``credits``, ``documents`` or ``numbers``."""

    def build(path: str) -> None:
        if name == "documents":
            rows = spark.sql(DOCUMENT_CELLS, documents=table(spark, sf_dir, "documents"))
        elif name == "numbers":
            rows = texts_of_numbers(table(spark, sf_dir, "lineitem"))
        else:
            rows = bronze(spark, sf_dir, name)
        rows.write.option("maxRecordsPerFile", rows_per_file(rows.count())).csv(
            path, header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )

    return _once(spark, sf_dir, f"csv-{name}", build)


# --- What must come out, for DuckDB -----------------------------------------------


def movies_sql(key: str = "id") -> str:
    columns = {key if c == "id" else c: value for c, value in SCALARS["movies"].items()}
    return "SELECT " + ", ".join(f"{value} AS {c}" for c, value in columns.items()) + " FROM part"


def bronze_sql(name: str) -> str:
    """All columns of a Bronze table, the texts of its documents too."""
    columns = dict(SCALARS[name])
    for json_table in JSON_TABLES.values():
        if json_table.source == name:
            columns[json_table.column] = _document_sql(json_table)
    return "SELECT " + ", ".join(f'{columns[c]} AS "{c}"' for c in BRONZE[name].names) + f" FROM {PARENT_TABLE[name]}"


def _document_sql(json_table: JsonTable) -> str:
    """The text of a document, put together without JSON functions."""
    elements, fields = ELEMENTS[json_table.name], []
    for name, value in elements.fields.items():
        text = f"CAST({value} AS VARCHAR)"
        if json_table.element[name].dataType.simpleString() == "string":
            text = f"'\"' || replace(replace({text}, '\"', '\\\"'), chr(10), '\\n') || '\"'"
        fields.append(f"""CASE WHEN ({value}) IS NOT NULL THEN '"{name}":' || {text} END""")
    one = f"'{{' || array_to_string(list_filter([{', '.join(fields)}], lambda f: f IS NOT NULL), ',') || '}}'"
    every = f"array_to_string(list_transform(range(1, {elements.size} + 1), lambda i: {one}), ',')"
    return f"CASE WHEN NOT ({elements.absent}) THEN '[' || {every} || ']' END"


def elements_sql(name: str, fill: bool = True) -> str:
    """The rows of a JSON table, straight from the parent rows."""
    json_table, elements = JSON_TABLES[name], ELEMENTS[name]
    columns = [f"{SCALARS[json_table.source][c]} AS {out}" for c, out in json_table.parents.items()]
    for field in json_table.fields:
        value = elements.fields[field]
        if json_table.element[field].dataType.simpleString() == "int":
            value = f"TRY_CAST({value} AS INTEGER)"
        if fill and field in json_table.fill:
            value = f"COALESCE({value}, {json_table.fill[field]!r})"
        columns.append(f'{value} AS "{field}"')
    numbered = (
        f"SELECT *, UNNEST(range(1, {elements.size} + 1)) AS i "
        f"FROM {PARENT_TABLE[json_table.source]} WHERE NOT ({elements.absent})"
    )
    return f"SELECT {', '.join(columns)} FROM ({numbered})"


def documents_sql(null_words: tuple[str, ...]) -> str:
    """The documents as read back from CSV: null words are null in any column."""
    words = ", ".join("'" + w + "'" for w in null_words)
    cells = DOCUMENT_CELLS.format(documents="documents")
    return (
        f"SELECT doc_id, CASE WHEN text IN ({words}) THEN NULL ELSE text END AS text, "
        f"CASE WHEN lang IN ({words}) THEN NULL ELSE lang END AS lang, "
        f"CASE WHEN source IN ({words}) THEN NULL ELSE source END AS source, n_chars FROM ({cells})"
    )


def odd_sql(no_id: int) -> str:
    """The rows that the odd documents give."""
    found = [
        f"SELECT o_orderkey AS order_id, CAST(COALESCE({id_}, {no_id}) AS INTEGER) AS id, CAST({name} AS VARCHAR) AS name "
        f"FROM orders WHERE o_orderkey % {len(ODD_DOCUMENTS)} = {i}"
        for i, (_, rows) in enumerate(ODD_DOCUMENTS)
        for id_, name in rows
    ]
    return " UNION ALL ".join(found)


def rejects_sql() -> str:
    """The odd documents that hold text and give no rows, but for blank ones."""
    found = [
        f"SELECT o_orderkey AS order_id, '{reason}' AS reason, {ODD_DOCUMENTS[i][0]} AS document "
        f"FROM orders WHERE o_orderkey % {len(ODD_DOCUMENTS)} = {i}"
        for i, reason in ((0, "malformed"), (1, "not an array of objects"))
    ]
    return " UNION ALL ".join(found)


def losses_sql() -> str:
    lost = [
        f"SELECT '{name}' AS column_name, COUNT(*) FILTER (WHERE {lost}) AS lost, COUNT(*) AS n FROM lineitem"
        for name, (_, lost) in NUMBERS.items()
        if NUMBER_TYPES[name].dataType.simpleString() != "string"
    ]
    return " UNION ALL ".join(lost)


def row_text(columns: list[tuple[str, str]]) -> str:
    """A row as text, alike in Spark and DuckDB: doubles as whole numbers of a fixed, tiny unit, and nulls as a sign."""
    cells = []
    for name, kind in columns:
        value = f'floor("{name}" * 1048576)' if kind == "double" else f'"{name}"'
        value = f"CAST({value} AS BIGINT)" if kind == "double" else value
        cells.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    return "concat_ws('|', " + ", ".join(cells) + ")"


def digest_of(df: DataFrame, name: str) -> DataFrame:
    """Number of rows and an order-free digest: of each row's MD5 the first 32 bits, added up."""
    text = row_text(df.dtypes).replace('"', "`").replace("VARCHAR", "STRING")
    part = f"CAST(conv(substr(md5({text}), 1, 8), 16, 10) AS BIGINT)"
    return df.selectExpr(f"{part} AS part").selectExpr(
        f"'{name}' AS table_name", "count(1) AS n", "coalesce(sum(part), 0) AS digest"
    )


def counts_sql() -> str:
    """Rows of each Silver table and their digest."""
    counts = []
    schemas = {name: t.output_schema(BRONZE[t.source]) for name, t in JSON_TABLES.items()}
    for name, schema in {"movies": MOVIES_SILVER, **schemas}.items():
        text = row_text([(f.name, f.dataType.simpleString()) for f in schema])
        rows = movies_sql("movie_id") if name == "movies" else elements_sql(name)
        counts.append(
            f"SELECT '{name}' AS table_name, COUNT(*) AS n, "
            f"CAST(COALESCE(SUM(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest FROM ({rows})"
        )
    return " UNION ALL ".join(counts)
