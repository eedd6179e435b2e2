"""JSON arrays to rows: edge cases, random documents, and the plan."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from silverlode import BRONZE, JSON_TABLES, JsonTable, core_movies, fill_defaults, normalize, silver_tables, struct
from silverlode.testing import fixtures

GENRE = JSON_TABLES["genre"]

# Document -> the (id, name) rows it gives, with id -9999 for a missing one.
EDGES = {
    "null": (None, []),
    "empty": ("", []),
    "blank": ("   ", []),
    "json null": ("null", []),
    "empty array": ("[]", []),
    "truncated": ('[{"id":1,"name":"a"}', []),
    "truncated later": ('[{"id":1,"name":"a"},{"id":2,"na', []),
    "scalars": ("[1,2]", []),
    "object": ('{"id":1,"name":"a"}', [(1, "a")]),
    "bad int": ('[{"id":"x","name":"a"},{"id":2,"name":"b"}]', [(-9999, "a"), (2, "b")]),
    "int as text": ('[{"id":"12","name":"a"}]', [(-9999, "a")]),
    "float": ('[{"id":1.0,"name":"a"}]', [(-9999, "a")]),
    "overflow": ('[{"id":3000000000,"name":"a"}]', [(-9999, "a")]),
    "NaN": ('[{"id":NaN,"name":"a"}]', [(-9999, "a")]),
    "missing key": ('[{"name":"a"}]', [(-9999, "a")]),
    "extra key": ('[{"id":1,"z":2,"name":"a"}]', [(1, "a")]),
    "null element": ('[null,{"id":1}]', [(-9999, None), (1, None)]),
    "key case": ('[{"ID":1,"Name":"a"}]', [(-9999, None)]),
    "single quotes": ("[{'id': 1, 'name': 'a'}]", [(1, "a")]),
    "number for string": ('[{"id":1,"name":5}]', [(1, "5")]),
    "object for string": ('[{"id":1,"name":{"q":1}}]', [(1, '{"q":1}')]),
    "duplicate key": ('[{"id":1,"id":2,"name":"a"}]', [(2, "a")]),
    "escapes": (r'[{"id":1,"name":"a\"bé"}]', [(1, 'a"bé')]),
    "trailing junk": ('[{"id":1,"name":"a"}] x', [(1, "a")]),
}


def nulls_last(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_edge_cases(spark, ansi):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(EDGES.values())], "id long, genres string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = [tuple(r) for r in normalize(df, GENRE).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    for i, (case, (_, wanted)) in enumerate(EDGES.items()):
        assert nulls_last(r[1:] for r in found if r[0] == i) == nulls_last(wanted), case


def test_same_rows_as_explode_of_the_whole_element_type(spark):
    """Parsing the kept fields alone gives what parsing and exploding every declared field gives."""
    crew = JSON_TABLES["crew"]
    documents = [
        '[{"department":"d","credit_id":"c","gender":1,"id":5,"name":"n","job":"j"}]',
        '[{"gender":"text","id":5},{"gender":[1,{"a":2}],"id":6},{"gender":3000000000,"name":"x"}]',
        '[{"gender":{"id":9},"id":7,"name":"n"}, null, {}]',
        '[{"gender":1,"id":5,"name":"n"',
        '[{"id":5,"gender":}]',
        '[{"gender":tru,"id":5}]',
        "[]",
        None,
    ]
    data = [(i, "t", d) for i, d in enumerate(documents)]
    df = spark.createDataFrame(data, "movie_id long, title string, crew string")
    item = F.explode(F.from_json("crew", ArrayType(crew.element)))
    exploded = df.select("movie_id", "title", item.alias("item")).select(
        "movie_id", "title", *[F.col(f"item.{f}") for f in crew.fields]
    )
    wanted = exploded.fillna(crew.fill)
    assert nulls_last(map(tuple, normalize(df, crew).collect())) == nulls_last(map(tuple, wanted.collect()))
    assert wanted.columns == normalize(df, crew).columns


value = st.one_of(
    st.none(), st.integers(-(2**33), 2**33), st.floats(allow_nan=False), st.text(max_size=5), st.booleans(),
    st.lists(st.integers(0, 3), max_size=2),
)
element = st.one_of(
    st.none(),
    st.fixed_dictionaries({}, optional={"id": value, "name": st.text(max_size=8), "gender": value, "extra": value}),
)


@given(st.lists(st.lists(element, max_size=6), min_size=1, max_size=20))
@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_elements(spark, arrays):
    """One row per element, in any order, with the fields as written."""
    whole = struct(gender="integer", id="integer", name="string")
    table = JsonTable("t", "s", "doc", whole, {"k": "k"}, ("id", "name"))
    df = spark.createDataFrame([(i, json.dumps(a)) for i, a in enumerate(arrays)], "k long, doc string")

    def kept(e):
        n = (e or {}).get("id")
        fits = isinstance(n, int) and not isinstance(n, bool) and -(2**31) <= n < 2**31
        return (n if fits else None, (e or {}).get("name"))

    wanted = [(i, *kept(e)) for i, a in enumerate(arrays) for e in a]
    assert nulls_last(map(tuple, normalize(df, table).collect())) == nulls_last(wanted)


def test_duplicate_parents_give_duplicate_rows(spark):
    df = spark.createDataFrame([(1, '[{"id":1,"name":"a"}]')] * 3, "id long, genres string")
    assert [tuple(r) for r in normalize(df, GENRE).collect()] == [(1, 1, "a")] * 3


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, None, None), (1, "x", "y")], "id int, code string, other string")
    filled = fill_defaults(df, {"id": -9999, "code": "XX"})
    assert nulls_last(map(tuple, filled.collect())) == nulls_last([(-9999, "XX", None), (1, "x", "y")])
    assert fill_defaults(df, {}) is df
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        fill_defaults(df, {"missing": 1}).collect()


def test_core_movies_keeps_names_order_and_types(spark):
    core = core_movies(spark.createDataFrame([], BRONZE["movies"]))
    assert core.columns == [
        "movie_id", "title", "budget", "homepage", "original_language", "original_title", "overview", "popularity",
        "release_date", "revenue", "runtime", "status", "tagline", "vote_average", "vote_count",
    ]


@pytest.mark.parametrize(
    "name, columns",
    {
        "crew": "movie_id bigint, title string, id int, name string, department string, job string, credit_id string",
        "cast": "movie_id bigint, title string, cast_id int, character string, credit_id string, gender int, id int, "
        "name string",
        "genre": "movie_id bigint, id int, name string",
        "keywords": "movie_id bigint, id int, name string",
        "production_companies": "movie_id bigint, id int, name string",
        "production_countries": "movie_id bigint, iso_3166_1 string, name string",
        "spoken_languages": "movie_id bigint, iso_639_1 string, name string",
    }.items(),
)
def test_silver_columns(spark, name, columns):
    bronze = {source: spark.createDataFrame([], schema) for source, schema in BRONZE.items()}
    df, schema = silver_tables(bronze)[name]
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == columns
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_table_definitions_are_checked():
    element = struct(id="integer", name="string")
    with pytest.raises(ValueError, match="repeat"):
        JsonTable("t", "s", "c", element, {"id": "id"}, ("id", "name"))
    with pytest.raises(ValueError, match="not in the element"):
        JsonTable("t", "s", "c", element, {"id": "key"}, ("other",))
    with pytest.raises(ValueError, match="fill"):
        JsonTable("t", "s", "c", element, {"id": "key"}, ("id",), {"name": "x"})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [*JSON_TABLES, "movies"])
def test_plans_are_map_only_parse_once_and_read_few_columns(spark, sf_dir, name):
    bronze = {source: fixtures.bronze(spark, sf_dir, source) for source in BRONZE}
    text = plan(silver_tables(bronze)[name][0])
    assert "Exchange" not in text and "Python" not in text and "UDF" not in text
    if name == "movies":
        assert "genres" not in text
        return
    table = JSON_TABLES[name]
    assert text.count("from_json(") == 1
    wanted = {*table.parents, table.column}
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == wanted


def test_a_filter_on_the_parent_key_reaches_the_scan(spark, sf_dir):
    df = normalize(fixtures.bronze(spark, sf_dir, "movies"), GENRE).where("movie_id = 3")
    assert "EqualTo(id,3)" in plan(df)


def test_round_trip_of_grouped_rows(spark, sf_dir):
    """Arrays gathered from the lines of an order unnest back to those lines, text intact."""
    lines = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    fields = ("l_linenumber", "l_returnflag", "l_partkey")
    parents = lines.groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(*fields))).alias("doc"))
    table = JsonTable(
        "lines", "orders", "doc", struct(l_linenumber="integer", l_returnflag="string", l_partkey="long"),
        {"l_orderkey": "l_orderkey"}, fields,
    )
    found = normalize(parents, table)
    wanted = lines.select("l_orderkey", *fields)
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0

    talks = spark.read.parquet(os.path.join(sf_dir, "conversations.parquet"))
    grouped = talks.groupBy("conv_id").agg(F.to_json(F.collect_list(F.struct("turn", "role", "text"))).alias("doc"))
    table = JsonTable(
        "turns", "talks", "doc", struct(turn="long", role="string", text="string"),
        {"conv_id": "conv_id"}, ("turn", "role", "text"),
    )
    found = normalize(grouped, table)
    assert found.exceptAll(talks).count() == 0 and talks.exceptAll(found).count() == 0
