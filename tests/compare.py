"""Compare a Spark result with a DuckDB one as bags of rows."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def assert_same(df, con, sql):
    wanted = con.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(wanted.columns)
    types = dict(zip(wanted.columns, map(str, wanted.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    wanted_rows = wanted.select(*[duckdb.ColumnExpression(c) for c in names]).fetchall()
    found_rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    assert len(found_rows) == len(wanted_rows)
    assert sorted(found_rows, key=repr) == sorted(wanted_rows, key=repr)
    return len(found_rows)
