"""CSV reading against pandas, on the same bytes, whole files and split ones."""

import gzip
import math
from itertools import product

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Observation

from silverlode.functions.text import NULL_WORDS
from silverlode.model import struct
from silverlode.session import own_session
from silverlode.sources import read_csv
from silverlode.sources.split import line_effects

PARITY = b'''id,title,js,rt,d,flag,big
1,"A, ""q""","[{""id"": 1, ""name"": ""x\\u00e9 \\""w\\"""" }]",100.0,2009-12-10,True,1
2,NA,"[]",,,False,3000000000
3,"null","line1
line2",90,2010-01-01,True,5
4,"",N/A,nan,None,False,6
5, sp ,n/a,1e2,2011-13-45,True,7
'''
PARITY_SCHEMA = struct(
    id="long", title="string", js="string", rt="double", d="string", flag="boolean", big="long"
)

whole_and_split = pytest.mark.parametrize("split_above", [1 << 40, -1], ids=["whole", "split"])


def put(tmp_path, data, name="in.csv"):
    folder = tmp_path / "landed"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pandas_rows(frame):
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    return sorted((tuple(plain(v) for v in r) for r in frame.astype(object).itertuples(index=False)), key=repr)


@whole_and_split
def test_declared_types_match_pandas(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, PARITY)
    df = read_csv(spark, path, PARITY_SCHEMA, split_above)
    assert df.dtypes == [
        ("id", "bigint"), ("title", "string"), ("js", "string"), ("rt", "double"),
        ("d", "string"), ("flag", "boolean"), ("big", "bigint"),
    ]
    assert rows(df) == pandas_rows(pd.read_csv(path + "/in.csv"))
    by_id = {r["id"]: r for r in df.collect()}
    assert [by_id[i]["title"] for i in range(1, 6)] == ['A, "q"', None, None, None, " sp "]
    assert by_id[3]["js"] == "line1\nline2"
    assert by_id[5]["d"] == "2011-13-45"


@whole_and_split
def test_found_types_match_pandas(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, PARITY)
    df = read_csv(spark, path, None, split_above)
    assert df.schema == PARITY_SCHEMA
    assert rows(df) == pandas_rows(pd.read_csv(path + "/in.csv"))


FOUND = {
    "whole": (["1", "-2", "+3"], "bigint"),
    "gaps": (["1", "", "3"], "double"),
    "points": (["1", "2.5", ".5"], "double"),
    "exponents": (["1e3", "-2E-2", "7"], "double"),
    "infinite": (["inf", "-inf", "Infinity"], "double"),
    "too large": (["1e400", "2", "3"], "string"),
    "java only": (["1d", "2", "0x1p3"], "string"),
    "all null": (["", "NA", "null"], "double"),
    "booleans": (["True", "false", "TRUE"], "boolean"),
    "boolean gaps": (["True", "", "False"], "boolean"),
    "mixed": (["1", "True", "3"], "string"),
    "dates": (["2020-01-01", "2020-01-02", "2020-01-03"], "string"),
    "past bigint": (["1", "9223372036854775808", "3"], "decimal(20,0)"),
    "past unsigned": (["1", "18446744073709551616", "3"], "string"),
    "padded": ([" 1", "2 ", " 3 "], "bigint"),
}


@pytest.mark.parametrize("case", FOUND)
def test_found_type(spark, tmp_path, case):
    cells, wanted = FOUND[case]
    data = "k,v\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells))
    path = put(tmp_path, data.encode())
    assert dict(read_csv(spark, path).dtypes)["v"] == wanted
    kind = pd.read_csv(path + "/in.csv")["v"].dtype.kind
    assert kind in {"bigint": "i", "double": "f", "boolean": "bO", "string": "O", "decimal(20,0)": "u"}[wanted]


def test_every_null_word(spark, tmp_path):
    lines = [f'{i},"{w}",x' for i, w in enumerate(NULL_WORDS)] + [f"{i + 100},{w},x" for i, w in enumerate(NULL_WORDS)]
    path = put(tmp_path, ("id,word,x\n" + "\n".join(lines) + "\n").encode())
    df = read_csv(spark, path, struct(id="long", word="string"))
    assert df.count() == 38
    assert df.where("word is not null").count() == 0
    assert pd.read_csv(path + "/in.csv")["word"].isna().all()


def test_declared_type_edges(spark, tmp_path):
    path = put(tmp_path, b"i,f,b\n90.0,1d,yes\n12.7,0x1p3,True\n3000000000, 7 ,false\nx,1e400,1\n-5.,.5,0\n")
    got = [tuple(r) for r in read_csv(spark, path, struct(i="long", f="double", b="boolean")).collect()]
    assert got == [
        (90, None, None), (None, None, True), (3000000000, 7.0, False), (None, math.inf, None), (-5, 0.5, None),
    ]


@whole_and_split
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dirty_text_never_throws(spark, tmp_path, split_above, ansi):
    path = put(tmp_path, b"i,f\nabc,def\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert rows(read_csv(spark, path, struct(i="long", f="double"), split_above)) == [(None, None)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@whole_and_split
def test_blank_lines_and_short_records(spark, tmp_path, small_splits, split_above):
    data = b'\n\nid,a,b\n\n1,"x\n\ny",2\n   \n2,short\n\t\n3,,\n4, "z",9\n,,\n'
    path = put(tmp_path, data)
    df = read_csv(spark, path, struct(id="long", a="string", b="long"), split_above)
    frame = pd.read_csv(path + "/in.csv")
    assert rows(df) == pandas_rows(frame)
    assert df.count() == len(frame) == 5
    assert df.select("b").count() == 5


@whole_and_split
def test_long_record_fails_as_in_pandas(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, b'id,a\n1,x\n2,"y,y"\n3,"z",\n')
    with pytest.raises(pd.errors.ParserError):
        pd.read_csv(path + "/in.csv")
    with pytest.raises(Exception, match="more than the 2 fields"):
        read_csv(spark, path, struct(id="long", a="string"), split_above).collect()
    with pytest.raises(Exception, match="more than the 2 fields"):
        read_csv(spark, path, struct(id="long", a="string"), split_above).select("id").collect()


@whole_and_split
@pytest.mark.parametrize(
    "end", ['2,"open,z\n3,p,q\n', '2,w,"open\n3,p,q\n4,p,q\n', '1,x,"y""\n2,w,z\n', '2,w,"', '2,"w"",z\n']
)
def test_unclosed_quote_fails_as_in_pandas(spark, tmp_path, small_splits, split_above, end):
    put(tmp_path, b'id,a,b\n1,"x\ny",z\n', "good.csv")
    path = put(tmp_path, f"id,a,b\n1,x,y\n{end}".encode(), "bad.csv")
    with pytest.raises(pd.errors.ParserError, match="EOF inside string"):
        pd.read_csv(path + "/bad.csv")
    with pytest.raises(ValueError, match="bad.csv: a quoted field is never closed"):
        read_csv(spark, path, struct(id="long", a="string"), split_above)


@whole_and_split
def test_stray_quotes_are_text(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, b'id,a,b\n1,5" disk,"x\ny"\n2,it"s,z\n3,plain,"last"\n')
    found = rows(read_csv(spark, path, struct(id="long", a="string", b="string"), split_above))
    assert found == pandas_rows(pd.read_csv(path + "/in.csv"))


@whole_and_split
def test_line_ends_may_differ(spark, tmp_path, small_splits, split_above):
    put(tmp_path, b'id,a\n1,"p\r\nq"\n2,"r\ns"\n', "one.csv")
    path = put(tmp_path, b'id,a\r\n3,"p\r\nq"\r\n4,t\n', "two.csv")
    found = rows(read_csv(spark, path, struct(id="long", a="string"), split_above))
    assert found == [(1, "p\r\nq"), (2, "r\ns"), (3, "p\r\nq"), (4, "t")]


@whole_and_split
def test_windows_line_ends(spark, tmp_path, small_splits, split_above):
    data = b'id,a,b\r\n1,"x\r\ny",2\r\n2,"p\nq",3\r\n\r\n3,"",4\r\n'
    path = put(tmp_path, data)
    got = rows(read_csv(spark, path, struct(id="long", a="string", b="long"), split_above))
    assert got == pandas_rows(pd.read_csv(path + "/in.csv"))


@whole_and_split
def test_byte_order_mark(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, b"\xef\xbb\xbfid,a\n1,x\n2,y\n")
    assert rows(read_csv(spark, path, struct(id="long", a="string"), split_above)) == [(1, "x"), (2, "y")]


@whole_and_split
def test_columns_are_taken_by_name(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, b"b,extra.col,a\n1,x,one\n2,y,two\n")
    df = read_csv(spark, path, struct(a="string", b="long"), split_above)
    assert rows(df) == [("one", 1), ("two", 2)]
    assert read_csv(spark, path, None, split_above).columns == ["b", "extra.col", "a"]
    with pytest.raises(AnalysisException):
        read_csv(spark, path, struct(a="string", missing="long"), split_above)


@whole_and_split
def test_files_with_other_headers_are_refused(spark, tmp_path, small_splits, split_above):
    put(tmp_path, b"a,b\n1,2\n", "one.csv")
    path = put(tmp_path, b"b,a\n3,4\n", "two.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, struct(a="long", b="long"), split_above).collect()


@whole_and_split
@pytest.mark.parametrize(
    "header", [",a,b", "a,a,b", 'a,a,a', '"a","b","c"', '"a, x","b ""q""",c', '"a\nx",b,c', "a,,"]
)
def test_column_names_match_pandas(spark, tmp_path, small_splits, split_above, header):
    path = put(tmp_path, f"{header}\n1,2,3\n4,5,6\n".encode())
    df = read_csv(spark, path, None, split_above)
    frame = pd.read_csv(path + "/in.csv")
    assert df.columns == list(frame.columns)
    assert rows(df) == pandas_rows(frame)


def test_file_without_names_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="no column names"):
        read_csv(spark, put(tmp_path, b""))
    with pytest.raises(ValueError, match="carriage return"):
        read_csv(spark, put(tmp_path, b"a,b\r1,2\r"))


@whole_and_split
def test_many_files(spark, tmp_path, small_splits, split_above):
    for i in range(5):
        path = put(tmp_path, f'id,a\n{i},"x\n{i}"\n{i + 10},"long, {"y" * 90}\nend"\n'.encode(), f"{i}.csv")
    got = rows(read_csv(spark, path, struct(id="long", a="string"), split_above))
    assert got == sorted(
        [(i, f"x\n{i}") for i in range(5)] + [(i + 10, f"long, {'y' * 90}\nend") for i in range(5)], key=repr
    )


def test_few_files_are_spread_over_the_cores(spark, tmp_path, monkeypatch):
    one = put(tmp_path, ("id,a\n" + "".join(f'{i % 7},"x\n"\n' for i in range(100))).encode())
    schema = struct(id="long", a="string")
    plain = read_csv(spark, one, schema, spread=True)  # too little text
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("silverlode.sources.csv.SPREAD_BYTES", 1)
    assert "Exchange" not in read_csv(spark, one, schema)._jdf.queryExecution().executedPlan().toString()
    spread = read_csv(spark, one, schema, spread=True)
    cores = spark.sparkContext.defaultParallelism
    assert spread.rdd.getNumPartitions() == (cores if cores >= 4 else 1)
    assert rows(spread) == rows(plain)
    for i in range(cores):
        put(tmp_path, b"id,a\n1,x\n", f"{i}.csv")
    assert "Exchange" not in read_csv(spark, one, schema, spread=True)._jdf.queryExecution().executedPlan().toString()


def test_large_text_takes_more_shuffle_partitions(spark, tmp_path, small_splits, monkeypatch):
    path = put(tmp_path, ("id,a\n" + "".join(f'{i},"x\n{i}"\n' for i in range(200))).encode())
    monkeypatch.setattr("silverlode.sources.split.BYTES_PER_PARTITION", 100)
    monkeypatch.setattr("silverlode.sources.split.BROADCAST_BLOCKS", 0)
    own = own_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = read_csv(own, path, struct(id="long", a="string"), -1)
    assert df.rdd.getNumPartitions() > 8
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    found = rows(df)
    assert found == sorted(((i, f"x\n{i}") for i in range(200)), key=repr)


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "nowhere"), PARITY_SCHEMA)


def test_header_only_file(spark, tmp_path):
    path = put(tmp_path, b"id,a\n")
    for above in (1 << 40, -1):
        assert read_csv(spark, path, struct(id="long", a="string"), above).count() == 0


cell = st.text(alphabet='ab", \né\'0\t', max_size=12)


@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=12), st.booleans())
@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_text_survives(spark, tmp_path_factory, small_splits, cells, crlf):
    """Written by pandas, read back whole and split: the same text as pandas reads."""
    path = tmp_path_factory.mktemp("csv") / "in.csv"
    frame = pd.DataFrame(cells, columns=["a", "b", "c"])
    frame.insert(0, "id", range(len(frame)))
    frame.to_csv(path, index=False, lineterminator="\r\n" if crlf else "\n")
    schema = struct(id="long", a="string", b="string", c="string")
    wanted = pandas_rows(pd.read_csv(path, dtype={"a": str, "b": str, "c": str}))
    for above in (1 << 40, -1):
        assert rows(read_csv(spark, str(path), schema, above)) == wanted


SOME = struct(c0="string", c1="string", c2="string", c5="string")


@given(st.lists(st.text(alphabet='a",\n', max_size=30), min_size=1, max_size=8))
@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
def test_raw_text_is_cut_alike(spark, tmp_path_factory, small_splits, parts):
    """Any bytes at all, stray quotes and open ends included: split reading finds the records whole reading finds, or both fail."""
    path = tmp_path_factory.mktemp("csv") / "in.csv"
    path.write_text(",".join(f"c{i}" for i in range(40)) + "\n" + "\n".join(parts) + "\n")

    def read(above):
        try:
            return rows(read_csv(spark, str(path), SOME, above))
        except ValueError as error:
            return str(error)

    assert read(1 << 40) == read(-1)


@whole_and_split
def test_stray_quote_hides_no_open_field(spark, tmp_path, small_splits, split_above):
    """An even number of quotes, one of them stray and one never closed."""
    path = put(tmp_path, b'id,a,b\n1,5" disk,x\n2,p,"open\n3,p,q\n4,r,s\n', "bad.csv")
    with pytest.raises(ValueError, match="bad.csv: a quoted field is never closed"):
        read_csv(spark, path, struct(id="long", a="string", b="string"), split_above)


@whole_and_split
def test_stray_quotes_lose_no_rows(spark, tmp_path, small_splits, split_above):
    path = put(tmp_path, b'id,a,b\n1,5" disk,x\n2,p,"two\nlines"\n3,6",q\n4,r,s"\n')
    got = rows(read_csv(spark, path, struct(id="long", a="string", b="string"), split_above))
    assert got == [(1, '5" disk', "x"), (2, "p", "two\nlines"), (3, '6"', "q"), (4, "r", 's"')]


@whole_and_split
@pytest.mark.parametrize("other", ["b,a,a", '"a\nx",a,b'])
def test_other_headers_with_repeated_names_are_refused(spark, tmp_path, small_splits, split_above, other):
    put(tmp_path, b"a,a,b\n1,2,3\n", "first.csv")
    path = put(tmp_path, f"{other}\n4,5,6\n".encode(), "second.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, struct(a="long", b="long"), split_above).collect()


@whole_and_split
def test_repeated_names_in_quotes_or_not_are_one_header(spark, tmp_path, small_splits, split_above):
    put(tmp_path, b"a,a,b\n1,2,3\n", "first.csv")
    path = put(tmp_path, b'"a",a,b\n4,5,6\n', "second.csv")
    assert rows(read_csv(spark, path, struct(a="long", b="long"), split_above)) == [(1, 3), (4, 6)]


def scanned(df):
    """Per scan of the plan: the kind, and the names of the files."""
    plan = df._jdf.queryExecution().optimizedPlan()
    found = {}
    for leaf in (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())):
        relation = leaf.relation()
        names = sorted(f.rsplit("/", 1)[1] for f in relation.location().inputFiles())
        found.setdefault(relation.fileFormat().toString().split("@")[0], []).append(names)
    return found


def test_each_file_is_read_in_its_own_way(spark, tmp_path):
    """One CR LF file and compressed ones leave the others on the plain path; no compressed one is split."""
    text = 'id,a\n1,x\n2,"y\nz"\n3,\n'
    put(tmp_path, text.encode(), "a b%20[1].csv")
    put(tmp_path, text.encode(), "plain.csv")
    put(tmp_path, text.replace("\n", "\r\n").encode(), "cr lf{x}.csv")
    put(tmp_path, gzip.compress(text.encode()), "plain.csv.gz")
    path = put(tmp_path, gzip.compress(text.replace("\n", "\r\n").encode()), "crlf.csv.gz")
    df = read_csv(spark, path, struct(id="long", a="string"))
    line_feeds, both = [(1, "x"), (2, "y\nz"), (3, None)], [(1, "x"), (2, "y\r\nz"), (3, None)]
    assert rows(df) == sorted(line_feeds * 3 + both * 2, key=repr)
    found = scanned(df)
    assert found["CSV"] == [["a%20b%2520%5B1%5D.csv", "plain.csv", "plain.csv.gz"], ["crlf.csv.gz"]]
    assert set(found) == {"CSV", "Parquet"}  # the staged lines of the one that is split


def test_a_large_file_alone_is_split(spark, tmp_path, small_splits):
    put(tmp_path, b"id,a\n1,x\n", "small.csv")
    put(tmp_path, b"id,a\n" + b"2,y\n" * 100, "large.csv")
    path = put(tmp_path, gzip.compress(b"id,a\n" + b"".join(b"%d,z\n" % i for i in range(3000))), "large.csv.gz")
    df = read_csv(spark, path, struct(id="long", a="string"), split_above=100)
    assert scanned(df)["CSV"] == [["large.csv.gz", "small.csv"]]
    assert df.count() == 3101


def test_short_records_of_compressed_files_lose_their_line_ends(spark, tmp_path):
    data = b'id,a,b\r\n1,"x"\r\n2\r\n\r\n3,y,\r\n4,"p\r\nq",z'
    path = put(tmp_path, gzip.compress(data), "in.csv.gz")
    found = rows(read_csv(spark, path, struct(id="long", a="string", b="string")))
    assert found == [(1, "x", None), (2, None, None), (3, "y", None), (4, "p\r\nq", "z")]


def test_columns_may_have_any_name(spark, tmp_path):
    """Also those that the reader uses for itself."""
    path = put(tmp_path, b"_record,_row,rows,_0,_RECORD_\n1,2,3,4,5\n")
    schema = struct(_record="long", _row="string", rows="long", _0="string", _RECORD_="long")
    assert rows(read_csv(spark, path, schema, spread=True)) == [(1, "2", 3, "4", 5)]
    losses = Observation()
    assert rows(read_csv(spark, path, schema, losses=losses)) == [(1, "2", 3, "4", 5)]
    assert losses.get == {"rows": 1, "lost _record": 0, "lost rows": 0, "lost _RECORD_": 0}


def test_lost_texts_are_counted(spark, tmp_path):
    path = put(tmp_path, b"id,x,f,t\n1,1.5,True,a\nzwei,,yes,NA\n3.5,1d,false,b\n4.0,nan,,c\n")
    losses = Observation()
    df = read_csv(spark, path, struct(id="long", x="double", f="boolean", t="string"), losses=losses)
    assert len(rows(df)) == 4
    assert losses.get == {"rows": 4, "lost id": 2, "lost x": 1, "lost f": 1}


def test_effects_of_all_short_lines(spark, tmp_path):
    """Against a reader of single signs, from either state."""

    def ends_open(text, state):
        for sign in text:
            if state == "in":
                state = "quote" if sign == '"' else "in"
            elif sign == '"':
                state = {"start": "in", "quote": "in"}.get(state, "plain")
            else:
                state = "start" if sign == "," else "plain"
        return state == "in"

    lines = ["".join(signs) for n in range(7) for signs in product('",a', repeat=n)]
    (tmp_path / "lines.txt").write_text("\n".join(lines) + "\n")
    found = {r["value"]: (r["opens"], r["stays"]) for r in line_effects(spark, str(tmp_path)).collect()}
    assert found == {line: (ends_open(line, "start"), ends_open(line, "in")) for line in lines}


def test_effects_of_lines_take_no_pattern(spark, tmp_path):
    """A pattern read each line of documents four times, which was most of the work of a look over CSV text."""
    plan = line_effects(spark, put(tmp_path, PARITY))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "RLIKE" not in plan
