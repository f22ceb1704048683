"""Line parser: verdict table, modes, options and encode/parse round trip."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from streammetrics.functions.lines import encode_lines, malformed_lines, parse_lines, structure_pattern
from streammetrics.schema import EVENT_SCHEMA

SCHEMA = T.StructType([
    T.StructField("a", T.StringType()), T.StructField("b", T.ShortType()),
    T.StructField("c", T.FloatType()), T.StructField("d", T.StringType()),
    T.StructField("e", T.LongType()),
])

LONG = "q" * 20000
INF = float("inf")

# line → expected record, or None when the line is malformed
CASES = [
    ("x,1,1.5,y,2", ("x", 1, 1.5, "y", 2)),
    (",1,1.5,,2", ("", 1, 1.5, "", 2)),                 # empty plain field is ""
    ('"",1,1.5,"",2', ("", 1, 1.5, "", 2)),
    ("NA,NA,NA,NA,NA", (None, None, None, None, None)),
    ('"NA",1,1,"NA",1', (None, 1, 1.0, None, 1)),       # quoted null token is null too
    ("NAx,1,1,na,1", ("NAx", 1, 1.0, "na", 1)),         # only the exact token
    ("x,,1.5,y,2", None),                               # empty integer
    ("x,1,,y,2", None),                                 # empty float
    ("x,1,1.5,y", None),                                # too few fields
    ("x,1,1.5,y,2,", None),                             # trailing delimiter = extra field
    ('"a"b,1,1,y,2', None),                             # text after closing quote
    ('"unterminated,1,1,y,2', None),
    ("", None),                                         # blank line
    ("a,b,age,d,e", None),                              # header-like line
    ('"a,b",1,1,"c""d",2', ("a,b", 1, 1.0, 'c"d', 2)),
    ('a"b,1,1,y,2', ('a"b', 1, 1.0, "y", 2)),           # quote inside a plain field
    ('x""y,1,1,y,2', ('x""y', 1, 1.0, "y", 2)),         # plain field taken literally
    ("a\\b,1,1,#y,2", ("a\\b", 1, 1.0, "#y", 2)),       # no backslash escape, no comments
    ("x,+12,1e3,y,-5", ("x", 12, 1000.0, "y", -5)),
    ("x,007,1,y,2", ("x", 7, 1.0, "y", 2)),
    ("x, 12,1,y,2", None),                              # blank in an integer
    ("x,12 ,1,y,2", None),
    ("x,12.0,1,y,2", None),
    ("x,99999,1,y,2", None),                            # smallint overflow
    ("x,1,NaN,y,2", ("x", 1, float("nan"), "y", 2)),
    ("x,1,Infinity,y,2", ("x", 1, INF, "y", 2)),
    ("x,1,-Infinity,y,2", ("x", 1, -INF, "y", 2)),
    ("x,1,inf,y,2", None),                              # Java spelling only
    ("x,1,nan,y,2", None),
    ("x,1,INFINITY,y,2", None),
    ("x,1, 1.0 ,y,2", ("x", 1, 1.0, "y", 2)),           # floats may be padded
    ("x,1,1f,y,2", ("x", 1, 1.0, "y", 2)),
    ("x,1,2D,y,2", ("x", 1, 2.0, "y", 2)),
    ("x,1,0x1p3,y,2", ("x", 1, 8.0, "y", 2)),
    ("x,1,.5,y,2", ("x", 1, 0.5, "y", 2)),
    ("x,1,5.,y,2", ("x", 1, 5.0, "y", 2)),
    ("x,1,abc,y,2", None),
    (" x ,1,1,y,2", (" x ", 1, 1.0, "y", 2)),           # no trimming of strings
    (' "q",1,1,y,2', (' "q"', 1, 1.0, "y", 2)),         # blank before quote: plain field
    ("x,1,1,y,9223372036854775807", ("x", 1, 1.0, "y", 9223372036854775807)),
    ("x,1,1,y,9223372036854775808", None),
    ('x,"1",1,y,"2"', ("x", 1, 1.0, "y", 2)),           # quoted numbers
    (f'"{LONG}",1,1,y,2', (LONG, 1, 1.0, "y", 2)),      # long quoted field
    ('""",1,1,y,2', None),                              # escaped quote, never closed
    ('"""",1,1,y,2', ('"', 1, 1.0, "y", 2)),
    ('"a""",1,1,y,2', ('a"', 1, 1.0, "y", 2)),
    ('"",1,1,y,""', None),                              # "" for a long is empty → malformed
]


def _same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b


def _lines(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")


def test_verdict_table(spark):
    df = _lines(spark, [c[0] for c in CASES])
    rows = parse_lines(df, SCHEMA).collect()
    kept = {tuple(r) for r in rows}
    bad_lines = {r.value for r in malformed_lines(df, SCHEMA).collect()}
    for line, expected in CASES:
        if expected is None:
            assert line in bad_lines, f"should be malformed: {line[:60]!r}"
        else:
            assert line not in bad_lines, f"should be accepted: {line[:60]!r}"
            assert any(all(_same(x, y) for x, y in zip(row, expected)) for row in kept), line[:60]
    assert len(rows) == sum(1 for _, e in CASES if e is not None)


def test_trailing_delimiter_is_an_empty_field(spark):
    sch = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = parse_lines(_lines(spark, ["x,", ",", '"",""']), sch).collect()
    assert sorted(tuple(r) for r in rows) == [("", ""), ("", ""), ("x", "")]


def test_failfast_raises_with_the_line(spark):
    df = _lines(spark, ["x,1,1.5,y,2", "broken"])
    with pytest.raises(Exception, match="Malformed line: <broken>"):
        parse_lines(df, SCHEMA, mode="failfast").count()
    assert parse_lines(_lines(spark, ["x,1,1.5,y,2"]), SCHEMA, mode="FailFast").count() == 1


def test_failfast_raises_even_when_no_field_is_used(spark):
    df = _lines(spark, ["broken"])
    with pytest.raises(Exception, match="Malformed line"):
        parse_lines(df, SCHEMA, mode="FAILFAST").select().collect()


def test_unknown_mode_and_type_are_refused_eagerly(spark):
    df = _lines(spark, ["x"])
    with pytest.raises(ValueError, match="Unknown parse mode"):
        parse_lines(df, SCHEMA, mode="PERMISSIVE")
    bad = T.StructType([T.StructField("d", T.DateType())])
    with pytest.raises(ValueError, match="Unsupported type: date"):
        parse_lines(df, bad)


def test_custom_delimiter_quote_and_null(spark):
    sch = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
                        T.StructField("c", T.StringType())])
    df = _lines(spark, ["'x;y';1;-", "a;-;b", "'a'b;1;c", "a;1"])
    rows = sorted(tuple(r) for r in parse_lines(df, sch, delimiter=";", quote="'", null_value="-").collect())
    assert rows == [("a", None, "b"), ("x;y", 1, None)]


def test_tab_delimiter_and_non_ascii_text(spark):
    sch = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    df = _lines(spark, ["Zürich\t1", '"東京\tx"\t2', "a,b\t3", "bad\t4\t5"])
    rows = sorted(tuple(r) for r in parse_lines(df, sch, delimiter="\t").collect())
    assert rows == [("Zürich", 1), ("a,b", 3), ("東京\tx", 2)]


def test_pattern_is_possessive():
    p = structure_pattern(3)
    assert "*+" in p and "++" in p and p.startswith("\\A") and p.endswith("\\z")


_text = st.text(alphabet=st.sampled_from(list('ab ,"\\#NA;\'x')), max_size=12).filter(lambda s: s != "NA")
_row = st.tuples(_text, st.one_of(st.none(), st.integers(-32768, 32767)),
                 st.one_of(st.none(), st.floats(width=32, allow_nan=False)),
                 st.one_of(st.none(), _text), st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, min_size=1, max_size=40))
def test_encode_then_parse_is_identity(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    back = parse_lines(encode_lines(df), SCHEMA, mode="FAILFAST").collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, back), key=key) == sorted(map(tuple, df.collect()), key=key)


def test_event_schema_round_trip_with_nulls_and_empty_strings(spark):
    row = ("1", "n, \"q\"", "", None, 160, 1.5, "t", "7", "2000 Summer", 2000, "Summer",
           "", "s", "e", "Gold", "", None)
    df = spark.createDataFrame([row], EVENT_SCHEMA)
    back = parse_lines(encode_lines(df), mode="FAILFAST").collect()
    assert [tuple(r) for r in back] == [row]


def test_null_as_empty_encoding_reads_back_as_empty_strings(spark):
    row = ("1", "n", "M", 20, None, 1.0, "t", "7", "g", 2000, "s", "c", "sp", "e", "Gold", None, None)
    df = spark.createDataFrame([row], EVENT_SCHEMA)
    line = encode_lines(df, null_as_empty=True).first()[0]
    assert line.endswith(",,")
    # height null → empty numeric → malformed, as in the feed's encoding
    assert parse_lines(encode_lines(df, null_as_empty=True)).count() == 0


@pytest.mark.parametrize("kind, bits", [(T.ShortType(), 15), (T.IntegerType(), 31), (T.LongType(), 63)])
def test_integers_at_the_bounds_of_their_type(spark, kind, bits):
    schema = T.StructType([T.StructField("n", kind)])
    top = 1 << bits
    good = {"0": 0, "-0": 0, "+7": 7, "007": 7, "-" + "0" * 40 + "12": -12, str(top - 1): top - 1, str(-top): -top,
            "+" + "0" * 25 + str(top - 1): top - 1}
    bad = [str(top), str(-top - 1), "9" * 20, "9" * 400, "x1", "1x", "1.0", " 1", "1 ", "+", "-", "+-1", "", "1e3", "١"]
    lines = spark.createDataFrame([(x,) for x in [*good, *bad]], "value string")
    assert sorted(r.n for r in parse_lines(lines, schema).collect()) == sorted(good.values())


def test_lines_are_split_with_room_for_their_fields_only(spark):
    # The splitter touches all its columns on each line, and a cast that fails costs more than the rest of a line.
    schema = T.StructType([T.StructField("n", T.ShortType()), T.StructField("s", T.StringType())])
    frame = parse_lines(spark.createDataFrame([("x",)], "value string"), schema)
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert "20480" not in plan
    casts = plan.split("try_cast(")[1:]
    assert casts and all(c.startswith("CASE WHEN RLIKE(") or "RLIKE(" in c[:c.index(" as bigint")] for c in casts)
