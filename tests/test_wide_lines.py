"""Structure checks of wide schemas: the scan agrees with the pattern and holds at any width."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammetrics.functions.lines import (MAX_FIELDS, encode_lines, parse_lines, structure_pattern, structure_scan,
                                           well_formed)

ODD_LINES = ["", '"', '""', '"""', '""""', '"a', 'a"', '"a"b', '"a""b"', '"a"""', '"a""""', 'a""b', ",", ",,", '"",""', '"a,b"',
             '"a,b', 'a,"b', '"a"",b"', '"a"",b', '"a" ,b', ' "a",b', '"a\n","b"', '"é,",x', '"""",""","', '","', '",",']


@pytest.mark.parametrize("delimiter,quote", [(",", '"'), (";", "'"), ("|", '"'), (".", "^"), ("\t", "x")])
def test_scan_equals_pattern(spark, delimiter, quote):
    rng = random.Random(3)
    alphabet = [delimiter, delimiter, quote, quote, quote, "a", "é", " ", "\\", "\n"]
    lines = [line.replace(",", delimiter).replace('"', quote) for line in ODD_LINES]
    lines += ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    for n in (1, 2, 3, 5):
        value = F.col("value")
        wrong = df.where(value.rlike(structure_pattern(n, delimiter, quote)) != structure_scan(value, n, delimiter, quote))
        assert [r[0] for r in wrong.collect()] == []


def test_null_lines_are_not_well_formed(spark):
    df = spark.createDataFrame([(None,), ("a,b",)], "value string")
    assert [tuple(r) for r in df.select(well_formed(F.col("value"), 2), well_formed(F.col("value"), 5000)).collect()] == [
        (False, False), (True, False)]
    with pytest.raises(ValueError):
        structure_scan(F.col("value"), 3, ",", ",")


def _lines(n):
    """line → whether it has n fields in a sound structure"""
    plain = [str(i) for i in range(n)]

    def line(at=None, value=None):
        return ",".join(value if i == at else v for i, v in enumerate(plain))

    return {line(): True, line(3, '"a,b"'): True, line(n - 1, '"c""d"'): True, line(5, ""): True, line(9, '"a"b'): False,
            line(n - 2, '"open'): False, line() + ",": False, line().rsplit(",", 1)[0]: False, "," * (n - 1): True,
            "," * 25_000: False, "": False, line(n - 1, '"' + "x" * 100_000 + '"'): True}


@pytest.mark.parametrize("n", [501, 5000, 20_000])
def test_structure_of_very_wide_lines(spark, n):
    cases = _lines(n)
    df = spark.createDataFrame(list(cases.items()), "value string, want boolean").repartition(1)
    assert df.where(well_formed(F.col("value"), n) != F.col("want")).count() == 0


WIDE = 520


def test_fields_beyond_the_pattern_pass_the_verdict_table(spark):
    names = [f"f{i}" for i in range(WIDE)]
    schema = T.StructType([T.StructField(n, T.IntegerType() if i % 100 == 7 else T.StringType()) for i, n in enumerate(names)])
    plain = [str(i) for i in range(WIDE)]

    def line(**changes):
        return ",".join(changes.get(n, v) for n, v in zip(names, plain))

    cases = {
        line(): {},
        line(f3='"a,b"', f519='"c""d"'): {"f3": "a,b", "f519": 'c"d'},
        line(f10="NA", f207="NA"): {"f10": None, "f207": None},
        line(f5=""): {"f5": ""},
        line(f107="x"): None,                               # not a number
        line(f407=""): None,                                # empty number
        line(f9='"a"b'): None,                              # text after a closing quote
        line(f518='"open'): None,                           # unterminated
        line() + ",": None,                                 # one field too many
        line().rsplit(",", 1)[0]: None,                     # one too few
        "," * 25_000: None,
        "": None,
    }
    df = spark.createDataFrame([(k, v) for k, v in enumerate(cases)], "k int, value string").repartition(1)
    some = ["f0", "f3", "f519", "f10", "f207", "f5", "f107", "f407"]
    got = {tuple(r) for r in parse_lines(df.select("value"), schema).select(*some).collect()}
    want = set()
    for changed in cases.values():
        if changed is not None:
            base = {n: (int(n[1:]) if int(n[1:]) % 100 == 7 else n[1:]) for n in some}
            want.add(tuple({**base, **changed}[n] for n in some))
    assert got == want


def test_encode_then_parse_just_above_the_pattern(spark):
    n = MAX_FIELDS + 1
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(n)])
    rng = random.Random(1)
    rows = [tuple(rng.choice(['a,"b', "", None, '"', "x\\", "é,"]) for _ in range(n)) for _ in range(20)]
    df = spark.createDataFrame(rows, schema)
    back = parse_lines(encode_lines(df), schema, mode="FAILFAST").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))
