"""Sources and sinks: delimited files, text lines, payload decoding, versioned tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import local_path
from streammetrics.functions.lines import decode_payload
from streammetrics.functions.stamps import batch_folder, stamp_folder
from streammetrics.session import scratch_path
from streammetrics.sinks.writers import read_latest, write_batch_partition, write_lines
from streammetrics.sources.files import read_delimited, read_lines, read_regions


def _write(path, text):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "part-0.csv"), "w") as f:
        f.write(text)


def test_delimited_file_keeps_na_and_empty_as_text(spark):
    p = scratch_path(spark, "events-file")
    _write(p, 'ID,Name,Age\n1,"A, B",NA\n2,,\n3,"say ""hi""",24\n')
    rows = sorted(tuple(r) for r in read_delimited(spark, p).collect())
    assert rows == [("1", "A, B", "NA"), ("2", "", ""), ("3", 'say "hi"', "24")]
    assert read_delimited(spark, p).columns == ["ID", "Name", "Age"]


def test_regions_file_is_renamed_positionally(spark):
    p = scratch_path(spark, "regions-file")
    _write(p, "NOC,region,notes\nAFG,Afghanistan,\nAHO,Curacao,Netherlands Antilles\n")
    df = read_regions(spark, p)
    assert df.columns == ["noc", "region", "notes"]
    assert sorted(tuple(r) for r in df.collect()) == [("AFG", "Afghanistan", ""),
                                                     ("AHO", "Curacao", "Netherlands Antilles")]


def test_read_lines_drops_header(spark):
    p = scratch_path(spark, "lines")
    _write(p, "h1,h2\na,1\nb,2\nh1,h2\n")
    assert sorted(r.value for r in read_lines(spark, p, header="h1,h2").collect()) == ["a,1", "b,2"]


def test_write_lines_with_header_and_null_as_empty(spark):
    p = scratch_path(spark, "out-lines")
    df = spark.createDataFrame([("a", None), ("", "x")], "c1 string, c2 string")
    write_lines(df, p, ["c1", "c2"], null_as_empty=True, header=True)
    got = sorted(r.value for r in spark.read.text(p).collect())
    assert got == ['"",x', "a,", "c1,c2"]


def test_invalid_utf8_becomes_replacement_char(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff"),), (None,)], "value binary")
    got = [r[0] for r in df.select(decode_payload(F.col("value"))).collect()]
    assert got == ["ok�", None]


def test_versioned_table_reads_newest(spark):
    p = scratch_path(spark, "versions")
    write_batch_partition(spark.createDataFrame([(1,)], "v int"), p, 0)
    write_batch_partition(spark.createDataFrame([(2,), (3,)], "v int"), p, 1)
    write_batch_partition(spark.createDataFrame([(4,)], "v int"), p, 1)   # retry replaces
    assert [r.v for r in read_latest(spark, p).collect()] == [4]


def test_folder_names():
    from datetime import datetime, timezone
    assert stamp_folder(datetime(2020, 3, 4, 5, 6, 7, tzinfo=timezone.utc)) == "20200304T050607"
    assert batch_folder(7) == "000007"


def test_feed_joins_files_and_writes_parseable_lines(spark):
    from streammetrics.functions.lines import parse_lines
    from streammetrics.sources.feed import write_feed
    ev = scratch_path(spark, "feed-events")
    rg = scratch_path(spark, "feed-regions")
    head = "ID,Name,Sex,Age,Height,Weight,Team,NOC,Games,Year,Season,City,Sport,Event,Medal"
    _write(ev, head + "\n"
           '1,"A, B",M,24,180,80.5,T,AAA,1992 Summer,1992,Summer,Barcelona,S,E,Gold\n'
           "2,C,F,NA,NA,NA,T,ZZZ,1992 Summer,1992,Summer,Barcelona,S,E,NA\n")
    _write(rg, "NOC,region,notes\nAAA,Aland,\nAAA,Aland Two,x\n")
    out = write_feed(spark, ev, rg, scratch_path(spark, "feed-out"), header=True)
    recs = parse_lines(spark.read.text(out)).collect()       # header line is dropped
    got = sorted((r.id, r.name, r.age, r.weight, r.medal, r.region, r.notes) for r in recs)
    before = spark.read.text(out).count()
    assert write_feed(spark, ev, rg, out) == out           # a second run adds files
    assert spark.read.text(out).count() == 2 * before - 1  # without a header line
    assert got == [("1", "A, B", 24, 80.5, "Gold", "Aland", ""),
                   ("1", "A, B", 24, 80.5, "Gold", "Aland Two", "x"),
                   ("2", "C", None, None, None, "", "")]       # unmatched → "" after the round trip
