"""Metrics, panes, windows and enrichment on the fixture tables (sf0.001)."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL
from streammetrics.operators import eventtime, panes
from streammetrics.operators.enrich import enrich
from streammetrics.operators.metrics import (MEDALS_BY_YEAR, METRICS, TOP_10_CITIES,
                                             TOP_10_COUNTRIES_PER_YEAR, by_id, top_regions_unmerged)
from streammetrics.sources.tables import achievements, region_lookup, source_events


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_registry_ids():
    assert [m.id for m in METRICS] == ["medals_by_year", "top_10_cities", "top_10_countries_per_year"]
    assert by_id("top_10_cities") is TOP_10_CITIES


def test_merged_panes_equal_one_aggregate(spark):
    recs = achievements(spark, SMALL, with_ts=True)
    for m in METRICS:
        parts = panes.pane_partials(recs, m, panes.month_pane(F.col("ts")))
        assert rows(m.merge(parts)) == rows(m.partial(recs.drop("ts"))), m.id


def test_local_city_list_is_sorted_by_count_then_city(spark):
    out = [tuple(r) for r in TOP_10_CITIES.local(achievements(spark, SMALL)).collect()]
    assert out == sorted(out, key=lambda r: (-r[1], r[0]))
    assert len(out) > 10


def test_top_regions_rank_is_dense_and_tie_broken(spark):
    recs = achievements(spark, SMALL)
    res = TOP_10_COUNTRIES_PER_YEAR.global_result(TOP_10_COUNTRIES_PER_YEAR.partial(recs)).collect()
    by_year = {}
    for r in res:
        by_year.setdefault(r.year, []).append(r)
    for year, rs in by_year.items():
        rs.sort(key=lambda r: r.region_rank)
        assert [r.region_rank for r in rs] == list(range(1, len(rs) + 1))
        assert [(-r["count"], r.region) for r in rs] == sorted((-r["count"], r.region) for r in rs)
        assert len(rs) <= 10
    # "" (unmatched lookup) is a region of its own; null regions are not counted
    local = TOP_10_COUNTRIES_PER_YEAR.local(recs).collect()
    assert any(r.region == "" for r in local)
    assert all(r.region is not None for r in local)


def test_unmerged_form_can_repeat_a_region(spark):
    recs = achievements(spark, SMALL, with_ts=True)
    parts = panes.pane_partials(recs, TOP_10_COUNTRIES_PER_YEAR, panes.month_pane(F.col("ts")))
    res = top_regions_unmerged(parts, panes.PANE).collect()
    pairs = [(r.year, r.region) for r in res]
    assert len(pairs) > len(set(pairs))     # same region several times from different panes


def test_running_totals_end_at_the_global_counts(spark):
    recs = achievements(spark, SMALL, with_ts=True)
    parts = panes.pane_partials(recs, MEDALS_BY_YEAR, panes.month_pane(F.col("ts")))
    rt = panes.running_totals(parts, MEDALS_BY_YEAR)
    last = rt.groupBy("year").agg(F.max_by("running_count", "pane").alias("count"))
    assert rows(last) == rows(MEDALS_BY_YEAR.partial(recs))


def test_sliding_from_panes_equals_direct_sliding_window(spark):
    recs = achievements(spark, SMALL, with_ts=True)
    mine = eventtime.sliding_counts(recs, MEDALS_BY_YEAR, "ts", "14 days", "7 days")
    w = F.window("ts", "14 days", "7 days")
    direct = (recs.where(MEDALS_BY_YEAR.predicate()).groupBy(w.alias("w"), "year").count()
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "year", "count"))
    assert rows(mine) == rows(direct)


def test_enrich_keeps_unmatched_and_multiplies_duplicates(spark):
    ev = source_events(spark, SMALL)
    out = enrich(ev, region_lookup(spark, SMALL))
    assert out.columns == list(ev.columns) + ["region", "notes"]
    n_dup = ev.where(F.col("noc") == "1").count()
    assert out.count() == ev.count() + n_dup
    assert out.where(F.col("noc").isin("23", "24")).where(F.col("region").isNotNull()).count() == 0


def test_enrich_leaves_the_join_to_spark(spark):
    events, lookup = source_events(spark, SMALL), region_lookup(spark, SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = [tuple(r) for r in enrich(events, lookup).collect()]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = enrich(events, lookup)
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
        assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_grouping_sets_partials_equal_separate_partials(spark):
    from dataclasses import replace
    from streammetrics.operators.metrics import combined_partials, merge_combined, split_partial
    recs = achievements(spark, SMALL)
    twin = replace(MEDALS_BY_YEAR, id="gold_by_year",
                   predicate=lambda: F.col("year").isNotNull() & (F.lower("medal") == "gold"))
    metrics = (*METRICS, twin)                 # two metrics share the key set (year)
    combined = combined_partials(recs, metrics)
    for m in metrics:
        assert rows(split_partial(combined, metrics, m)) == rows(m.partial(recs)), m.id
    doubled = merge_combined(combined.unionByName(combined), metrics)
    for m in metrics:
        want = m.partial(recs).select(*m.keys, (F.col("count") * 2).alias("count"))
        assert rows(split_partial(doubled, metrics, m)) == rows(want), m.id


def test_malformed_lines_create_no_groups(spark):
    from streammetrics.functions.lines import OK, encode_lines, flag_lines
    from streammetrics.operators.metrics import combined_partials, nonzero
    recs = achievements(spark, SMALL)
    good = encode_lines(recs)
    # garbage lines with many distinct "city" values in the right position but broken ages
    bad = encode_lines(recs.withColumn("age", F.lit(None)).withColumn(
        "city", F.concat(F.lit("junk-"), F.col("id")))).select(
        F.regexp_replace("value", ",NA,", ",x,").alias("value"))
    flagged = flag_lines(good.unionByName(bad))
    combined = combined_partials(flagged, METRICS, valid=F.col(OK))
    cities = {r.city for r in nonzero(combined, METRICS).collect() if r.city is not None}
    assert not any(c.startswith("junk-") for c in cities)
    clean = combined_partials(flag_lines(good), METRICS, valid=F.col(OK))
    assert nonzero(combined, METRICS).count() == nonzero(clean, METRICS).count()
