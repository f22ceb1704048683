"""The medal metrics as mergeable aggregate states.

Every metric is ``filter → groupBy(keys).agg(states)`` on a window of records (the *partial*),
``groupBy(keys).agg(merged states)`` over any union of partials (the *merge*), the *results* of the
states, and a *finish* step on the merged totals (identity, top-k, top-k per group, a ratio of
two results). A state is a count unless the metric says otherwise; sums, least and greatest values
and distinct-count sketches merge just as well. Because partials merge, the same metric serves a
single window, a sliding window over panes, and running totals over all panes,
and each record is taken once.

Scale notes: the partial is a hash aggregate with map-side combine (an object-hash one for sketches), so a
key that holds a third of all records still leaves one row per key per task before the
shuffle. The merge input is bounded by (#panes × #keys), not by records; a sketch has a fixed size. The
per-group ranking runs on aggregated rows and Spark adds a partial
``WindowGroupLimit`` before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNT = "count"


@dataclass(frozen=True)
class State:
    """A mergeable aggregate: ``partial`` over the records for which a condition holds, ``merge`` over
    partials (associative and commutative), ``result`` of a merged state."""
    name: str
    partial: Callable[[Column], Column]
    merge: Callable[[Column], Column]
    result: Callable[[Column], Column] = field(default=lambda state: state)


def count_state(name: str = COUNT, where: Callable[[], Column] | None = None) -> State:
    """Number of records, or of those that also meet ``where``."""
    return State(name, lambda kept: F.count_if(kept & where() if where else kept),
                 lambda state: F.sum(state).cast("bigint"))


def sum_state(name: str, column: str) -> State:
    """Sum of an integral or decimal column (a float's sum would depend on the order)."""
    return State(name, lambda kept: F.sum(F.when(kept, F.col(column))), lambda state: F.sum(state))


def min_state(name: str, column: str) -> State:
    return State(name, lambda kept: F.min(F.when(kept, F.col(column))), F.min)


def max_state(name: str, column: str) -> State:
    return State(name, lambda kept: F.max(F.when(kept, F.col(column))), F.max)


#: Buckets of a distinct-count sketch, as a power of two: a relative standard error of 0.8 %, at most 16 KB a state.
SKETCH_BITS = 14


def distinct_state(name: str, column: str, bits: int = SKETCH_BITS) -> State:
    """Estimated number of distinct non-null values (a HyperLogLog sketch)."""
    return State(name, lambda kept: F.hll_sketch_agg(F.when(kept, F.col(column)), bits),
                 F.hll_union_agg, lambda state: F.hll_sketch_estimate(state))


COUNT_STATE = count_state()


@dataclass(frozen=True)
class Metric:
    """A named metric.

    ``predicate`` builds the record filter, ``states`` are what it aggregates, ``order`` the (deterministic)
    output order of the per-window result, ``finish`` turns merged totals into the
    global result.
    """
    id: str
    keys: tuple[str, ...]
    predicate: Callable[[], Column]
    order: Callable[[], list[Column]] = field(default=lambda: [])
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)
    states: tuple[State, ...] = (COUNT_STATE,)

    def partial(self, records: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
        """Per-window states: ``extra_keys`` (e.g. pane columns) + keys → one column for each state."""
        return (records.where(self.predicate())
                .groupBy(*extra_keys, *self.keys)
                .agg(*[s.partial(F.lit(True)).alias(s.name) for s in self.states]))

    def results(self, partials: DataFrame) -> DataFrame:
        """States → results; other columns stay."""
        done = {s.name: s.result(F.col(s.name)).alias(s.name) for s in self.states}
        return partials.select(*[done.get(c, F.col(c)) for c in partials.columns])

    def local(self, records: DataFrame) -> DataFrame:
        """The per-window output: results of the partial in the metric's output order."""
        out = self.results(self.partial(records))
        order = self.order()
        return out.orderBy(*order) if order else out

    def merge(self, partials: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
        """Merged states by key, under the same names."""
        return (partials.groupBy(*extra_keys, *self.keys)
                .agg(*[s.merge(F.col(s.name)).alias(s.name) for s in self.states]))

    def global_result(self, partials: DataFrame) -> DataFrame:
        return self.finish(self.results(self.merge(partials)))


GROUPING = "_grouping"


def _grouping_ids(metrics: Sequence[Metric]) -> tuple[list[str], dict[str, int]]:
    cols: list[str] = []
    for m in metrics:
        cols += [k for k in m.keys if k not in cols]
    n = len(cols)
    gid = {m.id: sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in m.keys)
           for m in metrics}
    return cols, gid


def _state_columns(metrics: Sequence[Metric]) -> list[tuple[str, Metric, State]]:
    """(column, metric, state) of the combined form; each metric has its count, which tells groups it kept nothing in."""
    return [(f"{s.name}_{m.id}", m, s) for m in metrics
            for s in (COUNT_STATE, *[s for s in m.states if s.name != COUNT])]


ROWS = "_rows"
VALID = "_valid"


def combined_partials(records: DataFrame, metrics: Sequence[Metric],
                      valid: Column | None = None) -> DataFrame:
    """All metrics' partial states in one aggregation (GROUPING SETS).

    Each record is read once and aggregated by the union of all keys; only that smaller
    result is rolled up to the grouping sets, which are the metrics' key sets. Each metric
    takes only the records its predicate keeps (and, when given, only rows where ``valid``
    is true). The result holds, per grouping set, the
    keys and ``<state>_<id>`` columns of every metric — use ``split_partial`` to take
    out one metric's partial — plus ``_rows`` / ``_valid`` row counts.
    """
    cols, _ = _grouping_ids(metrics)
    unique = list(dict.fromkeys(tuple(m.keys) for m in metrics))
    sets = [[F.col(k) for k in keys] for keys in unique]
    ok = F.lit(True) if valid is None else valid
    if valid is not None:
        # Keys of invalid rows are meaningless: fold them into the null keys so
        # that malformed input can't create groups.
        records = records.withColumns({c: F.when(valid, F.col(c)) for c in cols})
    states = _state_columns(metrics)
    kept = {m.id: ok & F.coalesce(m.predicate(), F.lit(False)) for m in metrics}
    counted = records.groupBy(*cols).agg(*[s.partial(kept[m.id]).alias(name) for name, m, s in states],
                                         F.count(F.lit(1)).alias(ROWS), F.count_if(ok).alias(VALID))
    return (counted.groupingSets(sets, *cols)
            .agg(F.grouping_id(*cols).alias(GROUPING), *_merged(states)))


def _merged(states: Sequence[tuple[str, Metric, State]]) -> list[Column]:
    return [*[s.merge(F.col(name)).alias(name) for name, _, s in states],
            *[F.sum(name).cast("bigint").alias(name) for name in (ROWS, VALID)]]


def row_counts(combined: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """(rows, valid) of the input of ``combined_partials`` — from one grouping set."""
    _, gid = _grouping_ids(metrics)
    return (combined.where(F.col(GROUPING) == gid[metrics[0].id])
            .agg(F.coalesce(F.sum(ROWS), F.lit(0)).cast("bigint").alias("rows"),
                 F.coalesce(F.sum(VALID), F.lit(0)).cast("bigint").alias("valid")))


def merge_combined(combined: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Merge any union of ``combined_partials`` results, set by set."""
    cols, _ = _grouping_ids(metrics)
    return combined.groupBy(GROUPING, *cols).agg(*_merged(_state_columns(metrics)))


def nonzero(combined: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Drop groups in which no metric kept a record (they add nothing to a merge)."""
    cond = None
    for m in metrics:
        c = F.coalesce(F.col(f"{COUNT}_{m.id}"), F.lit(0)) > 0
        cond = c if cond is None else cond | c
    return combined.where(cond)


def split_partial(combined: DataFrame, metrics: Sequence[Metric], metric: Metric) -> DataFrame:
    """One metric's partial (keys…, states…) from ``combined_partials``."""
    _, gid = _grouping_ids(metrics)
    c = F.col(f"{COUNT}_{metric.id}")
    return (combined.where((F.col(GROUPING) == gid[metric.id]) & (c > 0))
            .select(*metric.keys, *[F.col(f"{s.name}_{metric.id}").alias(s.name) for s in metric.states]))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Global top-k (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: list[Column], k: int,
                    rank_col: str) -> DataFrame:
    """ROW_NUMBER per group with a total order, cut at k (planned with WindowGroupLimit)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("int"))
              .where(F.col(rank_col) <= k))


# --- predicates ---------------------------------------------------------------

def has_year() -> Column:
    return F.col("year").isNotNull()


def has_medal() -> Column:
    return F.col("medal").isNotNull()


def has_city() -> Column:
    # Empty strings pass; only null is excluded.
    return F.col("city").isNotNull()


def has_region() -> Column:
    # An unmatched lookup encoded as "" passes and forms its own group.
    return F.col("region").isNotNull()


def is_gold() -> Column:
    return F.lower(F.col("medal")) == F.lit("gold")


# --- the registry -------------------------------------------------------------

TOP_N = 10
REGION_RANK = "region_rank"

MEDALS_BY_YEAR = Metric(
    id="medals_by_year",
    keys=("year",),
    predicate=lambda: has_year() & has_medal(),
)

TOP_10_CITIES = Metric(
    id="top_10_cities",
    keys=("city",),
    predicate=lambda: has_city() & has_medal(),
    order=lambda: [F.desc(COUNT), F.asc("city")],
    finish=lambda df: top_k(df, TOP_N, [F.desc(COUNT), F.asc("city")]),
)

TOP_10_COUNTRIES_PER_YEAR = Metric(
    id="top_10_countries_per_year",
    keys=("year", "region"),
    predicate=lambda: has_year() & has_region() & has_medal() & is_gold(),
    finish=lambda df: top_k_per_group(df, ["year"], [F.desc(COUNT), F.asc("region")],
                                      TOP_N, REGION_RANK),
)

METRICS: tuple[Metric, ...] = (MEDALS_BY_YEAR, TOP_10_CITIES, TOP_10_COUNTRIES_PER_YEAR)

# Metrics of other states than one count; a job takes them through its ``metrics`` setting.

AGES_BY_YEAR = Metric(
    id="ages_by_year",
    keys=("year",),
    predicate=lambda: has_year() & has_medal(),
    states=(count_state("aged", lambda: F.col("age").isNotNull()), min_state("youngest", "age"),
            max_state("oldest", "age"), sum_state("years_of_age", "age")),
    finish=lambda df: df.withColumn("mean_age", F.col("years_of_age") / F.col("aged")),
)

ATHLETES_BY_CITY = Metric(
    id="athletes_by_city",
    keys=("city",),
    predicate=lambda: has_city() & has_medal(),
    states=(COUNT_STATE, distinct_state("athletes", "id")),
)

EXTRA_METRICS: tuple[Metric, ...] = (AGES_BY_YEAR, ATHLETES_BY_CITY)


def by_id(metric_id: str) -> Metric:
    for m in (*METRICS, *EXTRA_METRICS):
        if m.id == metric_id:
            return m
    raise KeyError(metric_id)


def top_regions_unmerged(partials: DataFrame, pane_col: str) -> DataFrame:
    """Literal form of the third global metric: rank the union of per-window
    partials without merging them, so a region may hold several places with
    counts from different windows. Ties break by region, then pane."""
    return top_k_per_group(partials.select("year", "region", COUNT, pane_col), ["year"],
                           [F.desc(COUNT), F.asc("region"), F.asc(pane_col)],
                           TOP_N, REGION_RANK).drop(pane_col)
