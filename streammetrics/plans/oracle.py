"""Independent SQL statements of the checked queries (DuckDB dialect).

They read the same parquet tables (registered as views by name) and state each
result directly from its definition, without the pane / merge machinery the
Spark plans use, so agreement checks the Spark side.
"""

from __future__ import annotations

from ..schema import EVENT_COLUMNS
from ..sources.tables import ACHIEVEMENTS_SQL, LOOKUP_SQL

_ACH = f"WITH ach AS ({ACHIEVEMENTS_SQL})\n"
_COLS = ", ".join(EVENT_COLUMNS)
_VARIANT = "((orderkey * 7 + linenumber) % 20)"

_MEDALS_BY_YEAR = _ACH + """
SELECT year, CAST(COUNT(*) AS BIGINT) AS count
FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL GROUP BY year
"""

_CITIES = _ACH + """
SELECT city, CAST(COUNT(*) AS BIGINT) AS count
FROM ach WHERE city IS NOT NULL AND medal IS NOT NULL GROUP BY city
"""

_GOLD = _ACH + """
SELECT year, region, CAST(COUNT(*) AS BIGINT) AS count
FROM ach
WHERE year IS NOT NULL AND region IS NOT NULL AND medal IS NOT NULL AND lower(medal) = 'gold'
GROUP BY year, region
"""

_GOLD_PANES = _ACH + """
, p AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) AS pane, year, region, COUNT(*) AS count
  FROM ach
  WHERE year IS NOT NULL AND region IS NOT NULL AND medal IS NOT NULL AND lower(medal) = 'gold'
  GROUP BY 1, 2, 3)
SELECT year, region, CAST(count AS BIGINT) AS count, CAST(region_rank AS INTEGER) AS region_rank
FROM (SELECT year, region, count,
             ROW_NUMBER() OVER (PARTITION BY year ORDER BY count DESC, region ASC, pane ASC) AS region_rank
      FROM p) t
WHERE region_rank <= 10
"""

_MEDAL_PANES = """
, p AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) AS pane, year, COUNT(*) AS count
  FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL GROUP BY 1, 2)
"""

_ACCEPTED = _ACH + f"""
SELECT {_COLS} FROM ach WHERE {_VARIANT} > 10
"""

ORACLE_SQL: dict[str, str] = {
    "medals_by_year_window": _MEDALS_BY_YEAR,
    "medals_by_year_global": _MEDALS_BY_YEAR,
    "cities_window": _CITIES,
    "top_10_cities_global": _CITIES + "ORDER BY count DESC, city ASC LIMIT 10",
    "gold_by_year_region": _GOLD,
    "top_10_regions_per_year": f"""
SELECT year, region, count, CAST(region_rank AS INTEGER) AS region_rank
FROM (SELECT year, region, count,
             ROW_NUMBER() OVER (PARTITION BY year ORDER BY count DESC, region ASC) AS region_rank
      FROM ({_GOLD}) g) t
WHERE region_rank <= 10
""",
    "top_10_regions_per_year_unmerged": _GOLD_PANES,
    "enrich_left_join": _ACH + f"""
, lk AS ({LOOKUP_SQL})
SELECT e.id, e.name, e.sex, e.age, e.height, e.weight, e.team, e.noc, e.games, e.year,
       e.season, e.city, e.sport, e.event, e.medal, lk.region, lk.notes
FROM ach e LEFT JOIN lk ON e.noc = lk.noc
""",
    "lines_round_trip": _ACH + f"SELECT {_COLS} FROM ach",
    "lines_malformed_dropped": _ACCEPTED,
    "medals_by_year_from_lines": f"""
SELECT year, CAST(COUNT(*) AS BIGINT) AS count
FROM ({_ACCEPTED}) a WHERE year IS NOT NULL AND medal IS NOT NULL GROUP BY year
""",
    "running_totals_by_pane": _ACH + _MEDAL_PANES + """
SELECT pane, year, CAST(count AS BIGINT) AS count,
       CAST(SUM(count) OVER (PARTITION BY year ORDER BY pane
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_count
FROM p
""",
    "sliding_pane_window": _ACH + """
, w AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) + INTERVAL (i) MONTH AS window_end, year
  FROM (SELECT ts, year, unnest(range(1, 4)) AS i
        FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL) x)
SELECT CAST(window_end - INTERVAL 3 MONTH AS DATE) AS window_start,
       CAST(window_end AS DATE) AS window_end, year, CAST(COUNT(*) AS BIGINT) AS count
FROM w GROUP BY 1, 2, 3
""",
    "event_time_tumbling": _ACH + """
SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') + INTERVAL '7 days' AS window_end,
       year, CAST(COUNT(*) AS BIGINT) AS count
FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL GROUP BY 1, 2, 3
""",
    "event_time_sliding": _ACH + """
, w AS (
  SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') - j * INTERVAL '7 days' AS window_start,
         year
  FROM (SELECT ts, year, unnest(range(0, 2)) AS j
        FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL) x)
SELECT window_start, window_start + INTERVAL '14 days' AS window_end, year,
       CAST(COUNT(*) AS BIGINT) AS count
FROM w GROUP BY 1, 2, 3
""",
    "stamped_output": f"""
SELECT year, count, TIMESTAMP '2020-01-01 12:00:00' AS timestamp FROM ({_MEDALS_BY_YEAR}) m
""",
}

ORACLE_SQL["top_regions_from_files"] = _ACH + f"""
, lk AS ({LOOKUP_SQL})
, g AS (
  SELECT e.year, coalesce(lk.region, '') AS region, COUNT(*) AS count
  FROM ach e LEFT JOIN lk ON e.noc = lk.noc
  WHERE e.year IS NOT NULL AND e.medal IS NOT NULL AND lower(e.medal) = 'gold'
  GROUP BY 1, 2)
SELECT year, region, CAST(count AS BIGINT) AS count, CAST(region_rank AS INTEGER) AS region_rank
FROM (SELECT year, region, count,
             ROW_NUMBER() OVER (PARTITION BY year ORDER BY count DESC, region ASC) AS region_rank
      FROM g) t
WHERE region_rank <= 10
"""

# The streaming job over the message lines must end with the same totals as
# one batch over the accepted lines.
ORACLE_SQL["stream_medals_by_year"] = ORACLE_SQL["medals_by_year_from_lines"]
ORACLE_SQL["stream_top_cities"] = f"""
SELECT city, CAST(COUNT(*) AS BIGINT) AS count
FROM ({_ACCEPTED}) a WHERE city IS NOT NULL AND medal IS NOT NULL GROUP BY city
ORDER BY count DESC, city ASC LIMIT 10
"""
ORACLE_SQL["stream_batch_counts"] = _ACH + f"""
SELECT CAST(orderkey % 4 AS BIGINT) AS batch_id, CAST(COUNT(*) AS BIGINT) AS lines,
       CAST(COUNT(*) FILTER (WHERE {_VARIANT} > 10) AS BIGINT) AS records
FROM ach GROUP BY 1
"""
ORACLE_SQL["stream_sliding_window"] = _ACH + f"""
SELECT CAST(b AS BIGINT) AS batch_id, year, CAST(COUNT(*) AS BIGINT) AS count
FROM ach JOIN (SELECT unnest(range(0, 4)) AS b) w ON orderkey % 4 IN (b - 1, b)
WHERE {_VARIANT} > 10 AND year IS NOT NULL AND medal IS NOT NULL GROUP BY 1, 2
"""
ORACLE_SQL["stream_from_feed"] = ORACLE_SQL["top_regions_from_files"]
ORACLE_SQL["stream_top_regions"] = f"""
SELECT year, region, count, CAST(region_rank AS INTEGER) AS region_rank
FROM (SELECT year, region, count,
             ROW_NUMBER() OVER (PARTITION BY year ORDER BY count DESC, region ASC) AS region_rank
      FROM (SELECT year, region, CAST(COUNT(*) AS BIGINT) AS count
            FROM ({_ACCEPTED}) a
            WHERE year IS NOT NULL AND region IS NOT NULL AND medal IS NOT NULL
              AND lower(medal) = 'gold'
            GROUP BY year, region) g) t
WHERE region_rank <= 10
"""

# Windows of two slides: their cities with the batch's stamp, and the gold medals as dumped.
ORACLE_SQL["stream_window_stamps"] = _ACH + f"""
SELECT CAST(epoch_us(TIMESTAMP '2024-01-01 00:00:00') + b * 10000000 AS BIGINT) AS stamp, city, CAST(COUNT(*) AS BIGINT) AS count
FROM ach JOIN (SELECT unnest(range(0, 4)) AS b) w ON orderkey % 4 IN (b - 1, b)
WHERE {_VARIANT} > 10 AND city IS NOT NULL AND medal IS NOT NULL GROUP BY 1, 2
"""
ORACLE_SQL["stream_dumps"] = _ACH + f"""
SELECT CAST(b AS BIGINT) AS batch_id, year, region, CAST(COUNT(*) AS BIGINT) AS count
FROM ach JOIN (SELECT unnest(range(0, 4)) AS b) w ON orderkey % 4 IN (b - 1, b)
WHERE {_VARIANT} > 10 AND year IS NOT NULL AND region IS NOT NULL AND medal IS NOT NULL AND lower(medal) = 'gold'
GROUP BY 1, 2, 3
"""
# Parts 0 to 3 come in slides 0, 1, 4 and 5; a slide's window is the last three slides, if they hold anything.
ORACLE_SQL["stream_idle_windows"] = _ACH + f"""
SELECT CAST(t AS BIGINT) AS slide, year, CAST(COUNT(*) AS BIGINT) AS count
FROM (SELECT *, orderkey % 4 + CASE WHEN orderkey % 4 >= 2 THEN 2 ELSE 0 END AS s FROM ach) a
JOIN (SELECT unnest(range(0, 8)) AS t) w ON s BETWEEN t - 2 AND t
WHERE {_VARIANT} > 10 AND year IS NOT NULL AND medal IS NOT NULL GROUP BY 1, 2
"""
ORACLE_SQL["stream_catalog_global"] = ORACLE_SQL["medals_by_year_from_lines"]
ORACLE_SQL["stream_ages_by_year"] = f"""
SELECT year, CAST(COUNT(age) AS BIGINT) AS aged, MIN(age) AS youngest, MAX(age) AS oldest,
       CAST(SUM(age) AS BIGINT) AS years_of_age, CAST(SUM(age) AS DOUBLE) / COUNT(age) AS mean_age
FROM ({_ACCEPTED}) a WHERE year IS NOT NULL AND medal IS NOT NULL GROUP BY year
"""
ORACLE_SQL["stream_distinct_athletes"] = f"""
SELECT city, CAST(COUNT(*) AS BIGINT) AS count, CAST(COUNT(DISTINCT id) AS BIGINT) AS athletes, true AS close
FROM ({_ACCEPTED}) a WHERE city IS NOT NULL AND medal IS NOT NULL GROUP BY city
"""
# A byte behind a closing quote (variant 15 quotes all fields) makes the line malformed.
ORACLE_SQL["stream_binary_messages"] = _ACH + f"""
SELECT id, year, city,
       CASE WHEN orderkey % 13 = 0 THEN coalesce(notes, 'NA') || chr(65533) ELSE notes END AS notes
FROM ach WHERE {_VARIANT} > 10 AND orderkey % 50 <> 0 AND NOT ({_VARIANT} = 15 AND orderkey % 13 = 0)
"""

# Files 0 to 3 arrive in turn; before each, the watermark is the greatest day of the files before less the delay.
ORACLE_SQL["stream_late_rows"] = _ACH + """
, r AS (
  SELECT year, CAST(ts AS DATE) - DATE '1970-01-01' AS day,
         CAST(least(3, floor((CAST(ts AS DATE) - DATE '1970-01-01' - 9132) / 600.0)
                       + CASE WHEN orderkey % 7 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS part
  FROM ach WHERE year IS NOT NULL AND medal IS NOT NULL),
f AS (SELECT part, max(day) AS newest FROM r GROUP BY part),
m AS (SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30 AS mark FROM f),
e AS (SELECT max(newest) - 30 AS mark FROM f),
p AS (
  SELECT r.year, CAST(floor(r.day / 7.0) * 7 AS INTEGER) AS pane,
         coalesce(floor(r.day / 7.0) * 7 + 7 <= m.mark, false) AS late
  FROM r JOIN m ON m.part = r.part),
w AS (
  SELECT year, pane - 7 * i AS s FROM p JOIN (SELECT unnest(range(0, 2)) AS i) x ON true WHERE NOT late)
SELECT CASE WHEN s + 14 <= mark THEN 'closed' ELSE 'open' END AS kind,
       CAST(DATE '1970-01-01' + CAST(s AS INTEGER) AS DATE) AS start, year, CAST(COUNT(*) AS BIGINT) AS count
FROM w, e GROUP BY 1, 2, 3
UNION ALL
SELECT 'late' AS kind, CAST(DATE '1970-01-01' + pane AS DATE) AS start, year, CAST(COUNT(*) AS BIGINT) AS count
FROM p WHERE late GROUP BY 1, 2, 3
"""
