"""Record tables derived from the star-schema parquet tables.

The medal record (17 columns) is expressed as a view over
lineitem ⋈ orders ⋈ customer ⋈ part, left-joined to nation and region. The
same expressions exist as SQL text (``ACHIEVEMENTS_SQL``) so that an external
engine can build the identical view for result checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_COLUMNS, SOURCE_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _season(orderdate: Column) -> Column:
    return F.when(F.month(orderdate).between(4, 9), F.lit("Summer")).otherwise(F.lit("Winter"))


# Which of the joined tables each record column needs besides lineitem.
_NEEDS = {"name": "c", "age": "p", "height": "p", "team": "p", "noc": "c", "games": "o", "year": "o", "season": "o",
          "city": "p", "sport": "p", "event": "p", "region": "n", "notes": "r"}
# A table is reached through others: nation through customer through orders.
_THROUGH = {"o": "o", "c": "oc", "p": "p", "n": "ocn", "r": "ocnr"}


def achievements(spark: SparkSession, sf_dir: str, with_ts: bool = False, with_keys: bool = False,
                 columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """The medal record, its 17 columns or those named; ``with_ts`` adds ``ts`` (the ship date) as
    event time, ``with_keys`` adds ``orderkey`` and ``linenumber`` of the source line item.

    Only the tables that the columns need are joined. That relies on the foreign keys of
    lineitem and orders all having their row (FIXTURES.md), so that the inner joins drop nothing.

    Join plan: the two big sides (lineitem, orders) meet in a sort-merge join on the
    order key; customer and part are equi-joined on their keys and nation / region
    are 25- and 5-row dimensions that Spark's size estimate broadcasts. No hint is
    forced on a side whose size grows with the data; AQE re-plans with runtime sizes
    and splits skewed partitions.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    needed = {t for name in columns for t in _THROUGH.get(_NEEDS.get(name, ""), "")}
    j = li
    for t, table, on, how in (("o", o, F.col("l_orderkey") == o.o_orderkey, "inner"),
                              ("c", c, F.col("o_custkey") == c.c_custkey, "inner"),
                              ("p", p, F.col("l_partkey") == p.p_partkey, "inner"),
                              ("n", n, F.col("c_nationkey") == n.n_nationkey, "left"),
                              ("r", r, F.col("n_regionkey") == r.r_regionkey, "left")):
        if t in needed:
            j = j.join(table, on, how)

    season = _season(F.col("o_orderdate"))
    cols = {
        "id": F.col("l_orderkey").cast("string"),
        "name": F.col("c_name"),
        "sex": F.when(F.col("l_linenumber") % 2 == 0, F.lit("F")).otherwise(F.lit("M")),
        "age": F.col("p_size").cast("smallint"),
        "height": F.when(F.col("p_size") > 45, F.lit(None)).otherwise(
            (F.lit(150) + F.col("p_size")).cast("smallint")).cast("smallint"),
        "weight": F.col("l_quantity").cast("float"),
        "team": F.col("p_name"),
        "noc": F.col("c_nationkey").cast("string"),
        "games": F.concat(F.year("o_orderdate").cast("string"), F.lit(" "), season),
        "year": F.when(F.col("l_orderkey") % 50 == 0, F.lit(None)).otherwise(
            F.year("o_orderdate").cast("smallint")).cast("smallint"),
        "season": season,
        "city": F.when(F.col("l_partkey") % 40 == 0, F.lit(None)).otherwise(F.col("p_brand")),
        "sport": F.col("p_type"),
        "event": F.col("p_name"),
        "medal": (F.when(F.col("l_returnflag") == "A", F.lit("Gold"))
                   .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("GOLD"))
                   .when(F.col("l_returnflag") == "R", F.lit("Silver"))),
        "region": (F.when(F.col("c_nationkey") == 24, F.lit(None).cast("string"))
                    .when(F.col("c_nationkey") == 23, F.lit(""))
                    .otherwise(F.col("n_name"))),
        "notes": F.when(F.col("r_name") == "AFRICA", F.col("r_name")),
    }
    out = [cols[name].alias(name) for name in dict.fromkeys(columns)]
    if with_ts:
        out.append(F.col("l_shipdate").alias("ts"))
    if with_keys:
        out += [F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber")]
    return j.select(*out)


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events side of the enrichment: the record without region and notes."""
    return achievements(spark, sf_dir, columns=SOURCE_COLUMNS)


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup (noc, region, notes) derived from nation ⋈ region.

    Two nations (23, 24) are left out so that their records stay unmatched, and
    nation 1 appears twice so that a duplicated key multiplies rows.
    """
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    base = (n.join(r, n.n_regionkey == r.r_regionkey, "left")
              .where(~F.col("n_nationkey").isin(23, 24)))
    main = base.select(
        F.col("n_nationkey").cast("string").alias("noc"),
        F.col("n_name").alias("region"),
        F.when(F.col("r_name") == "AFRICA", F.col("r_name")).alias("notes"))
    extra = base.where(F.col("n_nationkey") == 1).select(
        F.col("n_nationkey").cast("string").alias("noc"),
        F.concat(F.col("n_name"), F.lit(" (alt)")).alias("region"),
        F.lit("alt").alias("notes"))
    return main.unionByName(extra)


# SQL text of the same view for engines that read the parquet tables directly.
ACHIEVEMENTS_SQL = """
SELECT CAST(l.l_orderkey AS VARCHAR) AS id,
       c.c_name AS name,
       CASE WHEN l.l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
       CAST(p.p_size AS SMALLINT) AS age,
       CASE WHEN p.p_size > 45 THEN NULL ELSE CAST(150 + p.p_size AS SMALLINT) END AS height,
       CAST(l.l_quantity AS FLOAT) AS weight,
       p.p_name AS team,
       CAST(c.c_nationkey AS VARCHAR) AS noc,
       CAST(year(o.o_orderdate) AS VARCHAR) || ' ' ||
         CASE WHEN month(o.o_orderdate) BETWEEN 4 AND 9 THEN 'Summer' ELSE 'Winter' END AS games,
       CASE WHEN l.l_orderkey % 50 = 0 THEN NULL ELSE CAST(year(o.o_orderdate) AS SMALLINT) END AS year,
       CASE WHEN month(o.o_orderdate) BETWEEN 4 AND 9 THEN 'Summer' ELSE 'Winter' END AS season,
       CASE WHEN l.l_partkey % 40 = 0 THEN NULL ELSE p.p_brand END AS city,
       p.p_type AS sport,
       p.p_name AS event,
       CASE WHEN l.l_returnflag = 'A' THEN 'Gold'
            WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'GOLD'
            WHEN l.l_returnflag = 'R' THEN 'Silver' END AS medal,
       CASE WHEN c.c_nationkey = 24 THEN NULL WHEN c.c_nationkey = 23 THEN '' ELSE n.n_name END AS region,
       CASE WHEN r.r_name = 'AFRICA' THEN r.r_name END AS notes,
       l.l_shipdate AS ts,
       l.l_orderkey AS orderkey,
       l.l_linenumber AS linenumber,
       p.p_size AS psize
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

LOOKUP_SQL = """
SELECT CAST(n.n_nationkey AS VARCHAR) AS noc, n.n_name AS region,
       CASE WHEN r.r_name = 'AFRICA' THEN r.r_name END AS notes
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE n.n_nationkey NOT IN (23, 24)
UNION ALL
SELECT CAST(n.n_nationkey AS VARCHAR), n.n_name || ' (alt)', 'alt'
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE n.n_nationkey = 1
"""
