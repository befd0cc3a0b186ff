"""Seasonal series and hierarchies: decomposition of monthly revenue, a
seasonal forecast per category, and a category tree of any depth.

Revenue is reduced to one row per series and month first; what follows works on
months (windows and sorted arrays bounded by the calendar), so nothing grows
with the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.common import dollars, month_of, rnd
from tillroll.functions.hierarchy import closure
from tillroll.functions.sqltext import MONTH, R, oracle
from tillroll.registry import query
from tillroll.sources.bind import Tables

PERIOD = 12
#: Smoothing weights of level, trend and season, and months forecast.
ALPHA, BETA, GAMMA, AHEAD = 0.3, 0.05, 0.2, 3


def category_months(t: Tables) -> DataFrame:
    """(category, month, cents): revenue in 1e-4 units of every top category (``p_type``) in every month from its first to its last; months without sales are 0."""
    sold = (t.items.select("order_id", "product_id", "subtotal_e4")
            .join(t.valid_orders.where(F.col("order_date").isNotNull()).select("order_id", month_of("order_date").alias("month")), "order_id")
            .groupBy("product_id", "month").agg(F.sum("subtotal_e4").alias("e4")))
    top = t.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
    per = sold.join(top, "product_id").groupBy("category", "month").agg(F.sum("e4").alias("e4"))
    # one map of months a category; every month between its ends is looked up in it
    have = per.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("month", "e4"))).alias("have"))
    every = F.expr("sequence(array_min(map_keys(have)), array_max(map_keys(have)), INTERVAL 1 MONTH)")
    return (have.select("category", "have", F.explode(every).alias("month"))
            .select("category", "month", F.coalesce(F.try_element_at("have", F.col("month")), F.lit(0)).alias("e4")))


#: CTE ``series``: the same in SQL, with the month's number from 1.
SERIES = f"""per AS (
  SELECT p_type AS category, {MONTH('order_date')} AS month, CAST(SUM(subtotal_e4) AS BIGINT) AS e4
  FROM b_items JOIN b_orders USING (order_id) JOIN part ON p_partkey = product_id
  WHERE order_status <> 'Cancelled' AND order_date IS NOT NULL GROUP BY ALL),
series AS (
  SELECT category, month, COALESCE(e4, 0) AS e4, ROW_NUMBER() OVER (PARTITION BY category ORDER BY month) AS nth
  FROM (SELECT category, CAST(unnest(generate_series(MIN(month), MAX(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM per GROUP BY category)
  LEFT JOIN per USING (category, month))"""


@query("trend_decompose", oracle(f"""
SELECT s.category, s.month, CAST(s.e4 AS DOUBLE) / 1e4 AS revenue, {R('s.trend24 / 24e4')} AS trend,
       {R('(i.raw - i.mean_raw) / 24e4')} AS season,
       {R('(24 * s.e4 - s.trend24 - (i.raw - i.mean_raw)) / 24e4')} AS remainder
FROM framed s
LEFT JOIN (SELECT *, SUM(raw) OVER whole / COUNT(*) OVER whole AS mean_raw FROM monthly_distance
           WINDOW whole AS (PARTITION BY category ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) i
  ON i.category = s.category AND i.m = month(s.month)""", ctes=f"""{SERIES},
framed AS (
  SELECT a.category, a.month, a.e4, a.nth,
         CASE WHEN COUNT(b.nth) = 13 THEN SUM(CASE WHEN abs(b.nth - a.nth) = 6 THEN b.e4 ELSE 2 * b.e4 END) END AS trend24
  FROM series a JOIN series b ON b.category = a.category AND b.nth BETWEEN a.nth - 6 AND a.nth + 6 GROUP BY ALL),
monthly_distance AS (
  SELECT category, month(month) AS m, CAST(SUM(24 * e4 - trend24) AS DOUBLE) / COUNT(trend24) AS raw
  FROM framed WHERE trend24 IS NOT NULL GROUP BY ALL)"""))
def trend_decompose(t: Tables) -> DataFrame:
    """Classical additive decomposition per category: trend (mean over the twelve months around, those
    at both ends of the frame with half weight), season (mean distance from the trend per month of the
    year, their mean taken off) and remainder. The first and last half year have no trend."""
    m = category_months(t)
    line = Window.partitionBy("category").orderBy("month")
    frame = line.rowsBetween(-6, 6)
    ends = F.lag("e4", 6).over(line) + F.lead("e4", 6).over(line)
    trend24 = F.when(F.count(F.lit(1)).over(frame) == 13, 2 * F.sum("e4").over(frame) - ends)
    m = m.withColumn("trend24", trend24).withColumn("m", F.month("month"))
    # a dozen rows and a row a year in each window
    same = Window.partitionBy("category", "m")
    raw = F.sum(24 * F.col("e4") - F.col("trend24")).over(same).cast("double") / F.nullif(F.count("trend24").over(same), F.lit(0))
    m = m.withColumn("raw", raw).withColumn("first", F.row_number().over(same.orderBy("month")) == 1)
    # the indices once each, in the order of the year
    once = Window.partitionBy("category").orderBy(F.desc("first"), "m").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    index = F.when(F.col("first"), F.col("raw"))
    j = m.withColumn("season", F.col("raw") - F.sum(index).over(once) / F.count(index).over(once))
    return j.select("category", "month", dollars("e4", 4).alias("revenue"), rnd(F.col("trend24") / 24e4).alias("trend"),
                    rnd(F.col("season") / 24e4).alias("season"),
                    rnd((24 * F.col("e4") - F.col("trend24") - F.col("season")) / 24e4).alias("remainder"))


_LEVEL = f"{ALPHA}e0 * (x.revenue - f.season[1]) + {1 - ALPHA}e0 * (f.level + f.trend)"
_TREND = f"{BETA}e0 * (({_LEVEL}) - f.level) + {1 - BETA}e0 * f.trend"
_SEASON = f"{GAMMA}e0 * (x.revenue - ({_LEVEL})) + {1 - GAMMA}e0 * f.season[1]"


@query("revenue_forecast", oracle(f"""
WITH RECURSIVE money AS (SELECT category, month, nth, CAST(e4 AS DOUBLE) / 1e4 AS revenue FROM series),
began AS (SELECT category, SUM(revenue ORDER BY nth) / {PERIOD} AS level, list(revenue ORDER BY nth) AS r, MIN(month) AS first_month
          FROM money WHERE nth <= {PERIOD} GROUP BY category HAVING COUNT(*) = {PERIOD}),
f AS (
  SELECT category, {PERIOD} AS nth, level, 0e0 AS trend, list_transform(r, lambda v: v - level) AS season FROM began
  UNION ALL
  SELECT f.category, x.nth, {_LEVEL}, {_TREND}, list_append(f.season[2:], {_SEASON})
  FROM f JOIN money x ON x.category = f.category AND x.nth = f.nth + 1),
last AS (SELECT f.*, (SELECT MAX(month) FROM money m WHERE m.category = f.category) AS month FROM f
         WHERE nth = (SELECT MAX(nth) FROM money m WHERE m.category = f.category))
SELECT category, CAST(month + to_months(CAST(h AS INTEGER)) AS DATE) AS month, CAST(h AS INTEGER) AS months_ahead,
       {R('level + h * trend + season[h]')} AS forecast
FROM last, (SELECT unnest(range(1, {AHEAD + 1})) AS h)""", ctes=SERIES))
def revenue_forecast(t: Tables) -> DataFrame:
    """Revenue of the next months per category by exponential smoothing with level, trend and an additive
    season of twelve months (Holt and Winters), begun from the first year; shorter series have no forecast.

    The recursion is a fold over the category's sorted months inside the JVM."""
    m = category_months(t).select("category", "month", dollars("e4", 4).alias("revenue"))
    # one array of months a category
    s = m.groupBy("category").agg(F.sort_array(F.collect_list(F.struct("month", "revenue"))).alias("s")).where(F.size("s") >= PERIOD)
    s = s.withColumn("level0", F.expr(f"aggregate(slice(s, 1, {PERIOD}), 0D, (a, x) -> a + x.revenue) / {PERIOD}"))
    fold = F.expr(f"""aggregate(slice(s, {PERIOD + 1}, greatest(size(s) - {PERIOD}, 0)),
        named_struct('level', level0, 'trend', 0D, 'season', transform(slice(s, 1, {PERIOD}), x -> x.revenue - level0)),
        (f, x) -> named_struct('level', {_LEVEL.replace('f.season[1]', 'f.season[0]')}, 'trend', {_TREND.replace('f.season[1]', 'f.season[0]')},
                               'season', concat(slice(f.season, 2, {PERIOD - 1}), array({_SEASON.replace('f.season[1]', 'f.season[0]')}))))""")
    f = s.withColumn("f", fold).withColumn("months_ahead", F.explode(F.sequence(F.lit(1), F.lit(AHEAD))))
    return f.select("category", F.add_months(F.element_at("s", -1)["month"], F.col("months_ahead")).alias("month"), "months_ahead",
                    rnd(F.col("f.level") + F.col("months_ahead") * F.col("f.trend") + F.element_at("f.season", F.col("months_ahead"))).alias("forecast"))


# --------------------------------------------------------------------------
#: Names of the levels of the deep tree, from the root: SQL over ``part``.
DEEP = ("'All products'", "p_type", "p_type || '/' || p_brand", "p_type || '/' || p_brand || '/' || CAST(p_size % 5 AS STRING)",
        "p_type || '/' || p_brand || '/' || CAST(p_size % 5 AS STRING) || '/' || CAST(p_size AS STRING)",
        "p_type || '/' || p_brand || '/' || CAST(p_size % 5 AS STRING) || '/' || CAST(p_size AS STRING) || '/' || CAST(p_partkey % 7 AS STRING)")


def deep_tree(t: Tables) -> tuple[DataFrame, DataFrame]:
    """((node, parent), (product_id, node)): a category tree of six levels from the columns of ``part``."""
    p = t.raw("part").select("p_partkey", *[F.expr(x).alias(f"n{k}") for k, x in enumerate(DEEP)])
    steps = F.array(*[F.struct(F.col(f"n{k}").alias("node"), F.col(f"n{k - 1}").alias("parent")) for k in range(1, len(DEEP))])
    return p.select(F.explode(steps).alias("e")).select("e.*").distinct(), p.select(F.col("p_partkey").alias("product_id"), F.col(f"n{len(DEEP) - 1}").alias("node"))


_DEEP_SQL = [x.replace("AS STRING", "AS VARCHAR") for x in DEEP]


@query("category_closure_rollup", oracle(f"""
WITH RECURSIVE edges AS (
  SELECT DISTINCT * FROM ({' UNION ALL '.join(f"SELECT {_DEEP_SQL[k]} AS node, {_DEEP_SQL[k - 1]} AS parent FROM part" for k in range(1, len(DEEP)))})),
up AS (SELECT {_DEEP_SQL[-1]} AS leaf, {_DEEP_SQL[-1]} AS node, 0 AS steps FROM part GROUP BY ALL
       UNION ALL SELECT up.leaf, edges.parent, up.steps + 1 FROM up JOIN edges USING (node)),
sold AS (SELECT {_DEEP_SQL[-1]} AS leaf, SUM(quantity) AS units, SUM(subtotal) AS rev
         FROM b_items JOIN b_orders USING (order_id) JOIN part ON p_partkey = product_id WHERE order_status <> 'Cancelled' GROUP BY ALL)
SELECT node AS category, CAST(MAX(steps) AS INTEGER) AS height, CAST(COUNT(DISTINCT leaf) AS BIGINT) AS leaves,
       CAST(SUM(units) AS BIGINT) AS units_sold, CAST(SUM(rev) AS DOUBLE) AS revenue
FROM up JOIN sold USING (leaf) GROUP BY node"""))
def category_closure_rollup(t: Tables) -> DataFrame:
    """Sales of every category with all categories below it, in a tree of six levels whose depth nothing in the query states."""
    edges, at = deep_tree(t)
    sold = (t.items.join(t.valid_orders.select("order_id"), "order_id", "left_semi")
            .groupBy("product_id").agg(F.sum("quantity").alias("units"), F.sum("subtotal_e4").alias("e4")))
    leaf = sold.join(at, "product_id").groupBy("node").agg(F.sum("units").alias("units"), F.sum("e4").alias("e4"))
    above, _ = closure(edges)
    own = leaf.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("bigint").alias("steps"))
    return (own.unionByName(above).join(leaf, "node").groupBy(F.col("ancestor").alias("category"))
            .agg(F.max("steps").cast("int").alias("height"), F.count(F.lit(1)).alias("leaves"),
                 F.sum("units").cast("bigint").alias("units_sold"), dollars(F.sum("e4"), 4).alias("revenue")))
