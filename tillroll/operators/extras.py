"""Analyses the reference advertises without shipping SQL for them:
year-over-year, attribution models, funnel, A/B split, budget allocation,
seasonality, trend, category roll-up, warehouse turnover, delivery-time
percentiles, review sentiment bands, ranking functions, join variants, and
revenue by region and channel.

All follow the library's rules: aggregate first, windows only over bounded
groups (months, years, distinct day counts), exact integer money.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.common import count_if, dollars, month_of, pct, ratio, rnd
from tillroll.functions.sqltext import MONEY, MONTH, PCT, R, TS_AGO, oracle
from tillroll.operators.marketing import orders_per_campaign
from tillroll.registry import query
from tillroll.sources.bind import Tables


def _monthly(t: Tables) -> DataFrame:
    return (t.valid_orders.groupBy(month_of("order_date").alias("month"))
            .agg(F.count("order_id").alias("orders"), F.sum("total_cents").alias("_rev")))


# --------------------------------------------------------------------------
@query("revenue_yoy", oracle(f"""
SELECT m.month, m.revenue, p.revenue AS prev_year_revenue,
       {R("(m.revenue - p.revenue) / NULLIF(p.revenue, 0e0) * 100e0")} AS yoy_growth_pct
FROM m LEFT JOIN m p ON p.month = CAST(m.month - INTERVAL 12 MONTH AS DATE)
ORDER BY m.month DESC""", ctes=f"""
m AS (SELECT {MONTH('order_date')} AS month, {MONEY('total_amount')} AS revenue
      FROM b_orders WHERE order_status != 'Cancelled' GROUP BY 1)"""))
def revenue_yoy(t: Tables) -> DataFrame:
    """Monthly revenue against the same month one year earlier."""
    m = _monthly(t).select("month", dollars("_rev").alias("revenue"))
    prev = m.select(F.add_months("month", 12).alias("month"), F.col("revenue").alias("prev_year_revenue"))
    return (m.join(prev, "month", "left")
            .select("month", "revenue", "prev_year_revenue",
                    rnd((F.col("revenue") - F.col("prev_year_revenue"))
                        / F.nullif(F.col("prev_year_revenue"), F.lit(0.0)) * 100.0).alias("yoy_growth_pct"))
            .orderBy(F.col("month").desc()))


# --------------------------------------------------------------------------
# Attribution models. The bound interactions (2024) all follow the bound
# orders (1995-2001), so "touches before each order" would be empty; the
# models here are customer-level: a customer's non-cancelled spend is
# credited to the first touch, the last touch, or split evenly over touches.
def _touches(t: Tables) -> DataFrame:
    key = F.struct("interaction_date", "attribution_id")
    return (t.interactions.groupBy("customer_id")
            .agg(F.min_by("campaign_id", key).alias("first_campaign"),
                 F.max_by("campaign_id", key).alias("last_campaign"),
                 F.count(F.lit(1)).alias("touches")))


def _spend(t: Tables) -> DataFrame:
    return t.valid_orders.groupBy("customer_id").agg(F.sum("total_cents").alias("spend"))


def _touch_model(t: Tables, col: str) -> DataFrame:
    j = _touches(t).join(_spend(t), "customer_id")
    per = (j.groupBy(F.col(col).alias("campaign_id"))
           .agg(F.count(F.lit(1)).alias("customers"), F.sum("spend").alias("_rev")))
    return (per.join(t.campaigns.select("campaign_id", "campaign_name"), "campaign_id")
            .select("campaign_id", "campaign_name", "customers", dollars("_rev").alias("attributed_revenue")))


def _touch_sql(fn: str) -> str:
    return oracle(f"""
SELECT mc.campaign_id, mc.campaign_name, COUNT(*) AS customers, {MONEY('s.spend')} AS attributed_revenue
FROM (SELECT customer_id, {fn}(campaign_id, (interaction_date, attribution_id)) AS cid
      FROM b_interactions GROUP BY customer_id) tc
JOIN (SELECT customer_id, SUM(total_amount) AS spend FROM b_orders
      WHERE order_status != 'Cancelled' GROUP BY customer_id) s ON s.customer_id = tc.customer_id
JOIN b_campaigns mc ON mc.campaign_id = tc.cid
GROUP BY mc.campaign_id, mc.campaign_name""")


@query("attribution_first_touch", _touch_sql("arg_min"))
def attribution_first_touch(t: Tables) -> DataFrame:
    return _touch_model(t, "first_campaign")


@query("attribution_last_touch", _touch_sql("arg_max"))
def attribution_last_touch(t: Tables) -> DataFrame:
    return _touch_model(t, "last_campaign")


@query("attribution_linear", oracle(f"""
SELECT mc.campaign_id, mc.campaign_name, COUNT(*) AS customers,
       {R('CAST(SUM((CAST(s.spend * 100 AS HUGEINT) * pc.n * 1000000) // tc.n) AS DOUBLE) / 1e8')} AS attributed_revenue
FROM (SELECT customer_id, campaign_id, COUNT(*) AS n FROM b_interactions GROUP BY 1, 2) pc
JOIN (SELECT customer_id, COUNT(*) AS n FROM b_interactions GROUP BY 1) tc ON tc.customer_id = pc.customer_id
JOIN (SELECT customer_id, SUM(total_amount) AS spend FROM b_orders
      WHERE order_status != 'Cancelled' GROUP BY customer_id) s ON s.customer_id = pc.customer_id
JOIN b_campaigns mc ON mc.campaign_id = pc.campaign_id
GROUP BY mc.campaign_id, mc.campaign_name"""))
def attribution_linear(t: Tables) -> DataFrame:
    """Spend split evenly over a customer's touches (rounded to cents).

    Each share is kept in whole millionths of a cent, so that the sum does not
    depend on the order of the rows."""
    pc = t.interactions.groupBy("customer_id", "campaign_id").agg(F.count(F.lit(1)).alias("n"))
    tc = t.interactions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("tn"))
    j = pc.join(tc, "customer_id").join(_spend(t), "customer_id")
    per = (j.groupBy("campaign_id")
           .agg(F.count(F.lit(1)).alias("customers"),
                F.sum(F.expr("CAST((CAST(spend AS DECIMAL(20,0)) * n * 1000000) div tn AS DECIMAL(38,0))")).alias("_share")))
    return (per.join(t.campaigns.select("campaign_id", "campaign_name"), "campaign_id")
            .select("campaign_id", "campaign_name", "customers", rnd(dollars("_share", 8)).alias("attributed_revenue")))


# --------------------------------------------------------------------------
@query("funnel", oracle(f"""
WITH v AS (SELECT user_id, MIN(ts) AS t FROM events WHERE event_type = 'view' GROUP BY user_id),
c AS (SELECT e.user_id, MIN(e.ts) AS t FROM events e JOIN v ON v.user_id = e.user_id
      WHERE e.event_type = 'click' AND e.ts > v.t GROUP BY e.user_id),
p AS (SELECT e.user_id FROM events e JOIN c ON c.user_id = e.user_id
      WHERE e.event_type = 'purchase' AND e.ts > c.t GROUP BY e.user_id),
s AS (SELECT 1 AS step, 'view' AS stage, COUNT(*) AS users FROM v
      UNION ALL SELECT 2, 'click', COUNT(*) FROM c
      UNION ALL SELECT 3, 'purchase', COUNT(*) FROM p)
SELECT step, stage, users,
       {R(PCT('users', 'LAG(users) OVER (ORDER BY step)'))} AS conversion_from_previous_pct
FROM s"""))
def funnel(t: Tables) -> DataFrame:
    """Users reaching view -> click (after their first view) -> purchase
    (after that click), from the event stream. Each stage is a per-user
    aggregate joined to the next stage's events."""
    ev = t.raw("events").select("user_id", "event_type", "ts")
    v = ev.where(F.col("event_type") == "view").groupBy("user_id").agg(F.min("ts").alias("tv"))
    c = (ev.where(F.col("event_type") == "click").join(v, "user_id").where(F.col("ts") > F.col("tv"))
         .groupBy("user_id").agg(F.min("ts").alias("tc")))
    p = (ev.where(F.col("event_type") == "purchase").join(c, "user_id").where(F.col("ts") > F.col("tc"))
         .select("user_id").distinct())
    stages = (v.agg(F.lit(1).alias("step"), F.lit("view").alias("stage"), F.count(F.lit(1)).alias("users"))
              .unionByName(c.agg(F.lit(2).alias("step"), F.lit("click").alias("stage"),
                                 F.count(F.lit(1)).alias("users")))
              .unionByName(p.agg(F.lit(3).alias("step"), F.lit("purchase").alias("stage"),
                                 F.count(F.lit(1)).alias("users"))))
    w = Window.orderBy("step")  # three rows
    return stages.select("step", "stage", "users",
                         rnd(pct(F.col("users"), F.lag("users").over(w))).alias("conversion_from_previous_pct"))


# --------------------------------------------------------------------------
@query("ab_test", oracle(f"""
WITH u AS (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS grp,
                  MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS conv
           FROM events GROUP BY user_id),
g AS (SELECT grp, COUNT(*) AS users, SUM(conv) AS converters FROM u GROUP BY grp),
z AS (SELECT (MAX(CASE WHEN grp = 'B' THEN converters END) * 1e0 / MAX(CASE WHEN grp = 'B' THEN users END)
              - MAX(CASE WHEN grp = 'A' THEN converters END) * 1e0 / MAX(CASE WHEN grp = 'A' THEN users END))
             / NULLIF(SQRT((SUM(converters) * 1e0 / SUM(users)) * (1 - SUM(converters) * 1e0 / SUM(users))
                    * (1e0 / MAX(CASE WHEN grp = 'A' THEN users END) + 1e0 / MAX(CASE WHEN grp = 'B' THEN users END))), 0e0)
             AS zz FROM g)
SELECT grp AS test_group, users, CAST(converters AS BIGINT) AS converters,
       {R(PCT('converters', 'users'))} AS conversion_rate_pct, {R('zz', 4)} AS z_score
FROM g, z"""))
def ab_test(t: Tables) -> DataFrame:
    """Two-proportion z-test of purchase conversion between users split by
    id parity (group A even, B odd), from per-user flags."""
    u = (t.raw("events").groupBy("user_id")
         .agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("conv"))
         .withColumn("grp", F.when(F.col("user_id") % 2 == 0, "A").otherwise("B")))
    g = u.groupBy("grp").agg(F.count(F.lit(1)).alias("users"), F.sum("conv").alias("converters"))
    both = Window.partitionBy()   # the two group rows
    side = lambda k, c: F.max(F.when(F.col("grp") == k, F.col(c))).over(both)
    pa = side("A", "converters") * 1.0 / side("A", "users")
    pb = side("B", "converters") * 1.0 / side("B", "users")
    pool = F.sum("converters").over(both) * 1.0 / F.sum("users").over(both)
    se = F.sqrt(pool * (1 - pool) * (1.0 / side("A", "users") + 1.0 / side("B", "users")))
    z = (pb - pa) / F.nullif(se, F.lit(0.0))   # NULL when every (or no) user converts
    return g.select(F.col("grp").alias("test_group"), "users",
                    F.col("converters").cast("bigint").alias("converters"),
                    rnd(pct("converters", "users")).alias("conversion_rate_pct"), rnd(z, 4).alias("z_score"))


# --------------------------------------------------------------------------
@query("budget_recommendation", oracle(f"""
WITH r AS (SELECT mc.campaign_id, mc.campaign_name, mc.budget,
                  CAST(COALESCE(SUM(o.total_amount), 0) AS DOUBLE) / NULLIF(CAST(mc.budget AS DOUBLE), 0e0) AS roas
           FROM b_campaigns mc LEFT JOIN b_orders o ON mc.campaign_id = o.campaign_id
             AND o.order_status != 'Cancelled'
           GROUP BY mc.campaign_id, mc.campaign_name, mc.budget)
SELECT campaign_id, campaign_name, CAST(budget AS DOUBLE) AS current_budget, {R('roas', 4)} AS roas,
       {R('CAST(SUM(budget) OVER () AS DOUBLE) * roas / SUM(roas) OVER ()')} AS recommended_budget
FROM r"""))
def budget_recommendation(t: Tables) -> DataFrame:
    """Re-split the total budget across campaigns in proportion to ROAS."""
    j = t.campaigns.join(orders_per_campaign(t), "campaign_id", "left")
    roas = ratio(dollars(F.coalesce(F.col("s_ord"), F.lit(0))), dollars("budget_cents"))
    w = Window.partitionBy()  # ten campaigns
    r = j.select("campaign_id", "campaign_name", "budget_cents", roas.alias("_roas"))
    return r.select("campaign_id", "campaign_name", dollars("budget_cents").alias("current_budget"),
                    rnd("_roas", 4).alias("roas"),
                    rnd(dollars(F.sum("budget_cents").over(w)) * F.col("_roas") / F.sum("_roas").over(w))
                    .alias("recommended_budget"))


# --------------------------------------------------------------------------
@query("seasonality_month", oracle(f"""
SELECT CAST(month(order_date) AS INT) AS month_of_year, COUNT(*) AS orders,
       {MONEY('total_amount')} AS revenue,
       {R(PCT('SUM(total_amount)', 'SUM(SUM(total_amount)) OVER ()'))} AS revenue_share_pct
FROM b_orders WHERE order_status != 'Cancelled' GROUP BY 1 ORDER BY 1"""))
def seasonality_month(t: Tables) -> DataFrame:
    m = (t.valid_orders.groupBy(F.month("order_date").cast("int").alias("month_of_year"))
         .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_cents").alias("_rev")))
    return (m.select("month_of_year", "orders", dollars("_rev").alias("revenue"),
                     rnd(pct(dollars("_rev"), dollars(F.sum("_rev").over(Window.partitionBy()))))
                     .alias("revenue_share_pct"))
            .orderBy("month_of_year"))


@query("seasonality_weekday", oracle(f"""
SELECT CAST(isodow(order_date) AS INT) AS iso_weekday, dayname(order_date) AS day_name,
       COUNT(*) AS orders, {MONEY('total_amount')} AS revenue
FROM b_orders WHERE order_status != 'Cancelled' GROUP BY 1, 2 ORDER BY 1"""))
def seasonality_weekday(t: Tables) -> DataFrame:
    iso = ((F.dayofweek("order_date") + 5) % 7 + 1).cast("int")   # Monday = 1
    return (t.valid_orders.groupBy(iso.alias("iso_weekday"), F.date_format("order_date", "EEEE").alias("day_name"))
            .agg(F.count(F.lit(1)).alias("orders"), money_sum("total_cents"))
            .orderBy("iso_weekday"))


def money_sum(c: str, name: str = "revenue"):
    return dollars(F.sum(c)).alias(name)


# --------------------------------------------------------------------------
@query("revenue_trend_forecast", oracle(f"""
WITH m AS (SELECT {MONTH('order_date')} AS month, SUM(total_amount) AS rev
           FROM b_orders WHERE order_status != 'Cancelled' GROUP BY 1),
x AS (SELECT month, CAST(rev AS DOUBLE) AS revenue,
             year(month) * 12 + month(month) AS idx FROM m)
SELECT month, revenue,
       {R('AVG(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS moving_avg_3m,
       {R('regr_slope(revenue, idx) OVER ()', 2)} AS trend_slope_per_month,
       {R('regr_intercept(revenue, idx) OVER () + regr_slope(revenue, idx) OVER () * (idx + 1)')}
         AS next_month_trend_forecast
FROM x ORDER BY month"""))
def revenue_trend_forecast(t: Tables) -> DataFrame:
    """Three-month moving average, the least-squares monthly trend and the
    trend line's value for the following month (a linear forecast)."""
    m = _monthly(t).select("month", dollars("_rev").alias("revenue"),
                           (F.year("month") * 12 + F.month("month")).alias("idx"))
    w = Window.orderBy("month").rowsBetween(-2, 0)   # one row per month
    all_months = Window.partitionBy()
    slope = F.regr_slope("revenue", "idx").over(all_months)
    return (m.select("month", "revenue", rnd(F.avg("revenue").over(w)).alias("moving_avg_3m"),
                     rnd(slope, 2).alias("trend_slope_per_month"),
                     rnd(F.regr_intercept("revenue", "idx").over(all_months) + slope * (F.col("idx") + 1))
                     .alias("next_month_trend_forecast"))
            .orderBy("month"))


# --------------------------------------------------------------------------
@query("category_tree_rollup", oracle(f"""
WITH leaf AS (SELECT p.category_id, SUM(oi.quantity) AS units, SUM(oi.subtotal) AS rev
              FROM b_items oi JOIN b_orders o ON o.order_id = oi.order_id
              JOIN b_products p ON p.product_id = oi.product_id
              WHERE o.order_status != 'Cancelled' GROUP BY p.category_id),
x AS (SELECT c.category_id, c.category_name, c.lvl, l.units, l.rev FROM b_categories c
      JOIN leaf l ON l.category_id = c.category_id
      UNION ALL
      SELECT c.category_id, c.category_name, c.lvl, SUM(l.units), SUM(l.rev) FROM b_categories c
      JOIN b_categories k ON k.parent_category_id = c.category_id
      JOIN leaf l ON l.category_id = k.category_id GROUP BY c.category_id, c.category_name, c.lvl)
SELECT category_id, category_name, lvl AS level, CAST(units AS BIGINT) AS units_sold,
       CAST(rev AS DOUBLE) AS revenue FROM x"""))
def category_tree_rollup(t: Tables) -> DataFrame:
    """Revenue of every category including its sub-categories (two levels)."""
    sold = t.items.join(t.valid_orders.select("order_id"), "order_id", "left_semi")
    leaf = (sold.join(t.products.select("product_id", "category_id"), "product_id")
            .groupBy("category_id").agg(F.sum("quantity").alias("units"), F.sum("subtotal_e4").alias("rev")))
    cats = t.categories.select("category_id", "category_name", "lvl", "parent_category_id")
    leaves = leaf.join(cats, "category_id")
    parents = (leaves.groupBy(F.col("parent_category_id").alias("category_id"))
               .agg(F.sum("units").alias("units"), F.sum("rev").alias("rev"))
               .join(cats.drop("parent_category_id"), "category_id"))
    cols = ["category_id", "category_name", F.col("lvl").alias("level"),
            F.col("units").cast("bigint").alias("units_sold"), dollars("rev", 4).alias("revenue")]
    return leaves.select(*cols).unionByName(parents.select(*cols))


# --------------------------------------------------------------------------
@query("warehouse_turnover", oracle(f"""
SELECT warehouse_location, CAST(SUM(on_hand) AS BIGINT) AS current_stock, CAST(SUM(sold) AS BIGINT) AS units_sold_last_90d,
       {R('SUM(sold) * 365e0 / 90e0 / NULLIF(CAST(SUM(on_hand) AS DOUBLE), 0e0)')} AS inventory_turnover_ratio
FROM (SELECT warehouse_location, quantity_available AS on_hand,
             (SELECT COALESCE(SUM(quantity), 0) FROM recent r WHERE r.product_id = s.product_id) AS sold FROM b_inventory s)
GROUP BY ALL""", ctes=f"""
recent AS (SELECT product_id, quantity FROM b_items
           SEMI JOIN (SELECT order_id FROM b_orders WHERE order_status <> 'Cancelled' AND order_date >= {TS_AGO(90)}) USING (order_id))"""))
def warehouse_turnover(t: Tables, days: int = 90) -> DataFrame:
    recent = t.valid_orders.where(F.col("order_date") >= t.ts_days_ago(days)).select("order_id")
    sales = (t.items.join(recent, "order_id", "left_semi").groupBy("product_id")
             .agg(F.sum("quantity").alias("u")))
    w = (t.inventory.join(sales, "product_id", "left").groupBy("warehouse_location")
         .agg(F.sum("quantity_available").alias("current_stock"), F.coalesce(F.sum("u"), F.lit(0)).alias("_u")))
    return w.select("warehouse_location", F.col("current_stock").cast("bigint").alias("current_stock"),
                    F.col("_u").cast("bigint").alias("units_sold_last_90d"),
                    rnd(F.col("_u").cast("double") * 365.0 / float(days)
                        / F.nullif(F.col("current_stock").cast("double"), F.lit(0.0))).alias("inventory_turnover_ratio"))


@query("fulfillment_bottleneck", oracle("""
SELECT carrier, COUNT(*) AS shipments,
       CAST(quantile_disc(delivery_date - shipping_date, 0.5) AS BIGINT) AS p50_delivery_days,
       CAST(quantile_disc(delivery_date - shipping_date, 0.9) AS BIGINT) AS p90_delivery_days,
       CAST(MAX(delivery_date - shipping_date) AS BIGINT) AS max_delivery_days
FROM b_shipping WHERE delivery_date IS NOT NULL GROUP BY carrier"""))
def fulfillment_bottleneck(t: Tables) -> DataFrame:
    """Exact delivery-time percentiles per carrier (discrete, like
    PERCENTILE_DISC). Day counts are integers, so each carrier is reduced to a
    histogram of distinct day values first; the cumulative window then runs
    over that histogram, whose size is bounded by the range of day counts, not
    by the number of shipments."""
    d = (t.shipping.where(F.col("delivery_date").isNotNull())
         .select("carrier", F.datediff("delivery_date", "shipping_date").cast("bigint").alias("d")))
    h = d.groupBy("carrier", "d").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("carrier")
    h = (h.withColumn("cum", F.sum("n").over(w.orderBy("d")))
         .withColumn("tot", F.sum("n").over(w)))

    def pick(p: float) -> F.Column:
        # first value whose cumulative count reaches p * N (N >= 1)
        return F.min(F.when(F.col("cum") >= F.ceil(F.col("tot") * p), F.col("d")))
    return h.groupBy("carrier").agg(F.max("tot").alias("shipments"), pick(0.5).alias("p50_delivery_days"),
                                    pick(0.9).alias("p90_delivery_days"), F.max("d").alias("max_delivery_days"))


# --------------------------------------------------------------------------
@query("review_sentiment", oracle(f"""
SELECT c.category_name,
       COUNT(*) AS reviews,
       COUNT(CASE WHEN r.rating >= 4 THEN 1 END) AS positive,
       COUNT(CASE WHEN r.rating = 3 THEN 1 END) AS neutral,
       COUNT(CASE WHEN r.rating <= 2 THEN 1 END) AS negative,
       {R(PCT('COUNT(CASE WHEN r.rating >= 4 THEN 1 END) - COUNT(CASE WHEN r.rating <= 2 THEN 1 END)', 'COUNT(*)'))}
         AS net_sentiment_pct
FROM b_reviews r JOIN b_products p ON p.product_id = r.product_id
JOIN b_categories c ON c.category_id = p.category_id GROUP BY c.category_name"""))
def review_sentiment(t: Tables) -> DataFrame:
    """Rating bands per category (the reference has no text analysis)."""
    r = F.col("rating")
    per = (t.reviews.groupBy("product_id")
           .agg(F.count(F.lit(1)).alias("n"), count_if(r >= 4).alias("pos"), count_if(r == 3).alias("neu"),
                count_if(r <= 2).alias("neg"))
           .join(t.products_named.select("product_id", "category_name"), "product_id")
           .groupBy("category_name").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neu", "neg")]))
    return per.select("category_name", F.col("n").alias("reviews"), F.col("pos").alias("positive"),
                      F.col("neu").alias("neutral"), F.col("neg").alias("negative"),
                      rnd(pct(F.col("pos") - F.col("neg"), F.col("n"))).alias("net_sentiment_pct"))


# --------------------------------------------------------------------------
@query("rank_variants", oracle(f"""
WITH m AS (SELECT {MONTH('order_date')} AS month, SUM(total_amount) AS rev
           FROM b_orders WHERE order_status != 'Cancelled' GROUP BY 1)
SELECT month, CAST(year(month) AS INT) AS year, CAST(rev AS DOUBLE) AS revenue,
       CAST(ROW_NUMBER() OVER w AS INT) AS row_number, CAST(RANK() OVER w AS INT) AS rank,
       CAST(DENSE_RANK() OVER w AS INT) AS dense_rank,
       CAST(LEAD(rev) OVER (PARTITION BY year(month) ORDER BY month) AS DOUBLE) AS next_month_revenue,
       CAST(FIRST_VALUE(rev) OVER (PARTITION BY year(month) ORDER BY month) AS DOUBLE) AS first_month_revenue
FROM m WINDOW w AS (PARTITION BY year(month) ORDER BY rev DESC, month)"""))
def rank_variants(t: Tables) -> DataFrame:
    """ROW_NUMBER, RANK, DENSE_RANK, LEAD and FIRST_VALUE over months within
    each year (windows of at most twelve rows)."""
    m = _monthly(t).withColumn("year", F.year("month").cast("int"))
    by_rev = Window.partitionBy("year").orderBy(F.col("_rev").desc(), "month")
    by_month = Window.partitionBy("year").orderBy("month")
    return m.select("month", "year", dollars("_rev").alias("revenue"),
                    F.row_number().over(by_rev).cast("int").alias("row_number"),
                    F.rank().over(by_rev).cast("int").alias("rank"),
                    F.dense_rank().over(by_rev).cast("int").alias("dense_rank"),
                    dollars(F.lead("_rev").over(by_month)).alias("next_month_revenue"),
                    dollars(F.first("_rev").over(by_month)).alias("first_month_revenue"))


# --------------------------------------------------------------------------
@query("join_variants", oracle("""
SELECT 'customers without orders (anti)' AS check_name, COUNT(*) AS row_count FROM b_customers c
WHERE NOT EXISTS (SELECT 1 FROM b_orders o WHERE o.customer_id = c.customer_id)
UNION ALL SELECT 'customers with orders (semi)', COUNT(*) FROM b_customers c
WHERE EXISTS (SELECT 1 FROM b_orders o WHERE o.customer_id = c.customer_id)
UNION ALL SELECT 'orders without items (anti)', COUNT(*) FROM b_orders o
WHERE NOT EXISTS (SELECT 1 FROM b_items i WHERE i.order_id = o.order_id)
UNION ALL SELECT 'products never ordered (anti)', COUNT(*) FROM b_products p
WHERE NOT EXISTS (SELECT 1 FROM b_items i WHERE i.product_id = p.product_id)
UNION ALL SELECT 'campaigns x order campaigns (full outer)', COUNT(*) FROM b_campaigns mc
FULL OUTER JOIN (SELECT DISTINCT campaign_id FROM b_orders WHERE campaign_id IS NOT NULL) oc
  ON oc.campaign_id = mc.campaign_id
UNION ALL SELECT 'order campaigns without campaign (right)', COUNT(*) FROM b_campaigns mc
RIGHT JOIN (SELECT DISTINCT campaign_id FROM b_orders WHERE campaign_id IS NOT NULL) oc
  ON oc.campaign_id = mc.campaign_id WHERE mc.campaign_id IS NULL"""))
def join_variants(t: Tables) -> DataFrame:
    """Anti, semi, full outer and right joins on the retail keys, as counts."""
    o_c = t.orders.select("customer_id")
    used = t.orders.where(F.col("campaign_id").isNotNull()).select("campaign_id").distinct()
    parts = [
        ("customers without orders (anti)", t.customers.join(o_c, "customer_id", "left_anti")),
        ("customers with orders (semi)", t.customers.join(o_c, "customer_id", "left_semi")),
        ("orders without items (anti)", t.orders.join(t.items.select("order_id"), "order_id", "left_anti")),
        ("products never ordered (anti)", t.products.join(t.items.select("product_id"), "product_id",
                                                          "left_anti")),
        ("campaigns x order campaigns (full outer)",
         t.campaigns.select("campaign_id").join(used, "campaign_id", "full")),
        ("order campaigns without campaign (right)",
         t.campaigns.select("campaign_id", F.lit(1).alias("_m")).join(used, "campaign_id", "right")
         .where(F.col("_m").isNull())),
    ]
    out = None
    for name, df in parts:
        one = df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------------------
@query("revenue_by_geo_channel", oracle(f"""
SELECT c.state, mc.channel, COUNT(*) AS orders, {MONEY('o.total_amount')} AS revenue
FROM b_orders o JOIN b_customers c ON c.customer_id = o.customer_id
JOIN b_campaigns mc ON mc.campaign_id = o.campaign_id
WHERE o.order_status != 'Cancelled' GROUP BY c.state, mc.channel"""))
def revenue_by_geo_channel(t: Tables) -> DataFrame:
    """Revenue per region and marketing channel: orders are reduced to
    (customer, campaign) first, then joined to the two dimensions."""
    per = (t.valid_orders.where(F.col("campaign_id").isNotNull())
           .groupBy("customer_id", "campaign_id")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("total_cents").alias("s")))
    j = (per.join(t.customers.select("customer_id", "state"), "customer_id")
         .join(t.campaigns.select("campaign_id", "channel"), "campaign_id"))
    return (j.groupBy("state", "channel")
            .agg(F.sum("n").alias("orders"), dollars(F.sum("s")).alias("revenue")))


# --------------------------------------------------------------------------
@query("attribution_asof_last_touch", oracle(f"""
WITH m AS (
  SELECT o.order_id, o.total_amount, i.campaign_id,
         ROW_NUMBER() OVER (PARTITION BY o.order_id
                            ORDER BY i.interaction_date DESC, i.attribution_id DESC) AS rn
  FROM b_orders o LEFT JOIN b_interactions i
    ON i.customer_id = o.customer_id AND i.interaction_date <= o.order_date
  WHERE o.order_status != 'Cancelled')
SELECT COALESCE(mc.campaign_name, 'Unattributed') AS campaign_name, COUNT(*) AS orders,
       {MONEY('m.total_amount')} AS revenue
FROM m LEFT JOIN b_campaigns mc ON mc.campaign_id = m.campaign_id
WHERE m.rn = 1 GROUP BY 1"""))
def attribution_asof_last_touch(t: Tables) -> DataFrame:
    """Per-order last-touch attribution: each non-cancelled order is credited
    to the customer's latest campaign interaction at or before the order
    time (an as-of join); orders with no earlier touch are 'Unattributed'.
    (With the bound data every touch follows every order.)"""
    from tillroll.functions.asof import asof_join
    o = t.valid_orders.select("customer_id", "order_date", "order_id", "total_cents")
    i = t.interactions.select("customer_id", "interaction_date", "attribution_id", "campaign_id")
    m = asof_join(o, i, key="customer_id", left_ts="order_date", right_ts="interaction_date",
                  right_tiebreak="attribution_id", carry=["campaign_id"])
    per = m.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_cents").alias("_rev"))
    return (per.join(t.campaigns.select("campaign_id", "campaign_name"), "campaign_id", "left")
            .select(F.coalesce("campaign_name", F.lit("Unattributed")).alias("campaign_name"), "orders",
                    dollars("_rev").alias("revenue")))


# --------------------------------------------------------------------------
@query("purchase_last_click", oracle("""
SELECT COALESCE(k.campaign_name, 'Unattributed') AS campaign_name, COUNT(*) AS purchases,
       CAST(SUM(CAST(ROUND(b.value * 100) AS BIGINT)) AS DOUBLE) / 100e0 AS purchase_value
FROM events b
LEFT JOIN LATERAL (
  SELECT i.campaign_id FROM b_interactions i
  WHERE i.customer_id = b.user_id AND i.interaction_date <= b.ts
  ORDER BY i.interaction_date DESC, i.attribution_id DESC LIMIT 1) near ON TRUE
LEFT JOIN b_campaigns k ON k.campaign_id = near.campaign_id
WHERE b.event_type = 'purchase'
GROUP BY ALL"""))
def purchase_last_click(t: Tables) -> DataFrame:
    """Purchase events credited to the campaign of the same user's latest
    click at or before the purchase (an as-of join on the event stream)."""
    from tillroll.functions.asof import asof_join
    bought = (t.raw("events").where(F.col("event_type") == "purchase")
              .select("event_id", "ts", F.col("user_id").alias("customer_id"),
                      F.round(F.col("value") * 100).cast("bigint").alias("cents")))
    clicks = t.interactions.select("customer_id", "interaction_date", "attribution_id", "campaign_id")
    m = asof_join(bought, clicks, key="customer_id", left_ts="ts", right_ts="interaction_date",
                  right_tiebreak="attribution_id", carry=["campaign_id"])
    per = m.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("purchases"), F.sum("cents").alias("_cents"))
    return (per.join(t.campaigns.select("campaign_id", "campaign_name"), "campaign_id", "left")
            .select(F.coalesce("campaign_name", F.lit("Unattributed")).alias("campaign_name"), "purchases",
                    dollars("_cents").alias("purchase_value")))
