"""Parameterised table functions of the reference.

Each function answers for every key at once (one distributed job instead of
one call per key); passing the key (``customer_id=...``) filters that plan,
and Catalyst pushes the filter down to both sides of the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.common import dollars, pct, ratio, rnd, times
from tillroll.functions.sqltext import BUYERS, KEPT, PCT, R, RATIO, TAGGED, TS_AGO, oracle
from tillroll.operators.advanced import orders_per_product, valid_order_products
from tillroll.operators.customer import customer_name, customer_order_stats
from tillroll.operators.marketing import interactions_per_pair, orders_per_campaign
from tillroll.operators.product import review_stats
from tillroll.plans.views import PRODUCT_FAN, PRODUCT_ONCE, STATUS_BY_DATE, customer_status_by_date, product_item_stats
from tillroll.registry import query
from tillroll.sources.bind import Tables


# --------------------------------------------------------------------------
def _ltv_sql(where: str = "") -> str:
    return oracle(f"""
SELECT customer_id, first_name || ' ' || last_name AS customer_name, COALESCE(bought, 0) AS total_orders,
       CAST(COALESCE(spent, 0) AS DOUBLE) AS total_revenue, {R('COALESCE(mean, 0e0)')} AS avg_order_value,
       {R('COALESCE(mean, 0e0) * (COALESCE(bought, 0) * 1.5e0)')} AS predicted_ltv,
       {STATUS_BY_DATE('latest')} AS customer_status
FROM b_customers LEFT JOIN (SELECT *, {RATIO('spent', 'priced')} AS mean FROM buyers) USING (customer_id) {where}""",
                  ctes=BUYERS())


@query("customer_ltv", _ltv_sql())
def customer_ltv(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Lifetime value per customer; the prediction uses the unrounded mean."""
    c = t.customers.select("customer_id", "first_name", "last_name")
    o = t.valid_orders
    if customer_id is not None:
        c = c.where(F.col("customer_id") == customer_id)
        o = o.where(F.col("customer_id") == customer_id)
    j = c.join(customer_order_stats(t, o), "customer_id", "left")
    avg = F.coalesce(ratio(dollars("_spend"), "_nspend"), F.lit(0.0))
    n = F.coalesce("total_orders", F.lit(0))
    return j.select(
        "customer_id", customer_name().alias("customer_name"), n.alias("total_orders"),
        F.coalesce(dollars("_spend"), F.lit(0.0)).alias("total_revenue"),
        rnd(avg).alias("avg_order_value"),
        rnd(avg * (n * 1.5)).alias("predicted_ltv"),
        customer_status_by_date(t, F.col("last_order_date")).alias("customer_status"))


# --------------------------------------------------------------------------
def _top_products(t: Tables, literal: bool, category_id: int | None, k: int) -> DataFrame:
    p = t.products.select("product_id", "product_name", "category_id", "price_cents")
    only = None
    if category_id is not None:
        p = p.where(F.col("category_id") == category_id)
        only = p.select("product_id")   # reaches items, reviews and stock as a semi-join
    j = (p.join(product_item_stats(t, valid_only=not literal, only=only), "product_id", "left")
         .join(review_stats(t, only), "product_id", "left")
         .join(t.inventory.select("product_id", "quantity_available"), "product_id", "left"))
    mult = F.greatest(F.coalesce("nr", F.lit(0)), F.lit(1)) if literal else F.lit(1)
    out = j.select(
        "category_id", "product_id", "product_name", dollars("price_cents").alias("price"),
        F.coalesce(times("q", mult), F.lit(0)).cast("bigint").alias("units_sold"),
        F.coalesce(dollars(times("s", mult), 4), F.lit(0.0)).alias("revenue"),
        rnd(F.coalesce(ratio("rsum", "rcnt"), F.lit(0.0))).alias("avg_rating"),
        F.coalesce("quantity_available", F.lit(0)).alias("stock_level"))
    # top-k inside each category: Spark plans this as a per-partition group limit
    w = Window.partitionBy("category_id").orderBy(F.col("revenue").desc(), "product_id")
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def _top_products_sql(literal: bool, k: int, where: str = "") -> str:
    return oracle(f"""
SELECT category_id, product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(COALESCE(units, 0) AS BIGINT) AS units_sold,
       CAST(COALESCE(takings, 0) AS DOUBLE) AS revenue, {R('COALESCE(' + RATIO('stars', 'rated') + ', 0e0)')} AS avg_rating,
       COALESCE(quantity_available, 0) AS stock_level
FROM b_products JOIN figures USING (product_id)
LEFT JOIN (SELECT product_id, quantity_available FROM b_inventory) USING (product_id) {where}
QUALIFY ROW_NUMBER() OVER (PARTITION BY category_id ORDER BY revenue DESC, product_id) <= {k}""",
                  ctes=PRODUCT_FAN if literal else PRODUCT_ONCE)


@query("top_products_by_category", _top_products_sql(True, 10))
def top_products_by_category(t: Tables, category_id: int | None = None, k: int = 10) -> DataFrame:
    """Literal: units and revenue repeat per review of the product, and the
    status test guards an unused join, so cancelled items count."""
    return _top_products(t, True, category_id, k)


@query("top_products_by_category_corrected", _top_products_sql(False, 10))
def top_products_by_category_corrected(t: Tables, category_id: int | None = None, k: int = 10) -> DataFrame:
    """Units and revenue of non-cancelled orders, counted once."""
    return _top_products(t, False, category_id, k)


# --------------------------------------------------------------------------
def _campaign_fn(t: Tables, literal: bool, campaign_id: int | None) -> DataFrame:
    mc = t.campaigns
    if campaign_id is not None:
        mc = mc.where(F.col("campaign_id") == campaign_id)
    # distinct customers via the per-(campaign, customer) aggregate: no Expand
    reach = (interactions_per_pair(t).groupBy("campaign_id")
             .agg(F.sum("n_inter").alias("n_cc"), F.count("customer_id").alias("reached"),
                  F.count(F.when(F.col("conv"), F.col("customer_id"))).alias("converted")))
    j = mc.join(orders_per_campaign(t), "campaign_id", "left").join(reach, "campaign_id", "left")
    mult = F.greatest(F.coalesce("n_cc", F.lit(0)), F.lit(1)) if literal else F.lit(1)
    # orders x interactions of a campaign grows with the square of the data
    rev = F.coalesce(times("s_ord", mult), F.lit(0))
    budget = F.col("budget_cents")
    return j.select(
        "campaign_id", "campaign_name", dollars(budget).alias("budget"),
        dollars(rev).alias("revenue"),
        rnd(pct(dollars(rev - budget), dollars(budget))).alias("roi_percentage"),
        F.coalesce("n_ord", F.lit(0)).alias("total_orders"),
        rnd(pct("converted", "reached")).alias("conversion_rate"))


def _campaign_fn_sql(literal: bool, where: str = "") -> str:
    """Literal: a campaign's kept orders stand beside each of its touches."""
    orders = (f"SELECT campaign_id, order_id, total_amount FROM b_orders WHERE {KEPT}" if literal else
              "SELECT campaign_id, NULL AS order_id, takings AS total_amount FROM tagged")
    takings = "SUM(total_amount)" if literal else "MAX(total_amount)"
    return oracle(f"""
SELECT campaign_id, campaign_name, CAST(budget AS DOUBLE) AS budget, CAST(COALESCE(earned, 0) AS DOUBLE) AS revenue,
       {R(PCT('COALESCE(earned, 0) - budget', 'budget'))} AS roi_percentage, COALESCE(sales, 0) AS total_orders,
       {R(PCT('won', 'reached'))} AS conversion_rate
FROM (SELECT campaign_id, {takings} AS earned, COUNT(DISTINCT customer_id) AS reached,
             COUNT(DISTINCT customer_id) FILTER (conversion_date IS NOT NULL) AS won
      FROM (SELECT campaign_id FROM b_campaigns) LEFT JOIN ({orders}) USING (campaign_id)
      LEFT JOIN b_interactions USING (campaign_id) GROUP BY campaign_id)
JOIN b_campaigns USING (campaign_id) LEFT JOIN tagged USING (campaign_id) {where}""", ctes=TAGGED)


@query("campaign_roi_fn", _campaign_fn_sql(True))
def campaign_roi_fn(t: Tables, campaign_id: int | None = None) -> DataFrame:
    """Literal: campaign revenue repeats once per interaction row of the
    campaign (orders x interactions within a campaign)."""
    return _campaign_fn(t, True, campaign_id)


@query("campaign_roi_fn_corrected", _campaign_fn_sql(False))
def campaign_roi_fn_corrected(t: Tables, campaign_id: int | None = None) -> DataFrame:
    return _campaign_fn(t, False, campaign_id)


# --------------------------------------------------------------------------
def _history_sql(days: int, where: str = "TRUE") -> str:
    return oracle(f"""
SELECT customer_id, order_id, order_date, order_status, CAST(total_amount AS DOUBLE) AS total_amount,
       COALESCE(lines, 0) AS items_count, products
FROM b_orders LEFT JOIN (
  SELECT order_id, COUNT(*) AS lines, string_agg(product_name, ', ' ORDER BY product_name) AS products
  FROM b_items LEFT JOIN b_products USING (product_id) GROUP BY order_id) USING (order_id)
WHERE order_date >= {TS_AGO(days)} AND {where} ORDER BY order_date DESC""")


@query("purchase_history", _history_sql(365))
def purchase_history(t: Tables, customer_id: int | None = None, days: int = 365) -> DataFrame:
    """Orders of the last ``days`` with item count and product names (sorted
    by name, so the list is deterministic)."""
    o = t.orders.where(F.col("order_date") >= t.ts_days_ago(days))
    if customer_id is not None:
        o = o.where(F.col("customer_id") == customer_id)
    items = (t.items.select("order_id", "product_id").join(o.select("order_id"), "order_id", "left_semi")
             .join(t.product_names.select("product_id", "product_name"), "product_id", "left")
             .groupBy("order_id")
             .agg(F.count("order_id").alias("items_count"),
                  F.expr("listagg(product_name, ', ') WITHIN GROUP (ORDER BY product_name)").alias("products")))
    return (o.join(items, "order_id", "left")
            .select("customer_id", "order_id", "order_date", "order_status",
                    dollars("total_cents").alias("total_amount"),
                    F.coalesce("items_count", F.lit(0)).alias("items_count"), "products")
            .orderBy(F.col("order_date").desc(), "order_id"))


# --------------------------------------------------------------------------
def _recommend_sql(seed: str = "TRUE", k: int = 5) -> str:
    """``seed``: which products ask for recommendations."""
    return oracle(f"""
SELECT a AS product_id, b AS recommended_product_id, product_name AS recommended_product_name,
       times_bought_together, {R(PCT('times_bought_together', 'baskets'))} AS affinity_score
FROM (SELECT x.product_id AS a, y.product_id AS b, COUNT(*) AS times_bought_together
      FROM baskets x JOIN baskets y USING (order_id) SEMI JOIN kept USING (order_id)
      WHERE x.product_id <> y.product_id AND {seed} GROUP BY ALL)
JOIN (SELECT product_id AS a, COUNT(*) AS baskets FROM baskets GROUP BY ALL) USING (a)
JOIN b_products p ON p.product_id = b
QUALIFY ROW_NUMBER() OVER (PARTITION BY a ORDER BY times_bought_together DESC, b) <= {k}""", ctes=f"""
baskets AS (SELECT DISTINCT order_id, product_id FROM b_items),
kept AS (SELECT order_id FROM b_orders WHERE {KEPT})""")


@query("recommend_products", _recommend_sql())
def recommend_products(t: Tables, product_id: int | None = None, k: int = 5) -> DataFrame:
    """Top-k co-purchased products per seed product (affinity = share of the
    seed's orders, cancelled included in the denominator)."""
    po = valid_order_products(t).select("order_id", "product_id")
    if product_id is None:
        # all seeds: count each unordered pair once, then emit both orientations
        half = (po.toDF("order_id", "a").join(po.toDF("order_id", "b"), "order_id")
                .where(F.col("a") < F.col("b"))
                .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
        pairs = half.select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("b").alias("b"), F.col("n").alias("times_bought_together")),
            F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n").alias("times_bought_together"))
        )).alias("p")).select("p.*")
    else:
        # one seed: only its orders are joined
        # (the condition reaches the items' scan; the other items of those
        # orders come in through a semi-join before they are deduplicated)
        a = (t.items.where(F.col("product_id") == product_id)
             .join(t.valid_orders.select("order_id"), "order_id", "left_semi")
             .select("order_id", F.col("product_id").alias("a")).distinct())
        others = (t.items.select("order_id", F.col("product_id").alias("b"))
                  .join(a.select("order_id"), "order_id", "left_semi").distinct())
        pairs = (a.join(others, "order_id").where(F.col("a") != F.col("b"))
                 .groupBy("a", "b").agg(F.count(F.lit(1)).alias("times_bought_together")))
    j = (pairs.join(t.product_names.select(F.col("product_id").alias("b"),
                                      F.col("product_name").alias("recommended_product_name")), "b")
         .join(orders_per_product(t, product_id).withColumnRenamed("product_id", "a"), "a"))
    w = Window.partitionBy("a").orderBy(F.col("times_bought_together").desc(), "b")
    return (j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select(F.col("a").alias("product_id"), F.col("b").alias("recommended_product_id"),
                    "recommended_product_name", "times_bought_together",
                    rnd(pct("times_bought_together", "_den")).alias("affinity_score")))


# --------------------------------------------------------------------------
# The form the source offers: one call, one key.
@query("customer_ltv_of", _ltv_sql("WHERE customer_id = 7"))
def customer_ltv_of(t: Tables, customer_id: int = 7) -> DataFrame:
    return customer_ltv(t, customer_id)


@query("top_products_of_category", _top_products_sql(True, 10, "WHERE category_id = 40"))
def top_products_of_category(t: Tables, category_id: int = 40, k: int = 10) -> DataFrame:
    return top_products_by_category(t, category_id, k)


@query("campaign_roi_of", _campaign_fn_sql(True, "WHERE campaign_id = 3"))
def campaign_roi_of(t: Tables, campaign_id: int = 3) -> DataFrame:
    return campaign_roi_fn(t, campaign_id)


@query("purchase_history_of", _history_sql(3650, "customer_id = 7"))
def purchase_history_of(t: Tables, customer_id: int = 7, days: int = 3650) -> DataFrame:
    return purchase_history(t, customer_id, days)


@query("recommend_products_for", _recommend_sql("x.product_id = 11"))
def recommend_products_for(t: Tables, product_id: int = 11, k: int = 5) -> DataFrame:
    return recommend_products(t, product_id, k)
