"""Advanced analytics: cohort retention, market basket, churn risk, product
affinity.

Pair counting (basket, affinity, recommendations) joins the per-order item
set with itself on ``order_id``. Before that join every order is reduced to
its distinct products (line multiplicity kept as a weight where the literal
result counts line pairs), and where the result keeps only pairs seen in at
least ``m`` orders, products seen in fewer than ``m`` orders are removed
first (a pair cannot be more frequent than either of its products). The
self-join is a sort-merge join on ``order_id``; an order holding a large
share of all lines is split by AQE's skew handling rather than landing in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.common import dollars, month_of, pct, ratio, rnd, whole_days
from tillroll.functions.sqltext import DAYS, KEPT, MONTH, PCT, R, RATIO, TS_AGO, oracle
from tillroll.operators.customer import customer_name
from tillroll.registry import query
from tillroll.sources.bind import Tables


# --------------------------------------------------------------------------
# cohort retention
def _cohort_activity(t: Tables) -> DataFrame:
    cm = (t.valid_orders.where(F.col("customer_id").isNotNull())
          .groupBy("customer_id", month_of("order_date").alias("activity_month")).agg(F.count(F.lit(1)).alias("_n")))
    # after the distinct (customer, month) step each customer holds at most
    # one row per month, so this per-customer window is bounded
    first = cm.withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy("customer_id")))
    return (first.groupBy("cohort_month", "activity_month")
            .agg(F.count(F.lit(1)).alias("active_customers")))


def _cohort(t: Tables, literal: bool, months: int = 3) -> DataFrame:
    act = _cohort_activity(t)
    val = F.lit(1) if literal else F.col("active_customers")
    cols = [F.coalesce(F.sum(F.when(F.col("activity_month") == F.add_months("cohort_month", k), val)),
                       F.lit(0)).cast("bigint").alias(f"month_{k}") for k in range(months + 1)]
    per = act.groupBy("cohort_month").agg(*cols)
    return (per.select("cohort_month", *[f"month_{k}" for k in range(months + 1)],
                       rnd(pct("month_1", "month_0")).alias("retention_month_1_pct"))
            .orderBy(F.col("cohort_month").desc()))


def _cohort_sql(cell: str) -> str:
    """``cell``: what the (cohort, month) row ``age`` months on adds to its column."""
    month = [f"CAST(COALESCE(SUM({cell}) FILTER (age = {k}), 0) AS BIGINT)" for k in range(4)]
    return oracle(f"""
SELECT born AS cohort_month, {', '.join(f'{m} AS month_{k}' for k, m in enumerate(month))},
       {R(PCT(month[1], month[0]))} AS retention_month_1_pct
FROM (SELECT born, datediff('month', born, month) AS age, COUNT(*) AS active
      FROM (SELECT month, MIN(month) OVER (PARTITION BY customer_id) AS born
            FROM (SELECT DISTINCT customer_id, {MONTH('order_date')} AS month FROM b_orders
                  WHERE {KEPT} AND customer_id IS NOT NULL)) GROUP BY ALL)
GROUP BY born ORDER BY born DESC""")


@query("cohort_retention", _cohort_sql("1"))
def cohort_retention(t: Tables) -> DataFrame:
    """Literal: counts (cohort, month) rows, so every cell is 0 or 1."""
    return _cohort(t, literal=True)


@query("cohort_retention_corrected", _cohort_sql("active"))
def cohort_retention_corrected(t: Tables) -> DataFrame:
    """Active customers of each cohort in months 0..3 after its first order."""
    return _cohort(t, literal=False)


# --------------------------------------------------------------------------
# item sets per order
def valid_order_products(t: Tables, with_total: bool = False) -> DataFrame:
    """Distinct (order, product) of non-cancelled orders with line count."""
    cols = ["order_id"] + (["total_cents"] if with_total else [])
    it = t.items.select("order_id", "product_id").join(t.valid_orders.select(*cols), "order_id")
    return it.groupBy("order_id", "product_id", *cols[1:]).agg(F.count(F.lit(1)).alias("lines"))


def orders_per_product(t: Tables, product_id: int | None = None) -> DataFrame:
    """COUNT(DISTINCT order_id) per product (or of one) over all items (any status)."""
    items = t.items if product_id is None else t.items.where(F.col("product_id") == product_id)
    return (items.select("order_id", "product_id").distinct()
            .groupBy("product_id").agg(F.count(F.lit(1)).alias("_den")))


def _pairs(po: DataFrame, op: str) -> DataFrame:
    a = po.select(*[F.col(c).alias(f"a_{c}") for c in po.columns])
    b = po.select(*[F.col(c).alias(f"b_{c}") for c in po.columns])
    cond = F.col("a_order_id") == F.col("b_order_id")
    cond = cond & ((F.col("a_product_id") < F.col("b_product_id")) if op == "<"
                   else (F.col("a_product_id") != F.col("b_product_id")))
    return a.join(b, cond)


def _basket(t: Tables, min_pairs: int, k: int) -> DataFrame:
    po = valid_order_products(t, with_total=True)
    w = F.col("a_lines") * F.col("b_lines")  # line pairs of this product pair in this order
    # pairs are counted by ids; only then does each get its second name, and
    # pairs whose second names agree are added up
    by_id = (_pairs(po, "<").groupBy("a_product_id", "b_product_id")
             .agg(F.sum(w).alias("_n"), F.sum(w * F.col("a_total_cents")).alias("_t")))
    names = t.product_names.select("product_id", "product_name")
    pairs = (by_id.join(names.toDF("b_product_id", "product_2"), "b_product_id")
             .groupBy(F.col("a_product_id").alias("product_id"), "product_2")
             .agg(F.sum("_n").alias("times_bought_together"), F.sum("_t").alias("_tot"))
             .where(F.col("times_bought_together") >= min_pairs))
    # the k best are known before names and totals are joined to them
    top = (pairs.join(names.select("product_id"), "product_id", "left_semi")
           .orderBy(F.col("times_bought_together").desc(), "product_id", "product_2").limit(k))
    j = top.join(names.toDF("product_id", "product_1"), "product_id").join(orders_per_product(t), "product_id")
    return (j.select("product_1", "product_2", "times_bought_together",
                     rnd(ratio(dollars("_tot"), "times_bought_together")).alias("avg_order_value"),
                     rnd(pct("times_bought_together", "_den")).alias("support_pct"),
                     F.col("product_id").alias("_a"))
            .orderBy(F.col("times_bought_together").desc(), "_a", "product_2")
            .limit(k).drop("_a"))


def _basket_sql(min_pairs: int, k: int) -> str:
    return oracle(f"""
SELECT product_1, product_2, n AS times_bought_together, {R(RATIO('amount', 'priced'))} AS avg_order_value,
       {R(PCT('n', 'baskets'))} AS support_pct
FROM (SELECT x.product_id AS a, x.product_name AS product_1, y.product_name AS product_2, COUNT(*) AS n,
             SUM(x.total_amount) AS amount, COUNT(x.total_amount) AS priced
      FROM lines x JOIN lines y USING (order_id) WHERE x.product_id < y.product_id
      GROUP BY ALL HAVING COUNT(*) >= {min_pairs})
JOIN (SELECT product_id AS a, COUNT(DISTINCT order_id) AS baskets FROM b_items GROUP BY ALL) USING (a)
ORDER BY n DESC, a, product_2 LIMIT {k}""", ctes=f"""
lines AS (SELECT order_id, product_id, product_name, total_amount
          FROM b_items JOIN b_orders USING (order_id) JOIN b_products USING (product_id) WHERE {KEPT})""")


@query("market_basket", _basket_sql(3, 20))
def market_basket(t: Tables, min_pairs: int = 3, k: int = 20) -> DataFrame:
    """Literal: line pairs per (product a, name of b), support over all of
    a's orders (cancelled included)."""
    return _basket(t, min_pairs, k)


@query("market_basket_min5", _basket_sql(5, 20))
def market_basket_min5(t: Tables, k: int = 20) -> DataFrame:
    """The README variant: the same operator with threshold 5."""
    return _basket(t, 5, k)


@query("market_basket_corrected", oracle(f"""
SELECT pp.a AS product_1_id, p1.product_name AS product_1, pp.b AS product_2_id,
       p2.product_name AS product_2, pp.n AS times_bought_together,
       {R('pp.tot / pp.n')} AS avg_order_value,
       {R(PCT('pp.n', 'ta.n'))} AS support_pct
FROM (SELECT x.product_id AS a, y.product_id AS b, COUNT(*) AS n, CAST(SUM(x.total_amount) AS DOUBLE) AS tot
      FROM vop x JOIN vop y ON x.order_id = y.order_id AND x.product_id < y.product_id
      GROUP BY 1, 2 HAVING COUNT(*) >= 3) pp
JOIN b_products p1 ON p1.product_id = pp.a
JOIN b_products p2 ON p2.product_id = pp.b
JOIN (SELECT product_id, COUNT(*) AS n FROM vop GROUP BY product_id) ta ON ta.product_id = pp.a
ORDER BY times_bought_together DESC, product_1_id, product_2_id LIMIT 20""", ctes="""
vop AS (SELECT DISTINCT oi.order_id, oi.product_id, o.total_amount
        FROM b_items oi JOIN b_orders o ON oi.order_id = o.order_id
        WHERE o.order_status != 'Cancelled')"""))
def market_basket_corrected(t: Tables, min_pairs: int = 3, k: int = 20) -> DataFrame:
    """Distinct orders per product pair (by id); support over a's
    non-cancelled orders."""
    po = valid_order_products(t, with_total=True)
    totals = po.groupBy("product_id").agg(F.count(F.lit(1)).alias("_den"))
    frequent = totals.where(F.col("_den") >= min_pairs).select("product_id")
    pf = po.join(frequent, "product_id", "left_semi")
    pairs = (_pairs(pf, "<")
             .groupBy(F.col("a_product_id").alias("product_1_id"), F.col("b_product_id").alias("product_2_id"))
             .agg(F.count(F.lit(1)).alias("times_bought_together"),
                  F.sum("a_total_cents").alias("_tot"))
             .where(F.col("times_bought_together") >= min_pairs))
    names = t.product_names.select("product_id", "product_name")
    j = (pairs.join(names.toDF("product_1_id", "product_1"), "product_1_id")
         .join(names.toDF("product_2_id", "product_2"), "product_2_id")
         .join(totals.withColumnRenamed("product_id", "product_1_id"), "product_1_id"))
    return (j.select("product_1_id", "product_1", "product_2_id", "product_2", "times_bought_together",
                     rnd(ratio(dollars("_tot"), "times_bought_together")).alias("avg_order_value"),
                     rnd(pct("times_bought_together", "_den")).alias("support_pct"))
            .orderBy(F.col("times_bought_together").desc(), "product_1_id", "product_2_id")
            .limit(k))


# --------------------------------------------------------------------------
# product affinity
def affinity_pairs(po: DataFrame, min_co: int) -> tuple[DataFrame, DataFrame]:
    """Ordered pairs (a, b), a != b, with distinct co-occurring orders >= min_co,
    plus per-item order totals. ``po`` has distinct (order_id, product_id)."""
    totals = po.groupBy("product_id").agg(F.count(F.lit(1)).alias("total_orders"))
    frequent = totals.where(F.col("total_orders") >= min_co).select("product_id")
    pf = po.select("order_id", "product_id").join(frequent, "product_id", "left_semi")
    half = (_pairs(pf, "<").groupBy("a_product_id", "b_product_id")
            .agg(F.count(F.lit(1)).alias("co_occurrence"))
            .where(F.col("co_occurrence") >= min_co))
    both = half.select(F.explode(F.array(
        F.struct(F.col("a_product_id").alias("product_a"), F.col("b_product_id").alias("product_b"),
                 "co_occurrence"),
        F.struct(F.col("b_product_id").alias("product_a"), F.col("a_product_id").alias("product_b"),
                 "co_occurrence"))).alias("p")).select("p.*")
    return both, totals


def _affinity(pairs: DataFrame, totals: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """The k most alike pairs; names (one per product) are joined to these alone."""
    ta = totals.toDF("product_a", "product_a_orders")
    tb = totals.toDF("product_b", "product_b_orders")
    cos = F.col("co_occurrence").cast("double") / F.sqrt(
        (F.col("product_a_orders") * F.col("product_b_orders")).cast("double"))
    order = [F.col("cosine_similarity").desc(), "product_a", "product_b"]
    top = pairs.join(ta, "product_a").join(tb, "product_b").withColumn("cosine_similarity", rnd(cos, 4)).orderBy(*order).limit(k)
    j = (top.join(names.toDF("product_a", "product"), "product_a")
         .join(names.toDF("product_b", "recommended_product"), "product_b"))
    return (j.select("product", "recommended_product", "co_occurrence", "product_a_orders",
                     "product_b_orders",
                     rnd(pct("co_occurrence", "product_a_orders")).alias("affinity_score_pct"),
                     "cosine_similarity", "product_a", "product_b")
            .orderBy(*order).limit(k).drop("product_a", "product_b"))


def _affinity_sql(unit: str, names: str, min_co: int, k: int) -> str:
    """``unit``: what an item counts as; ``names``: rows (unit, name)."""
    return oracle(f"""
SELECT l.name AS product, r.name AS recommended_product, together AS co_occurrence,
       m.baskets AS product_a_orders, n.baskets AS product_b_orders,
       {R(PCT('together', 'm.baskets'))} AS affinity_score_pct,
       {R('together / SQRT(CAST(m.baskets * n.baskets AS DOUBLE))', 4)} AS cosine_similarity
FROM (SELECT x.unit AS a, y.unit AS b, CAST(COUNT(*) AS BIGINT) AS together
      FROM carts x JOIN carts y USING (order_id) WHERE x.unit <> y.unit GROUP BY ALL HAVING COUNT(*) >= {min_co})
JOIN sizes m ON m.unit = a JOIN sizes n ON n.unit = b JOIN named l ON l.unit = a JOIN named r ON r.unit = b
ORDER BY cosine_similarity DESC, a, b LIMIT {k}""", ctes=f"""
carts AS (SELECT DISTINCT order_id, {unit} AS unit FROM b_items JOIN b_products USING (product_id)
          SEMI JOIN (SELECT order_id FROM b_orders WHERE {KEPT}) USING (order_id)),
sizes AS (SELECT unit, COUNT(*) AS baskets FROM carts GROUP BY unit),
named(unit, name) AS ({names})""")


@query("product_affinity", _affinity_sql(
    "product_id", "SELECT product_id, product_name FROM b_products", 3, 30))
def product_affinity(t: Tables, min_co: int = 3, k: int = 30) -> DataFrame:
    po = valid_order_products(t).join(t.product_names.select("product_id"), "product_id", "left_semi")
    pairs, totals = affinity_pairs(po.select("order_id", "product_id"), min_co)
    return _affinity(pairs, totals, t.product_names.select("product_id", "product_name"), k)


@query("product_affinity_by_category", _affinity_sql(
    "category_id", "SELECT category_id, category_name FROM b_categories", 3, 30))
def product_affinity_by_category(t: Tables, min_co: int = 3, k: int = 30) -> DataFrame:
    """The same affinity operator at category grain (item -> its category)."""
    # items keyed by their leaf category name; leaf ids are dense ranks of the
    # names, so name order is id order and the tie-breaks agree
    it = (t.items.select("order_id", "product_id")
          .join(t.valid_orders.select("order_id"), "order_id", "left_semi")
          .join(t.products_named.select("product_id", "category_name"), "product_id")
          .select("order_id", F.col("category_name").alias("product_id")).distinct())
    pairs, totals = affinity_pairs(it, min_co)
    names = totals.select("product_id", F.col("product_id").alias("category_name"))
    return _affinity(pairs, totals, names, k)


# --------------------------------------------------------------------------
# churn risk
def _churn_sql() -> str:
    before = "LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id)"
    return oracle(f"""
SELECT customer_id, first_name || ' ' || last_name AS customer_name, idle AS days_since_last_order, bought AS total_orders,
       CAST(spent AS DOUBLE) AS total_spent, {R(RATIO('spent', 'priced'))} AS avg_order_value,
       pause AS avg_days_between_orders,
       CASE WHEN idle <= pause * 1.5 THEN 'Low Risk' WHEN idle <= pause * 2 THEN 'Medium Risk' ELSE 'High Risk' END AS churn_risk,
       newest + to_microseconds(CAST({R('pause * 86400000000e0', 0)} AS BIGINT)) AS expected_next_purchase
FROM (SELECT customer_id, {DAYS(TS_AGO(0), 'MAX(order_date)')} AS idle, COUNT(order_id) AS bought, SUM(total_amount) AS spent,
             COUNT(total_amount) AS priced, {R('AVG(gap)', 1)} AS pause
      FROM (SELECT *, {DAYS('order_date', before)} AS gap FROM b_orders WHERE {KEPT}) GROUP BY customer_id)
JOIN (SELECT customer_id, MAX(order_date) AS newest FROM b_orders GROUP BY customer_id) USING (customer_id)
JOIN b_customers USING (customer_id)
WHERE pause IS NOT NULL ORDER BY idle DESC, customer_id""")


@query("churn_risk", _churn_sql())
def churn_risk(t: Tables) -> DataFrame:
    """Recency against the mean gap between a customer's orders.

    The gap between consecutive orders is whole days, truncated, so two
    orders on the same calendar day are 0 apart. The per-order LAG therefore
    reduces to: (n_day - 1) zero gaps inside each (customer, day), and one gap
    from the last order of the previous active day to the first of this one.
    The window runs over one row per (customer, active day) — bounded by the
    calendar, not by how many orders one customer places.
    """
    # one pass over all orders: kept ones make the figures, any order the last date
    ok = F.col("order_status") != "Cancelled"
    kept = lambda c: F.when(ok, F.col(c))
    per_day = (t.orders.where(F.col("customer_id").isNotNull())
               .groupBy("customer_id", F.to_date("order_date").alias("_day"))
               .agg(F.count(F.when(ok, F.lit(1))).alias("_n"), F.min(kept("order_date")).alias("_first"),
                    F.max(kept("order_date")).alias("_last"), F.sum(kept("total_cents")).alias("_s"),
                    F.count(kept("total_cents")).alias("_ns"), F.max("order_date").alias("_any")))
    earlier = Window.partitionBy("customer_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    gaps = per_day.withColumn("_gap", whole_days(F.col("_first"), F.last("_last", ignorenulls=True).over(earlier)))
    per = (gaps.groupBy("customer_id")
           # a customer whose orders all share one day has only zero gaps
           .agg(F.sum("_n").alias("total_orders"), F.coalesce(F.sum("_gap"), F.lit(0)).alias("_gsum"),
                F.sum("_s").alias("_spend"), F.sum("_ns").alias("_nspend"),
                F.max("_last").alias("_lastv"), F.max("_any").alias("_last_any"))
           .where(F.col("total_orders") >= 2))
    j = per.join(t.customers.select("customer_id", "first_name", "last_name"), "customer_id")
    avg_gap = rnd(F.col("_gsum").cast("double") / (F.col("total_orders") - 1), 1)
    days = whole_days(t.ts_days_ago(0), F.col("_lastv"))
    micros = rnd(avg_gap * 86400000000.0, 0).cast("bigint")
    out = j.select(
        "customer_id", customer_name().alias("customer_name"), days.alias("days_since_last_order"),
        "total_orders", dollars("_spend").alias("total_spent"),
        rnd(ratio(dollars("_spend"), "_nspend")).alias("avg_order_value"),
        avg_gap.alias("avg_days_between_orders"),
        F.when(days > avg_gap * 2, "High Risk").when(days > avg_gap * 1.5, "Medium Risk")
         .otherwise("Low Risk").alias("churn_risk"),
        F.timestamp_add("MICROSECOND", micros, F.col("_last_any")).alias("expected_next_purchase"))
    return out.orderBy(F.col("days_since_last_order").desc(), "customer_id")
