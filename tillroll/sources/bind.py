"""Binding layer: the ten retail tables of the reference schema, derived from
the driver's TPC-H-like Parquet by deterministic column expressions.

Each table exists twice, in the same words:

* as a lazy Spark DataFrame (``Tables.orders`` ...), which is what operators use;
* as DuckDB SQL text (``BIND_SQL``), which the oracle queries prepend as CTEs.

Where both engines accept the same expression text it is written once and
used by both (``F.expr`` on the Spark side), so the two cannot drift.

Mapping (driver -> retail):

==================  ==========================================================
orders              ``orders``; status F/O/P -> Delivered/Pending/Cancelled;
                    70 % of orders carry one of the 10 campaigns
order_items         ``lineitem`` (one item per line)
products            ``part``; category = leaf ``p_type/p_brand``
categories          two-level tree: ``p_type`` parents, ``p_type/p_brand``
                    leaves, plus one product-less category ``EMPTY``
customers           ``customer`` with nation (city) and region (state);
                    signup = first ``signup`` event, else first order day
marketing_campaigns the reference's ten campaign rows
customer_campaigns  ``events`` of type ``click``
shipping            one shipment per line of a Delivered order
reviews             one review per distinct (order, product) of Delivered orders
inventory           one stock row per part
==================  ==========================================================
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.sources.driver import read_driver

# The analysis date that replaces CURRENT_DATE: the day after the last order
# date of the driver data (max o_orderdate is 2001-08-01 at every scale).
AS_OF = dt.date(2001, 8, 2)

# ---------------------------------------------------------------------------
# Shared expression text (valid Spark SQL and DuckDB SQL alike)
# ---------------------------------------------------------------------------
STATUS_EXPR = ("CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' "
               "WHEN 'P' THEN 'Cancelled' END")
# driver status codes whose bound status is not 'Cancelled' (and not NULL)
VALID_STATUS_CODES = ("F", "O")
CAMPAIGN_EXPR = ("CASE WHEN o_orderkey % 10 >= 7 THEN NULL "
                 "ELSE CAST(FLOOR(o_orderkey / 10e0) AS BIGINT) % 10 + 1 END")
TOTAL_EXPR = "CAST(o_totalprice AS DECIMAL(12,2))"
DISCOUNT_EXPR = "CAST(FLOOR(o_totalprice * 3e0) / 100e0 AS DECIMAL(12,2))"
TAX_EXPR = "CAST(FLOOR(o_totalprice * 8e0) / 100e0 AS DECIMAL(12,2))"
SHIPPING_COST_EXPR = "CAST(5 AS DECIMAL(12,2))"

QUANTITY_EXPR = "CAST(l_quantity AS BIGINT)"
UNIT_PRICE_EXPR = "CAST(FLOOR(l_extendedprice * 100e0 / l_quantity) / 100e0 AS DECIMAL(12,2))"
ITEM_DISCOUNT_EXPR = "CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))"
SUBTOTAL_EXPR = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"

TOTAL_CENTS_EXPR = "CAST(FLOOR(o_totalprice * 100e0 + 0.5e0) AS BIGINT)"
EXT_CENTS_EXPR = "CAST(FLOOR(l_extendedprice * 100e0 + 0.5e0) AS BIGINT)"
DISC_PCT_EXPR = "FLOOR(l_discount * 100e0 + 0.5e0)"

PRICE_EXPR = "CAST(p_retailprice AS DECIMAL(10,2))"
PRICE_CENTS_EXPR = "CAST(FLOOR(p_retailprice * 100e0 + 0.5e0) AS BIGINT)"
COST_EXPR = "CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1))"

CARRIER_EXPR = ("CASE l_suppkey % 4 WHEN 0 THEN 'FedEx' WHEN 1 THEN 'UPS' "
                "WHEN 2 THEN 'USPS' ELSE 'DHL' END")
WAREHOUSE_EXPR = ("CASE p_partkey % 3 WHEN 0 THEN 'East Warehouse' "
                  "WHEN 1 THEN 'West Warehouse' ELSE 'Central Warehouse' END")
STOCK_EXPR = "CAST(50 + (p_partkey * 37) % 500 AS INT)"
RATING_EXPR = "CAST((order_id + product_id) % 5 + 1 AS INT)"
CONVERTS_EXPR = "CAST(FLOOR(event_id / 10e0) AS BIGINT) % 10 < 6"

# The reference's review texts, in its order.
REVIEW_TEXTS = (
    "Great product! Highly recommend.",
    "Good quality for the price.",
    "Exactly as described. Fast shipping.",
    "Love it! Will buy again.",
    "Perfect! Exceeded expectations.",
)
REVIEW_TEXT_EXPR = ("CASE (order_id + 2 * product_id) % 5 "
                    + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(REVIEW_TEXTS[:4]))
                    + f" ELSE '{REVIEW_TEXTS[4]}' END")

# The reference's ten marketing campaigns, in its order
# (id, name, type, start, end, budget, channel).
CAMPAIGNS = (
    (1, "Summer Sale 2024", "Email", "2024-06-01", "2024-08-31", "50000.00", "Email"),
    (2, "Back to School", "Social", "2024-08-01", "2024-09-30", "75000.00", "Facebook"),
    (3, "Black Friday", "PPC", "2024-11-15", "2024-11-30", "100000.00", "Google"),
    (4, "Holiday Special", "Email", "2024-12-01", "2024-12-31", "80000.00", "Email"),
    (5, "New Year Deals", "Social", "2025-01-01", "2025-01-15", "60000.00", "Instagram"),
    (6, "Spring Collection", "PPC", "2024-03-01", "2024-05-31", "45000.00", "Google"),
    (7, "Referral Program", "Referral", "2024-01-01", "2024-12-31", "30000.00", "Email"),
    (8, "Flash Sale Week", "Social", "2024-10-01", "2024-10-07", "40000.00", "Facebook"),
    (9, "Cyber Monday", "PPC", "2024-11-25", "2024-11-26", "90000.00", "Google"),
    (10, "Loyalty Rewards", "Email", "2024-01-01", "2024-12-31", "25000.00", "Email"),
)

CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("campaign_id", T.LongType(), False),
    T.StructField("campaign_name", T.StringType(), False),
    T.StructField("campaign_type", T.StringType(), True),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), True),
    T.StructField("budget", T.DecimalType(10, 2), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("budget_cents", T.LongType(), True),
])

RESTOCK_BASE = "2001-05-01"


def _x(*pairs: tuple[str, str]) -> list:
    """``[(alias, sql_text)]`` -> Spark column list."""
    return [F.expr(e).alias(a) for a, e in pairs]


def _sql_cols(*pairs: tuple[str, str]) -> str:
    return ",\n    ".join(f"{e} AS {a}" for a, e in pairs)


ORDER_COLS = (
    ("order_id", "o_orderkey"),
    ("customer_id", "o_custkey"),
    ("order_date", "o_orderdate"),
    ("order_status", STATUS_EXPR),
    ("payment_method", "o_orderpriority"),
    ("campaign_id", CAMPAIGN_EXPR),
    ("discount_amount", DISCOUNT_EXPR),
    ("shipping_cost", SHIPPING_COST_EXPR),
    ("tax_amount", TAX_EXPR),
    ("total_amount", TOTAL_EXPR),
    # exact unscaled companions (cents) of the money columns: aggregations sum
    # these as BIGINT, which is exact and avoids per-row BigDecimal arithmetic
    ("total_cents", TOTAL_CENTS_EXPR),
    ("discount_cents", "CAST(FLOOR(o_totalprice * 3e0) AS BIGINT)"),
    ("shipping_cents", "CAST(500 AS BIGINT)"),
    ("tax_cents", "CAST(FLOOR(o_totalprice * 8e0) AS BIGINT)"),
)
ITEM_COLS = (
    ("order_id", "l_orderkey"),
    ("product_id", "l_partkey"),
    ("line_number", "l_linenumber"),
    ("quantity", QUANTITY_EXPR),
    ("unit_price", UNIT_PRICE_EXPR),
    ("discount", ITEM_DISCOUNT_EXPR),
    ("subtotal", SUBTOTAL_EXPR),
    # unscaled companions: unit price in cents, subtotal and discount at scale 4
    ("unit_price_cents", "CAST(FLOOR(l_extendedprice * 100e0 / l_quantity) AS BIGINT)"),
    ("subtotal_e4", f"{EXT_CENTS_EXPR} * CAST(100 - {DISC_PCT_EXPR} AS BIGINT)"),
    ("discount_e4", f"{EXT_CENTS_EXPR} * CAST({DISC_PCT_EXPR} AS BIGINT)"),
)
INVENTORY_COLS = (
    ("inventory_id", "p_partkey"),
    ("product_id", "p_partkey"),
    ("warehouse_location", WAREHOUSE_EXPR),
    ("quantity_available", STOCK_EXPR),
    ("reorder_level", "CAST(50 AS INT)"),
)


class Tables:
    """The ten bound retail tables over one driver directory.

    Properties are lazy DataFrames; building one runs nothing. ``as_of`` is
    the analysis date used wherever the reference says ``CURRENT_DATE``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of

    # -- raw driver tables -------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)

    # -- time helpers --------------------------------------------------------
    def ts_days_ago(self, days: int = 0):
        """Timestamp literal (no zone) ``days`` before the as-of midnight."""
        d = self.as_of - dt.timedelta(days=days)
        return F.lit(f"{d.isoformat()} 00:00:00").cast(T.TimestampNTZType())

    def date_days_ago(self, days: int = 0):
        return F.lit(self.as_of - dt.timedelta(days=days))

    # -- retail tables ---------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(*_x(*ORDER_COLS))

    @cached_property
    def valid_orders(self) -> DataFrame:
        """``orders WHERE order_status != 'Cancelled'`` with the predicate
        stated on the stored status code, so it reaches the Parquet scan."""
        return (self.raw("orders")
                .where(F.col("o_orderstatus").isin(*VALID_STATUS_CODES))
                .select(*_x(*ORDER_COLS)))

    @cached_property
    def orders_not_cancelled_or_null(self) -> DataFrame:
        """``orders WHERE order_status != 'Cancelled' OR order_status IS NULL``
        (the filter the reference applies after its outer joins)."""
        code = F.col("o_orderstatus")
        return (self.raw("orders").where(code.isNull() | ~code.isin("P"))
                .select(*_x(*ORDER_COLS)))

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("lineitem").select(*_x(*ITEM_COLS))

    @cached_property
    def categories(self) -> DataFrame:
        """Two-level category tree. Ids are dense ranks over (level, name):
        the tree holds one row per distinct p_type and p_type/p_brand, so it
        stays small however large ``part`` grows; the windows run on it only
        after the distinct aggregation."""
        pt = self.raw("part").select("p_type", "p_brand").distinct()
        names = (pt.select(F.explode(F.array(
                    F.struct(F.lit(0).alias("lvl"), F.col("p_type").alias("category_name"),
                             F.lit(None).cast("string").alias("parent_name")),
                    F.struct(F.lit(1).alias("lvl"),
                             F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("category_name"),
                             F.col("p_type").alias("parent_name")))).alias("c"))
                 .select("c.*").distinct()
                 .unionByName(self.spark.range(1).select(
                     F.lit(2).alias("lvl"), F.lit("EMPTY").alias("category_name"),
                     F.lit(None).cast("string").alias("parent_name"))))
        by_name = Window.orderBy("lvl", "category_name")
        by_parent = Window.orderBy(F.when(F.col("lvl") == 2, 1).otherwise(0),
                                   F.coalesce("parent_name", "category_name"))
        return names.select(
            F.dense_rank().over(by_name).cast("bigint").alias("category_id"),
            "category_name",
            F.when(F.col("lvl") == 1, F.dense_rank().over(by_parent)).cast("bigint")
             .alias("parent_category_id"),
            "lvl",
        )

    @cached_property
    def products(self) -> DataFrame:
        leaves = (self.categories.where(F.col("lvl") == 1)
                  .select(F.col("category_name").alias("_leaf"), "category_id"))
        p = self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("_leaf"),
            F.expr(PRICE_EXPR).alias("price"),
            F.expr(COST_EXPR).alias("cost"),
            F.expr(PRICE_CENTS_EXPR).alias("price_cents"),
            (F.expr(PRICE_CENTS_EXPR) * 6).alias("cost_e3"),   # cost = price x 0.6, scale 3
            F.col("p_brand").alias("supplier"),
            F.col("p_size").cast("decimal(5,2)").alias("weight_kg"),
            (F.col("p_size") <= 45).alias("is_active"),
        )
        return p.join(leaves, "_leaf", "left").drop("_leaf")

    @cached_property
    def products_named(self) -> DataFrame:
        """Products with their leaf ``category_name`` instead of ``category_id``.
        The leaf name is ``p_type/p_brand`` of the part itself, so no join with
        the category tree is needed when only the name is reported."""
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("category_name"),
            F.expr(PRICE_CENTS_EXPR).alias("price_cents"), (F.expr(PRICE_CENTS_EXPR) * 6).alias("cost_e3"),
            (F.col("p_size") <= 45).alias("is_active"))

    @cached_property
    def product_names(self) -> DataFrame:
        """``products`` reduced to id and name: same rows, no category join
        (Catalyst keeps an outer join even when none of its columns is used)."""
        return self.raw("part").select(F.col("p_partkey").alias("product_id"),
                                       F.col("p_name").alias("product_name"))

    @cached_property
    def customers(self) -> DataFrame:
        """Customers without ``signup_date`` (see :attr:`customers_full`)."""
        # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions
        nation = F.broadcast(self.raw("nation"))
        region = F.broadcast(self.raw("region"))
        c = (self.raw("customer")
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("n_name").alias("last_name"),
            F.expr("'customer' || CAST(c_custkey AS STRING) || '@email.com'").alias("email"),
            F.expr("'+1-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')").alias("phone"),
            F.col("r_name").alias("country"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("customer_segment"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )

    @cached_property
    def customers_full(self) -> DataFrame:
        """Customers with ``signup_date``: first signup event, else first order."""
        ev = (self.raw("events").where(F.col("event_type") == "signup")
              .groupBy(F.col("user_id").alias("customer_id"))
              .agg(F.min(F.to_date("ts")).alias("_ev")))
        first = (self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id"))
                 .agg(F.min(F.to_date("o_orderdate")).alias("_fo")))
        return (self.customers.join(ev, "customer_id", "left").join(first, "customer_id", "left")
                .withColumn("signup_date", F.coalesce("_ev", "_fo")).drop("_ev", "_fo"))

    @cached_property
    def campaigns(self) -> DataFrame:
        rows = [(i, n, ty, dt.date.fromisoformat(s), dt.date.fromisoformat(e), Decimal(b), ch,
                 int(Decimal(b) * 100)) for i, n, ty, s, e, b, ch in CAMPAIGNS]
        # ten literal rows: broadcasting them is bounded by construction
        return F.broadcast(self.spark.createDataFrame(rows, CAMPAIGN_SCHEMA))

    @cached_property
    def interactions(self) -> DataFrame:
        """customer_campaigns: one interaction per click event."""
        e = self.raw("events").where(F.col("event_type") == "click")
        return e.select(
            F.col("event_id").alias("attribution_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 10 + 1).alias("campaign_id"),
            F.col("ts").alias("interaction_date"),
            F.expr(f"CASE WHEN {CONVERTS_EXPR} THEN "
                   "timestampadd(DAY, CAST(event_id % 30 AS INT), ts) END").alias("conversion_date"),
        )

    @cached_property
    def shipping(self) -> DataFrame:
        o = (self.raw("orders").where(F.col("o_orderstatus") == "F")
             .select("o_orderkey", "o_orderdate"))
        li = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        return j.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.date_add(F.to_date("o_orderdate"), 1).alias("shipping_date"),
            F.to_date("l_shipdate").alias("delivery_date"),
            F.date_add(F.to_date("o_orderdate"), 5).alias("estimated_delivery"),
            F.expr(CARRIER_EXPR).alias("carrier"),
            F.expr("'TRK' || lpad(CAST(o_orderkey AS STRING), 10, '0')").alias("tracking_number"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        o = (self.raw("orders").where(F.col("o_orderstatus") == "F")
             .select("o_orderkey", "o_custkey", "o_orderdate"))
        li = self.raw("lineitem").select("l_orderkey", "l_partkey")
        # grouping by (order, product) right after the join on order needs no
        # further shuffle: hash(order) already clusters the pair
        pairs = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                 .select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                         F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("_od"))
                 .distinct())
        return pairs.select(
            "product_id", "customer_id", "order_id",
            F.expr(RATING_EXPR).alias("rating"),
            F.expr(REVIEW_TEXT_EXPR).alias("review_text"),
            F.expr("timestampadd(DAY, CAST(product_id % 30 AS INT), _od)").alias("review_date"),
            F.lit(True).alias("is_verified_purchase"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.raw("part").select(
            *_x(*INVENTORY_COLS),
            F.date_add(F.lit(dt.date.fromisoformat(RESTOCK_BASE)),
                       (F.col("p_partkey") % 90).cast("int")).alias("last_restock_date"),
        )


# ---------------------------------------------------------------------------
# DuckDB text of the same bindings (for oracle_sql)
# ---------------------------------------------------------------------------
def _campaign_values() -> str:
    rows = ",\n      ".join(
        f"({i}, '{n}', '{ty}', DATE '{s}', DATE '{e}', CAST({b} AS DECIMAL(10,2)), '{ch}')"
        for i, n, ty, s, e, b, ch in CAMPAIGNS)
    return rows


BIND_SQL: dict[str, str] = {
    "b_orders": f"SELECT {_sql_cols(*ORDER_COLS)} FROM orders",
    "b_items": f"SELECT {_sql_cols(*ITEM_COLS)} FROM lineitem",
    "b_categories": """SELECT CAST(dense_rank() OVER (ORDER BY lvl, category_name) AS BIGINT) AS category_id,
    category_name,
    CASE WHEN lvl = 1 THEN CAST(dense_rank() OVER (ORDER BY CASE WHEN lvl = 2 THEN 1 ELSE 0 END,
        COALESCE(parent_name, category_name)) AS BIGINT) END AS parent_category_id,
    lvl
  FROM (SELECT DISTINCT 0 AS lvl, p_type AS category_name, CAST(NULL AS VARCHAR) AS parent_name FROM part
        UNION ALL SELECT DISTINCT 1, p_type || '/' || p_brand, p_type FROM part
        UNION ALL SELECT 2, 'EMPTY', CAST(NULL AS VARCHAR)) names""",
    "b_products": f"""SELECT p_partkey AS product_id, p_name AS product_name,
    {PRICE_EXPR} AS price, {COST_EXPR} AS cost, {PRICE_CENTS_EXPR} AS price_cents,
    {PRICE_CENTS_EXPR} * 6 AS cost_e3, p_brand AS supplier,
    CAST(p_size AS DECIMAL(5,2)) AS weight_kg, p_size <= 45 AS is_active, c.category_id
  FROM part LEFT JOIN b_categories c ON c.lvl = 1 AND c.category_name = p_type || '/' || p_brand""",
    "b_customers": """SELECT c_custkey AS customer_id, c_name AS first_name, n_name AS last_name,
    'customer' || CAST(c_custkey AS VARCHAR) || '@email.com' AS email,
    '+1-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
    r_name AS country, r_name AS state, n_name AS city, c_mktsegment AS customer_segment,
    c_acctbal >= 0 AS is_active,
    COALESCE((SELECT MIN(CAST(ts AS DATE)) FROM events e WHERE e.event_type = 'signup' AND e.user_id = c_custkey),
             (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders o WHERE o.o_custkey = c_custkey)) AS signup_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey""",
    "b_campaigns": ("SELECT CAST(campaign_id AS BIGINT) AS campaign_id, campaign_name, campaign_type, "
                    "start_date, end_date, budget, channel FROM (VALUES\n      " + _campaign_values()
                    + "\n  ) v(campaign_id, campaign_name, campaign_type, start_date, end_date, budget, channel)"),
    "b_interactions": f"""SELECT event_id AS attribution_id, user_id AS customer_id,
    event_id % 10 + 1 AS campaign_id, ts AS interaction_date,
    CASE WHEN {CONVERTS_EXPR} THEN ts + to_days(CAST(event_id % 30 AS INTEGER)) END AS conversion_date
  FROM events WHERE event_type = 'click'""",
    "b_shipping": f"""SELECT l_orderkey AS order_id, l_linenumber AS line_number,
    CAST(o_orderdate AS DATE) + 1 AS shipping_date, CAST(l_shipdate AS DATE) AS delivery_date,
    CAST(o_orderdate AS DATE) + 5 AS estimated_delivery, {CARRIER_EXPR} AS carrier,
    'TRK' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS tracking_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
    "b_reviews": f"""SELECT product_id, customer_id, order_id, {RATING_EXPR} AS rating,
    {REVIEW_TEXT_EXPR} AS review_text,
    _od + to_days(CAST(product_id % 30 AS INTEGER)) AS review_date, TRUE AS is_verified_purchase
  FROM (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
               o_orderdate AS _od
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F') d""",
    "b_inventory": f"""SELECT {_sql_cols(*INVENTORY_COLS)},
    DATE '{RESTOCK_BASE}' + CAST(p_partkey % 90 AS INTEGER) AS last_restock_date
  FROM part""",
}
BIND_DEPS = {"b_products": ("b_categories",)}
BIND_ORDER = ("b_orders", "b_items", "b_categories", "b_products", "b_customers", "b_campaigns",
              "b_interactions", "b_shipping", "b_reviews", "b_inventory")
