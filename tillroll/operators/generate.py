"""Seeded data generators: the reference's procedural random loaders rebuilt
as set operations.

Every random choice is a hash of (seed, row id, salt) — reproducible, and
computed inside the tasks that produce the rows, so generating a billion
orders is one distributed job (``spark.range`` partitions the ids), not a
driver loop. Orders, items and shipments come out together; order totals are
aggregated from their items with one ``groupBy``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.sqltext import oracle
from tillroll.registry import query
from tillroll.sources.bind import CAMPAIGN_SCHEMA, CAMPAIGNS, REVIEW_TEXTS, Tables

# The reference's category tree (name, parent name), in its order.
CATEGORY_TREE = (
    ("Electronics", None), ("Computers", "Electronics"), ("Phones & Tablets", "Electronics"),
    ("Audio", "Electronics"), ("Clothing", None), ("Men's Clothing", "Clothing"),
    ("Women's Clothing", "Clothing"), ("Home & Garden", None), ("Furniture", "Home & Garden"),
    ("Kitchen", "Home & Garden"), ("Sports & Outdoors", None), ("Fitness", "Sports & Outdoors"),
    ("Camping", "Sports & Outdoors"), ("Books", None), ("Toys & Games", None),
)
# The reference's name, place, status and payment vocabularies.
FIRST_NAMES = ("John", "Jane", "Michael", "Sarah", "David", "Emily", "Chris", "Jessica", "Daniel",
               "Ashley", "Matthew", "Amanda", "James", "Melissa", "Robert", "Linda", "William",
               "Jennifer", "Richard", "Lisa")
LAST_NAMES = ("Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
              "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson")
STATES = ("California", "Texas", "New York", "Florida", "Illinois")
CITIES = ("Los Angeles", "Houston", "New York City", "Miami", "Chicago")
WAREHOUSES = ("East Warehouse", "West Warehouse", "Central Warehouse")
PAYMENT_METHODS = ("Credit Card", "PayPal", "Bank Transfer")
CARRIERS = ("FedEx", "UPS", "USPS", "DHL")
EPOCH = dt.date(2024, 1, 1)


def _u(seed: int, salt: int, *cols) -> Column:
    """Uniform [0, 1) from the upper 53 bits of a hash of (seed, salt, cols)."""
    h = F.xxhash64(F.lit(seed), F.lit(salt), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def _pick(values, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def seed_catalog(spark: SparkSession, products_per_leaf: int = 5, seed: int = 1) -> dict[str, DataFrame]:
    """Categories (the fixed tree), campaigns (the fixed ten) and a product
    catalogue made by rule: ``products_per_leaf`` per leaf category."""
    ids = {n: i + 1 for i, (n, _) in enumerate(CATEGORY_TREE)}
    cats = spark.createDataFrame([(ids[n], n, ids.get(p)) for n, p in CATEGORY_TREE],
                                 "category_id bigint, category_name string, parent_category_id bigint")
    leaves = cats.where(~F.col("category_id").isin(*{ids[p] for _, p in CATEGORY_TREE if p}))
    prods = (leaves.select("category_id", "category_name",
                           F.explode(F.sequence(F.lit(1), F.lit(products_per_leaf))).alias("k"))
             .select(F.concat("category_name", F.lit(" #"), F.col("k").cast("string")).alias("product_name"),
                     "category_id",
                     (F.floor(_u(seed, 1, "category_id", "k") * 1990 + 10) + 0.99)
                     .cast("decimal(10,2)").alias("price")))
    # the catalogue holds products_per_leaf x leaves rows: bounded, one window is fine
    prods = (prods.withColumn("product_id", F.row_number().over(Window.orderBy("category_id", "product_name"))
                              .cast("bigint"))
             .withColumn("cost", (F.col("price") * F.lit(Decimal("0.5"))).cast("decimal(10,2)")))
    camps = spark.createDataFrame(
        [(i, n, ty, dt.date.fromisoformat(s), dt.date.fromisoformat(e), Decimal(b), ch, int(Decimal(b) * 100))
         for i, n, ty, s, e, b, ch in CAMPAIGNS], CAMPAIGN_SCHEMA)
    return {"categories": cats, "products": prods, "marketing_campaigns": camps}


def synth_dimensions(spark: SparkSession, products: DataFrame, n_customers: int = 200,
                     n_interactions: int = 300, seed: int = 2) -> dict[str, DataFrame]:
    """Customers, inventory (one row per product) and campaign interactions."""
    c = spark.range(1, n_customers + 1).withColumnRenamed("id", "customer_id")
    customers = c.select(
        "customer_id",
        F.element_at(F.array(*[F.lit(v) for v in FIRST_NAMES]), (F.col("customer_id") % 20 + 1).cast("int"))
        .alias("first_name"),
        F.element_at(F.array(*[F.lit(v) for v in LAST_NAMES]), (F.col("customer_id") % 15 + 1).cast("int"))
        .alias("last_name"),
        F.concat(F.lit("customer"), F.col("customer_id").cast("string"), F.lit("@email.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(F.col("customer_id").cast("string"), 4, "0")).alias("phone"),
        F.lit("USA").alias("country"),
        F.element_at(F.array(*[F.lit(v) for v in STATES]), (F.col("customer_id") % 5 + 1).cast("int")).alias("state"),
        F.element_at(F.array(*[F.lit(v) for v in CITIES]), (F.col("customer_id") % 5 + 1).cast("int")).alias("city"),
        F.date_sub(F.lit(EPOCH), F.floor(_u(seed, 1, "customer_id") * 730 + 30).cast("int")).alias("signup_date"),
        F.when(_u(seed, 2, "customer_id") < 0.1, "VIP").when(_u(seed, 3, "customer_id") < 0.3, "New")
         .otherwise("Regular").alias("customer_segment"),
        F.lit(True).alias("is_active"))
    inventory = products.select(
        F.col("product_id").alias("inventory_id"), "product_id",
        F.element_at(F.array(*[F.lit(v) for v in WAREHOUSES]), (F.col("product_id") % 3 + 1).cast("int"))
        .alias("warehouse_location"),
        F.floor(_u(seed, 4, "product_id") * 500 + 50).cast("int").alias("quantity_available"),
        F.lit(50).alias("reorder_level"),
        F.date_sub(F.lit(EPOCH), F.floor(_u(seed, 5, "product_id") * 90).cast("int")).alias("last_restock_date"))
    i = spark.range(1, n_interactions + 1).withColumnRenamed("id", "attribution_id")
    day = lambda salt: F.timestamp_add("DAY", F.floor(_u(seed, salt, "attribution_id") * 365).cast("int"),
                                       F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz"))
    interactions = i.select(
        "attribution_id",
        (F.floor(_u(seed, 6, "attribution_id") * n_customers) + 1).cast("bigint").alias("customer_id"),
        (F.floor(_u(seed, 7, "attribution_id") * 10) + 1).cast("bigint").alias("campaign_id"),
        day(8).alias("interaction_date"),
        F.when(_u(seed, 9, "attribution_id") < 0.6, day(10)).alias("conversion_date"))
    return {"customers": customers, "inventory": inventory, "customer_campaigns": interactions}


def synth_orders(spark: SparkSession, products: DataFrame, n_orders: int = 1000, n_customers: int = 200,
                 seed: int = 3) -> dict[str, DataFrame]:
    """Orders with 1-5 items each, item discounts, taxes, totals and, for
    delivered orders, a shipment — the reference's nested loop as one plan."""
    o = spark.range(1, n_orders + 1).withColumnRenamed("id", "order_id")
    u = lambda salt, *c: _u(seed, salt, "order_id", *c)
    head = o.select(
        "order_id",
        (F.floor(u(1) * n_customers) + 1).cast("bigint").alias("customer_id"),
        F.timestamp_add("DAY", F.floor(u(2) * 365).cast("int"),
                        F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz")).alias("order_date"),
        F.when(u(3) < 0.1, "Cancelled").when(u(3) < 0.2, "Pending").otherwise("Delivered").alias("order_status"),
        _pick(PAYMENT_METHODS, u(4)).alias("payment_method"),
        F.when(u(5) < 0.7, (F.floor(u(6) * 10) + 1).cast("bigint")).alias("campaign_id"),
        F.when(u(7) < 0.3, F.floor(u(8) * 5000) / 100).otherwise(0).cast("decimal(10,2)").alias("discount_amount"),
        ((F.floor(u(9) * 2000) + 500) / 100).cast("decimal(10,2)").alias("shipping_cost"),
        F.floor(u(10) * 5 + 1).cast("int").alias("_n_items"))
    # product ids are dense 1..P in the catalogue; P comes from a one-row
    # aggregate joined on a constant key (no driver round trip)
    p_count = products.agg(F.max("product_id").alias("_p")).withColumn("_k", F.lit(1))
    lines = (head.select("order_id", F.explode(F.sequence(F.lit(1), "_n_items")).alias("line"))
             .withColumn("_k", F.lit(1)).join(F.broadcast(p_count), "_k"))
    ul = lambda salt: _u(seed, salt, "order_id", "line")
    lines = lines.select(
        "order_id", "line",
        (F.floor(ul(11) * F.col("_p")) + 1).cast("bigint").alias("product_id"),
        F.floor(ul(12) * 3 + 1).cast("int").alias("quantity"), F.col("line").alias("_l"),
        ul(13).alias("_d1"), ul(14).alias("_d2"))
    items = (lines.join(products.select("product_id", F.col("price").alias("unit_price")), "product_id")
             .withColumn("discount", F.when(F.col("_d1") < 0.2,
                                            F.round(F.col("_d2") * 0.2 * F.col("unit_price"), 2))
                         .otherwise(0).cast("decimal(10,2)"))
             .withColumn("subtotal", F.round(F.col("unit_price") * F.col("quantity") - F.col("discount"), 2)
                         .cast("decimal(10,2)"))
             .select((F.col("order_id") * 10 + F.col("line")).alias("order_item_id"), "order_id", "product_id",
                     "quantity", "unit_price", "discount", "subtotal"))
    sums = items.groupBy("order_id").agg(F.sum("subtotal").alias("_items"))
    orders = (head.drop("_n_items").join(sums, "order_id", "left")
              .withColumn("tax_amount", F.round(F.coalesce("_items", F.lit(0)) * F.lit(Decimal("0.08")), 2)
                          .cast("decimal(10,2)"))
              .withColumn("total_amount", F.round(F.coalesce("_items", F.lit(0)) * F.lit(Decimal("1.08"))
                                                  + F.col("shipping_cost"), 2).cast("decimal(10,2)"))
              .drop("_items"))
    shipping = orders.where(F.col("order_status").isin("Delivered", "Shipped")).select(
        "order_id",
        F.date_add(F.to_date("order_date"), 1).alias("shipping_date"),
        F.date_add(F.to_date("order_date"), F.floor(_u(seed, 15, "order_id") * 7 + 2).cast("int"))
        .alias("delivery_date"),
        F.date_add(F.to_date("order_date"), 5).alias("estimated_delivery"),
        _pick(CARRIERS, _u(seed, 16, "order_id")).alias("carrier"),
        F.concat(F.lit("TRK"), F.lpad(F.col("order_id").cast("string"), 10, "0")).alias("tracking_number"),
        F.lit("123 Main St, City, State, ZIP").alias("shipping_address"))
    return {"orders": orders, "order_items": items, "shipping": shipping}


# --------------------------------------------------------------------------
_SAMPLE = "((order_id % 1000003) * 7919 + (product_id % 1000003) * 104729 + 17) % 100 < 60"
_TEXT = ("CASE (order_id * 7 + product_id) % 5 "
         + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(REVIEW_TEXTS[:4]))
         + f" ELSE '{REVIEW_TEXTS[4]}' END")


@query("synth_reviews", oracle(f"""
SELECT product_id, customer_id, order_id,
       CAST(3 + (order_id + 3 * product_id) % 3 AS INT) AS rating,
       {_TEXT} AS review_text,
       order_date + to_days(CAST((order_id + 13 * product_id) % 31 AS INTEGER)) AS review_date
FROM (SELECT DISTINCT oi.order_id, oi.product_id, o.customer_id, o.order_date
      FROM b_items oi JOIN b_orders o ON oi.order_id = o.order_id
      WHERE o.order_status = 'Delivered') d
WHERE {_SAMPLE}"""))
def synth_reviews(t: Tables, limit: int | None = None) -> DataFrame:
    """Reviews for a 60 % sample of distinct delivered (order, product)
    pairs (the ``limit`` smallest, if one is given), rating 3-5, one of the five texts, dated 0-30 days after the order. The sample
    is a deterministic arithmetic hash of the pair, so reruns agree."""
    pairs = (t.items.select("order_id", "product_id")
             .join(t.orders.where(F.col("order_status") == "Delivered")
                   .select("order_id", "customer_id", "order_date"), "order_id")
             .distinct()
             .where(F.expr(_SAMPLE)))
    if limit is not None:
        pairs = pairs.orderBy("order_id", "product_id").limit(limit)
    return (pairs.select("product_id", "customer_id", "order_id",
                    F.expr("CAST(3 + (order_id + 3 * product_id) % 3 AS INT)").alias("rating"),
                    F.expr(_TEXT).alias("review_text"),
                    F.expr("timestampadd(DAY, CAST((order_id + 13 * product_id) % 31 AS INT), order_date)")
                    .alias("review_date")))
