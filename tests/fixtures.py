"""Tiny hand-made retail tables (FIXTURES.md F-A) injected into ``Tables``."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tillroll import Tables

D = Decimal


def _cents(x, scale=2):
    return int(D(str(x)) * (10 ** scale))


ORDERS = T.StructType([T.StructField(n, t) for n, t in [
    ("order_id", T.LongType()), ("customer_id", T.LongType()), ("order_date", T.TimestampNTZType()),
    ("order_status", T.StringType()), ("payment_method", T.StringType()), ("campaign_id", T.LongType()),
    ("discount_amount", T.DecimalType(12, 2)), ("shipping_cost", T.DecimalType(12, 2)),
    ("tax_amount", T.DecimalType(12, 2)), ("total_amount", T.DecimalType(12, 2)),
    ("total_cents", T.LongType()), ("discount_cents", T.LongType()), ("shipping_cents", T.LongType()),
    ("tax_cents", T.LongType())]])
ITEMS = T.StructType([T.StructField(n, t) for n, t in [
    ("order_id", T.LongType()), ("product_id", T.LongType()), ("line_number", T.IntegerType()),
    ("quantity", T.LongType()), ("unit_price", T.DecimalType(12, 2)), ("discount", T.DecimalType(12, 4)),
    ("subtotal", T.DecimalType(12, 4)), ("unit_price_cents", T.LongType()), ("subtotal_e4", T.LongType()),
    ("discount_e4", T.LongType())]])
PRODUCTS = T.StructType([T.StructField(n, t) for n, t in [
    ("product_id", T.LongType()), ("product_name", T.StringType()), ("price", T.DecimalType(10, 2)),
    ("cost", T.DecimalType(13, 3)), ("price_cents", T.LongType()), ("cost_e3", T.LongType()),
    ("supplier", T.StringType()), ("weight_kg", T.DecimalType(5, 2)), ("is_active", T.BooleanType()),
    ("category_id", T.LongType())]])
CATEGORIES = T.StructType([T.StructField(n, t) for n, t in [
    ("category_id", T.LongType()), ("category_name", T.StringType()),
    ("parent_category_id", T.LongType()), ("lvl", T.IntegerType())]])
CUSTOMERS = T.StructType([T.StructField(n, t) for n, t in [
    ("customer_id", T.LongType()), ("first_name", T.StringType()), ("last_name", T.StringType()),
    ("email", T.StringType()), ("phone", T.StringType()), ("country", T.StringType()),
    ("state", T.StringType()), ("city", T.StringType()), ("customer_segment", T.StringType()),
    ("is_active", T.BooleanType()), ("signup_date", T.DateType())]])
INTERACTIONS = T.StructType([T.StructField(n, t) for n, t in [
    ("attribution_id", T.LongType()), ("customer_id", T.LongType()), ("campaign_id", T.LongType()),
    ("interaction_date", T.TimestampNTZType()), ("conversion_date", T.TimestampNTZType())]])
REVIEWS = T.StructType([T.StructField(n, t) for n, t in [
    ("product_id", T.LongType()), ("customer_id", T.LongType()), ("order_id", T.LongType()),
    ("rating", T.IntegerType()), ("review_text", T.StringType()), ("review_date", T.TimestampNTZType()),
    ("is_verified_purchase", T.BooleanType())]])
INVENTORY = T.StructType([T.StructField(n, t) for n, t in [
    ("inventory_id", T.LongType()), ("product_id", T.LongType()), ("warehouse_location", T.StringType()),
    ("quantity_available", T.IntegerType()), ("reorder_level", T.IntegerType()),
    ("last_restock_date", T.DateType())]])
SHIPPING = T.StructType([T.StructField(n, t) for n, t in [
    ("order_id", T.LongType()), ("line_number", T.IntegerType()), ("shipping_date", T.DateType()),
    ("delivery_date", T.DateType()), ("estimated_delivery", T.DateType()), ("carrier", T.StringType()),
    ("tracking_number", T.StringType())]])


def order(oid, cust, when, status, total, campaign=None):
    c = _cents(total)
    return (oid, cust, when, status, "Credit Card", campaign, D("0.00"), D("5.00"), D("0.00"), D(str(total)),
            c, 0, 500, 0)


def item(oid, pid, line, qty, price):
    pc = _cents(price)
    return (oid, pid, line, qty, D(str(price)), D("0"), D(str(price)) * qty, pc, pc * qty * 100, 0)


def product(pid, name, price, cat=1):
    pc = _cents(price)
    return (pid, name, D(str(price)), D(str(price)) * D("0.6"), pc, pc * 6, "S", D("1.00"), True, cat)


def customer(cid, segment="Regular", signup=dt.date(2024, 1, 1)):
    return (cid, f"First{cid}", f"Last{cid}", f"customer{cid}@email.com", None, "X", "S", "C", segment,
            True, signup)


def fixture_tables(spark, *, orders=(), items=(), products=(), categories=None, customers=(),
                   interactions=(), reviews=(), inventory=(), shipping=(), as_of=dt.date(2024, 3, 1)):
    t = Tables(spark, "/nonexistent", as_of=as_of)
    o = spark.createDataFrame(list(orders), ORDERS)
    cats = categories if categories is not None else [(1, "Cat/A", None, 1)]
    frames = {
        "orders": o,
        "valid_orders": o.where("order_status != 'Cancelled'"),
        "orders_not_cancelled_or_null": o.where("order_status != 'Cancelled' OR order_status IS NULL"),
        "items": spark.createDataFrame(list(items), ITEMS),
        "products": spark.createDataFrame(list(products), PRODUCTS),
        "categories": spark.createDataFrame(list(cats), CATEGORIES),
        "interactions": spark.createDataFrame(list(interactions), INTERACTIONS),
        "reviews": spark.createDataFrame(list(reviews), REVIEWS),
        "inventory": spark.createDataFrame(list(inventory), INVENTORY),
        "shipping": spark.createDataFrame(list(shipping), SHIPPING),
    }
    frames["product_names"] = frames["products"].select("product_id", "product_name")
    frames["products_named"] = (frames["products"].join(frames["categories"], "category_id")
                                .select("product_id", "product_name", "category_name", "price_cents",
                                        "cost_e3", "is_active"))
    cu = spark.createDataFrame(list(customers), CUSTOMERS)
    frames["customers_full"] = cu
    frames["customers"] = cu.drop("signup_date")
    t.__dict__.update(frames)   # overrides the lazy driver-backed properties
    return t
