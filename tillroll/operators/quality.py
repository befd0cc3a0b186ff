"""Data-quality audits: the reference schema's constraints (primary and
foreign keys, UNIQUE, NOT NULL, CHECK, lengths and decimal precision,
defaults, the order-total invariant) checked as distributed aggregations
over the bound tables. Each audit is one aggregate per table, unioned.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.common import count_if, dollars, rnd
from tillroll.functions.sqltext import R, TS_AGO, oracle
from tillroll.registry import query
from tillroll.sources.bind import Tables

# retail table -> (Tables attribute, binding CTE)
TABLES = {
    "categories": ("categories", "b_categories"),
    "products": ("products", "b_products"),
    "inventory": ("inventory", "b_inventory"),
    "customers": ("customers_full", "b_customers"),
    "marketing_campaigns": ("campaigns", "b_campaigns"),
    "customer_campaigns": ("interactions", "b_interactions"),
    "orders": ("orders", "b_orders"),
    "order_items": ("items", "b_items"),
    "shipping": ("shipping", "b_shipping"),
    "reviews": ("reviews", "b_reviews"),
}


def _df(t: Tables, table: str) -> DataFrame:
    return getattr(t, TABLES[table][0])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _sql_union(parts: list[str]) -> str:
    return oracle("\nUNION ALL\n".join(parts))


# --------------------------------------------------------------------------
# primary keys (order_items, shipping and reviews have no surrogate key in
# the bound data: their natural keys are audited)
# Primary keys of the source schema (natural keys where it has surrogates that the inputs lack).
PRIMARY_KEYS = (
    ("categories", ("category_id",)), ("products", ("product_id",)),
    ("inventory", ("inventory_id",)), ("customers", ("customer_id",)),
    ("marketing_campaigns", ("campaign_id",)), ("customer_campaigns", ("attribution_id",)),
    ("orders", ("order_id",)), ("order_items", ("order_id", "line_number")),
    ("shipping", ("order_id", "line_number")), ("reviews", ("order_id", "product_id")),
)


def _pk_sql(table: str, keys: tuple[str, ...]) -> str:
    k = ", ".join(keys)
    null = " OR ".join(f"{c} IS NULL" for c in keys)
    return f"""SELECT '{table}' AS table_name, '{k}' AS key_columns, CAST(SUM(c) AS BIGINT) AS total_rows,
       CAST(COALESCE(SUM(CASE WHEN nk THEN c END), 0) AS BIGINT) AS null_keys,
       COUNT(CASE WHEN c > 1 AND NOT nk THEN 1 END) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN c > 1 AND NOT nk THEN c - 1 END), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {k}, COUNT(*) AS c, ({null}) AS nk FROM {TABLES[table][1]} GROUP BY {k}) g"""


@query("dq_primary_key", _sql_union([_pk_sql(tb, ks) for tb, ks in PRIMARY_KEYS]))
def dq_primary_key(t: Tables) -> DataFrame:
    parts = []
    for table, keys in PRIMARY_KEYS:
        nk = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
        g = _df(t, table).groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).withColumn("nk", nk)
        dup = (F.col("c") > 1) & ~F.col("nk")
        parts.append(g.agg(
            F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"),
            F.sum("c").cast("bigint").alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("nk"), F.col("c"))), F.lit(0)).cast("bigint").alias("null_keys"),
            count_if(dup).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(dup, F.col("c") - 1)), F.lit(0)).cast("bigint").alias("duplicate_rows")))
    return _union(parts)


# --------------------------------------------------------------------------
# Foreign keys of the source schema (child, column, parent, column).
FOREIGN_KEYS = (
    ("categories", "parent_category_id", "categories", "category_id"),
    ("products", "category_id", "categories", "category_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("customer_campaigns", "customer_id", "customers", "customer_id"),
    ("customer_campaigns", "campaign_id", "marketing_campaigns", "campaign_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "campaign_id", "marketing_campaigns", "campaign_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("shipping", "order_id", "orders", "order_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("reviews", "customer_id", "customers", "customer_id"),
    ("reviews", "order_id", "orders", "order_id"),
)


def _fk_sql(child: str, col: str, parent: str, pcol: str) -> str:
    return f"""SELECT '{child}.{col} -> {parent}.{pcol}' AS constraint_name,
       COUNT(*) AS checked_rows, COUNT(CASE WHEN p.k IS NULL THEN 1 END) AS orphan_rows
FROM {TABLES[child][1]} c LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM {TABLES[parent][1]}) p ON c.{col} = p.k
WHERE c.{col} IS NOT NULL"""


@query("dq_foreign_key", _sql_union([_fk_sql(*fk) for fk in FOREIGN_KEYS]))
def dq_foreign_key(t: Tables) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Every table is read once as a child, which gives (parent, key) references
    counted per constraint, and once as a parent, whose distinct keys are one
    table with those of the others: a single join answers all constraints."""
    by_child: dict[str, list[tuple[int, str, int]]] = {}
    parents: dict[tuple[str, str], int] = {}
    for i, (child, col, parent, pcol) in enumerate(FOREIGN_KEYS):
        by_child.setdefault(child, []).append((i, col, parents.setdefault((parent, pcol), len(parents))))

    def pairs(df: DataFrame, rows: list) -> DataFrame:
        return df.select(F.explode(F.array(*rows)).alias("x")).select("x.*").where("k IS NOT NULL")

    refs = _union([pairs(_df(t, child).select(*dict.fromkeys(c for _, c, _ in rules)), [
        F.struct(F.lit(i).alias("rule"), F.lit(p).alias("parent"), F.col(c).cast("bigint").alias("k")) for i, c, p in rules])
        for child, rules in by_child.items()])
    by_parent: dict[str, list[tuple[int, str]]] = {}
    for (parent, pcol), p in parents.items():
        by_parent.setdefault(parent, []).append((p, pcol))
    keys = _union([pairs(_df(t, parent).select(*[c for _, c in cols]), [
        F.struct(F.lit(p).alias("parent"), F.col(c).cast("bigint").alias("k")) for p, c in cols])
        for parent, cols in by_parent.items()]).distinct().withColumn("found", F.lit(1))
    met = refs.groupBy("parent", "k", "rule").agg(F.count(F.lit(1)).alias("n")).join(keys, ["parent", "k"], "left")
    counted = met.groupBy("rule").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("found").isNull(), F.col("n"))).alias("o"))
    rules = t.spark.range(len(FOREIGN_KEYS)).select(F.col("id").cast("int").alias("rule"), F.element_at(F.array(*[
        F.lit(f"{child}.{col} -> {parent}.{pcol}") for child, col, parent, pcol in FOREIGN_KEYS]), F.col("id").cast("int") + 1).alias("constraint_name"))
    return rules.join(counted, "rule", "left").select(
        "constraint_name", F.coalesce("n", F.lit(0)).alias("checked_rows"), F.coalesce("o", F.lit(0)).alias("orphan_rows"))


# --------------------------------------------------------------------------
def _dup_sql(rule: str, col: str, source: str) -> str:
    return (f"SELECT '{rule}' AS rule, COUNT(*) AS duplicate_values FROM (SELECT {col} FROM {source} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1) d")


@query("dq_unique", oracle("\nUNION ALL\n".join([
    _dup_sql("customers.email", "email", "b_customers"),
    _dup_sql("mv_monthly_revenue.month", "m",
             "(SELECT CAST(date_trunc('month', order_date) AS DATE) AS m FROM b_orders "
             "WHERE order_status != 'Cancelled' GROUP BY 1) mv"),
    _dup_sql("mv_category_performance.category_id", "category_id",
             "(SELECT c.category_id FROM b_categories c JOIN b_products p ON c.category_id = p.category_id "
             "GROUP BY c.category_id, c.category_name) mv")])))
def dq_unique(t: Tables) -> DataFrame:
    """UNIQUE(email) and the unique indexes of the two materialized views
    (month; category_id), checked on the views as built."""
    from tillroll.plans.views import mv_category_performance, mv_monthly_revenue

    def dups(df: DataFrame, col: str, rule: str) -> DataFrame:
        d = (df.select(col).where(F.col(col).isNotNull()).groupBy(col)
             .agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1))
        return d.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("duplicate_values"))
    return _union([dups(t.customers, "email", "customers.email"),
                   dups(mv_monthly_revenue(t), "month", "mv_monthly_revenue.month"),
                   dups(mv_category_performance(t), "category_id", "mv_category_performance.category_id")])


# --------------------------------------------------------------------------
# Columns declared NOT NULL in the source schema.
NOT_NULL = (
    ("categories", "category_name"), ("products", "product_name"), ("products", "price"),
    ("products", "cost"), ("inventory", "quantity_available"), ("customers", "first_name"),
    ("customers", "last_name"), ("customers", "email"), ("customers", "signup_date"),
    ("marketing_campaigns", "campaign_name"), ("marketing_campaigns", "start_date"),
    ("customer_campaigns", "interaction_date"), ("orders", "order_date"), ("orders", "total_amount"),
    ("order_items", "quantity"), ("order_items", "unit_price"), ("order_items", "subtotal"),
)


def _by_table(spec):
    out: dict[str, list] = {}
    for row in spec:
        out.setdefault(row[0], []).append(row[1:])
    return out


@query("dq_not_null", _sql_union([
    f"SELECT '{tb}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_rows "
    f"FROM {TABLES[tb][1]}" for tb, c in NOT_NULL]))
def dq_not_null(t: Tables) -> DataFrame:
    """NULLs in NOT NULL columns: one pass per table."""
    parts = []
    for table, cols in _by_table(NOT_NULL).items():
        agg = _df(t, table).agg(*[count_if(F.col(c).isNull()).alias(c) for (c,) in cols])
        parts.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(c).alias("null_rows")) for (c,) in cols])).alias("r")).select("r.*"))
    return _union(parts)


# --------------------------------------------------------------------------
@query("dq_check", oracle("""
SELECT 'reviews.rating BETWEEN 1 AND 5' AS check_name, COUNT(*) AS checked_rows,
       COUNT(CASE WHEN NOT (rating BETWEEN 1 AND 5) THEN 1 END) AS violations
FROM b_reviews"""))
def dq_check(t: Tables) -> DataFrame:
    """CHECK (rating BETWEEN 1 AND 5); a NULL rating passes, as in SQL."""
    return t.reviews.agg(F.lit("reviews.rating BETWEEN 1 AND 5").alias("check_name"),
                         F.count(F.lit(1)).alias("checked_rows"),
                         count_if(~F.col("rating").between(1, 5)).alias("violations"))


# --------------------------------------------------------------------------
# The declared VARCHAR lengths and DECIMAL(p, s) of the reference schema
VARCHAR_LIMITS = (
    ("categories", "category_name", 100), ("products", "product_name", 255),
    ("products", "supplier", 100), ("inventory", "warehouse_location", 100),
    ("customers", "first_name", 100), ("customers", "last_name", 100), ("customers", "email", 255),
    ("customers", "phone", 20), ("customers", "country", 50), ("customers", "state", 50),
    ("customers", "city", 100), ("customers", "customer_segment", 50),
    ("marketing_campaigns", "campaign_name", 200), ("marketing_campaigns", "campaign_type", 50),
    ("marketing_campaigns", "channel", 50), ("orders", "order_status", 50),
    ("orders", "payment_method", 50), ("shipping", "carrier", 50), ("shipping", "tracking_number", 100),
)
DECIMALS = (
    ("products", "price", 10, 2), ("products", "cost", 10, 2), ("products", "weight_kg", 5, 2),
    ("marketing_campaigns", "budget", 10, 2), ("orders", "discount_amount", 10, 2),
    ("orders", "shipping_cost", 10, 2), ("orders", "tax_amount", 10, 2), ("orders", "total_amount", 10, 2),
    ("order_items", "unit_price", 10, 2), ("order_items", "discount", 10, 2),
    ("order_items", "subtotal", 10, 2),
)


def _len_sql(tb, c, n):
    return (f"SELECT '{tb}' AS table_name, '{c}' AS column_name, 'varchar({n})' AS rule, "
            f"COUNT(CASE WHEN length({c}) > {n} THEN 1 END) AS violations FROM {TABLES[tb][1]}")


def _dec_sql(tb, c, p, s):
    return (f"SELECT '{tb}' AS table_name, '{c}' AS column_name, 'decimal({p},{s})' AS rule, "
            f"COUNT(CASE WHEN abs({c}) >= {10 ** (p - s)} OR {c} * {10 ** s} <> floor({c} * {10 ** s}) "
            f"THEN 1 END) AS violations FROM {TABLES[tb][1]}")


@query("dq_length_precision", _sql_union([_len_sql(*v) for v in VARCHAR_LIMITS]
                                         + [_dec_sql(*d) for d in DECIMALS]))
def dq_length_precision(t: Tables) -> DataFrame:
    """Values longer than their VARCHAR(n), or outside DECIMAL(p, s): too
    many integer digits, or more than s decimals."""
    rules: dict[str, list] = {}
    for tb, c, n in VARCHAR_LIMITS:
        rules.setdefault(tb, []).append((c, f"varchar({n})", F.length(F.col(c)) > n))
    for tb, c, p, s in DECIMALS:
        x = F.col(c)
        bad = (F.abs(x) >= 10 ** (p - s)) | (x * (10 ** s) != F.floor(x * (10 ** s)))
        rules.setdefault(tb, []).append((c, f"decimal({p},{s})", bad))
    parts = []
    for tb, rs in rules.items():
        agg = _df(t, tb).agg(*[count_if(cond).alias(f"_{i}") for i, (_, _, cond) in enumerate(rs)])
        parts.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(tb).alias("table_name"), F.lit(c).alias("column_name"), F.lit(r).alias("rule"),
                     F.col(f"_{i}").alias("violations")) for i, (c, r, _) in enumerate(rs)])).alias("x"))
            .select("x.*"))
    return _union(parts)


# --------------------------------------------------------------------------
# Column defaults of the source schema; LOAD_TIME stands for the time of the load.
LOAD_TIME = "load time"
DEFAULTS = {
    "categories": {"created_at": LOAD_TIME},
    "products": {"created_at": LOAD_TIME, "is_active": True},
    "inventory": {"reorder_level": 50, "updated_at": LOAD_TIME},
    "customers": {"is_active": True},
    "orders": {"discount_amount": 0, "shipping_cost": 0, "tax_amount": 0},
    "order_items": {"discount": 0},
    "reviews": {"review_date": LOAD_TIME, "is_verified_purchase": True},
}


def apply_defaults(df: DataFrame, table: str, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Fill NULLs with the declared column defaults (typed like the column);
    a column with a default that ``df`` lacks is added. ``loaded_at`` is the
    time of the load (now, if not given)."""
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")
    given = {k: now if v is LOAD_TIME else F.lit(v) for k, v in DEFAULTS.get(table, {}).items()}
    cols = [F.coalesce(F.col(f.name), given[f.name].cast(f.dataType)).alias(f.name) if f.name in given else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols, *[v.alias(k) for k, v in given.items() if k not in df.columns])


@query("defaults_filled", oracle(f"""
SELECT order_id, CASE WHEN order_id % 2 = 0 THEN 0e0 ELSE CAST(discount_amount AS DOUBLE) END AS discount_amount,
       CASE WHEN order_id % 3 = 0 THEN 0e0 ELSE CAST(shipping_cost AS DOUBLE) END AS shipping_cost,
       CASE WHEN order_id % 5 = 0 THEN 0e0 ELSE CAST(tax_amount AS DOUBLE) END AS tax_amount,
       {TS_AGO(0)} AS review_date, TRUE AS is_verified_purchase
FROM b_orders"""))
def defaults_filled(t: Tables) -> DataFrame:
    """Defaults at work: orders staged with gaps in their amounts, reviewed
    without a date or a verified flag."""
    def gap(c: str, every: int) -> F.Column:
        return F.when(F.col("order_id") % every != 0, F.col(c)).alias(c)

    staged = t.orders.select("order_id", gap("discount_amount", 2), gap("shipping_cost", 3), gap("tax_amount", 5))
    whole = apply_defaults(apply_defaults(staged, "orders"), "reviews", dt.datetime.combine(t.as_of, dt.time()))
    money = ("discount_amount", "shipping_cost", "tax_amount")
    return whole.select("order_id", *[F.col(c).cast("double").alias(c) for c in money], "review_date", "is_verified_purchase")


#: Key whose every third value gets gaps, and the columns with a default that the bound tables have.
_GAP_KEYS = {"categories": "category_id", "products": "product_id", "inventory": "inventory_id", "customers": "customer_id",
             "orders": "order_id", "order_items": "order_id", "reviews": "order_id"}
_BOUND = {"products": ("is_active",), "inventory": ("reorder_level",), "customers": ("is_active",), "order_items": ("discount",),
          "orders": ("discount_amount", "shipping_cost", "tax_amount"), "reviews": ("review_date", "is_verified_purchase")}


def _default_sql(table: str, column: str) -> str:
    gap = f"{_GAP_KEYS[table]} % 3 = 0" if column in _BOUND.get(table, ()) else "TRUE"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT(*) AS checked_rows,
       COUNT(*) FILTER ({gap}) AS filled_rows, CAST(0 AS BIGINT) AS null_rows FROM {TABLES[table][1]}"""


@query("defaults_by_column", _sql_union([_default_sql(table, c) for table, cs in DEFAULTS.items() for c in cs]))
def defaults_by_column(t: Tables) -> DataFrame:
    """Every declared default at work: each table is staged with gaps in its columns (a column it lacks
    is one gap), loaded at the analysis date, and the rows that hold the default where a gap was are counted."""
    loaded = dt.datetime.combine(t.as_of, dt.time())
    parts = []
    for table, defaults in DEFAULTS.items():
        key = F.col(_GAP_KEYS[table])
        bound = _BOUND.get(table, ())
        gap = F.coalesce(key % 3 == 0, F.lit(False))
        staged = _df(t, table).select(gap.alias("_gap"), *[F.when(~gap, F.col(c)).alias(c) for c in bound])
        whole = apply_defaults(staged, table, loaded)
        counts = []
        for c, value in defaults.items():
            given = F.lit(loaded).cast("timestamp_ntz") if value is LOAD_TIME else F.lit(value)
            hole = F.col("_gap") if c in bound else F.lit(True)
            counts += [count_if(hole & (F.col(c) == given.cast(whole.schema[c].dataType))).alias(f"f_{c}"), count_if(F.col(c).isNull()).alias(f"n_{c}")]
        agg = whole.agg(F.count(F.lit(1)).alias("n"), *counts)
        parts.append(agg.select(F.explode(F.array(*[F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col("n").alias("checked_rows"),
            F.col(f"f_{c}").alias("filled_rows"), F.col(f"n_{c}").alias("null_rows")) for c in defaults])).alias("x")).select("x.*"))
    return _union(parts)


@query("orders_with_defaults", oracle("""
SELECT order_id, customer_id, order_date, order_status, payment_method, campaign_id,
       CAST(COALESCE(discount_amount, 0) AS DOUBLE) AS discount_amount,
       CAST(COALESCE(shipping_cost, 0) AS DOUBLE) AS shipping_cost,
       CAST(COALESCE(tax_amount, 0) AS DOUBLE) AS tax_amount,
       CAST(total_amount AS DOUBLE) AS total_amount
FROM b_orders"""))
def orders_with_defaults(t: Tables) -> DataFrame:
    """The orders table with its column defaults applied on load."""
    cols = ("order_id", "customer_id", "order_date", "order_status", "payment_method", "campaign_id",
            "discount_amount", "shipping_cost", "tax_amount", "total_amount")
    o = apply_defaults(t.orders.select(*cols), "orders")
    return o.select(*[F.col(c).cast("double").alias(c) if c in
                      ("discount_amount", "shipping_cost", "tax_amount", "total_amount") else F.col(c)
                      for c in cols])


# --------------------------------------------------------------------------
@query("order_total_reconcile", oracle(f"""
SELECT o.order_id, CAST(o.total_amount AS DOUBLE) AS total_amount,
       CAST(i.s AS DOUBLE) AS items_subtotal,
       {R('CAST(i.s AS DOUBLE) * 1.08e0 + CAST(o.shipping_cost AS DOUBLE)')} AS expected_total,
       {R('CAST(i.s AS DOUBLE) * 0.08e0')} AS expected_tax,
       CAST(o.tax_amount AS DOUBLE) AS tax_amount
FROM b_orders o JOIN (SELECT order_id, SUM(subtotal) AS s FROM b_items GROUP BY order_id) i
  ON i.order_id = o.order_id
WHERE abs(CAST(o.total_amount AS DOUBLE)
          - {R('CAST(i.s AS DOUBLE) * 1.08e0 + CAST(o.shipping_cost AS DOUBLE)')}) > 0.005e0
   OR abs(CAST(o.tax_amount AS DOUBLE) - {R('CAST(i.s AS DOUBLE) * 0.08e0')}) > 0.005e0"""))
def order_total_reconcile(t: Tables) -> DataFrame:
    """Orders breaking the generator's invariant total = items x 1.08 +
    shipping, tax = items x 0.08 (items summed per order first)."""
    items = t.items.groupBy("order_id").agg(F.sum("subtotal_e4").alias("s"))
    j = t.orders.join(items, "order_id")
    s = dollars("s", 4)
    exp_total = rnd(s * 1.08 + dollars("shipping_cents"))
    exp_tax = rnd(s * 0.08)
    total, tax = dollars("total_cents"), dollars("tax_cents")
    return (j.where((F.abs(total - exp_total) > 0.005) | (F.abs(tax - exp_tax) > 0.005))
            .select("order_id", total.alias("total_amount"), s.alias("items_subtotal"),
                    exp_total.alias("expected_total"), exp_tax.alias("expected_tax"),
                    tax.alias("tax_amount")))


# --------------------------------------------------------------------------
@query("line_subtotal_reconcile", oracle("""
SELECT order_id, line_number, product_id, CAST(subtotal AS DOUBLE) AS subtotal, CAST(due AS DOUBLE) AS expected_subtotal
FROM (SELECT *, CAST(unit_price * CAST(quantity AS DECIMAL(9, 0)) AS DECIMAL(18, 4)) - CAST(discount AS DECIMAL(18, 4)) AS due
      FROM b_items) WHERE subtotal <> due"""))
def line_subtotal_reconcile(t: Tables) -> DataFrame:
    """Lines breaking the rule subtotal = price x quantity - discount (a unit
    price is kept to the cent, so most lines of several units do)."""
    expected = F.col("unit_price_cents") * 100 * F.col("quantity") - F.col("discount_e4")
    return (t.items.where(F.col("subtotal_e4") != expected)
            .select("order_id", "line_number", "product_id", dollars("subtotal_e4", 4).alias("subtotal"),
                    dollars(expected, 4).alias("expected_subtotal")))
