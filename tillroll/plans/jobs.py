"""Procedures of the reference as Spark jobs.

* ``refresh_materialized`` recomputes the materialized views and publishes
  each as a new version directory; readers pick the newest committed one, so
  a refresh that dies half way leaves the previous version in place.
* ``update_segments`` / ``write_segment_update`` re-derive customer segments
  (Parquet has no in-place UPDATE: the new table is written whole).
* ``sales_report`` and ``business_metrics`` return their figures as rows
  instead of printing notices.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.common import dollars, ratio, rnd
from tillroll.functions.sqltext import MEAN, R, TS_AGO, oracle
from tillroll.plans.views import mv_category_performance, mv_monthly_revenue
from tillroll.registry import ORACLE, query
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.bind import Tables

MATERIALIZED = {
    "mv_monthly_revenue": mv_monthly_revenue,
    "mv_category_performance": mv_category_performance,
}


def fs_of(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, base: str, name: str) -> list[str]:
    fs, root = fs_of(spark, f"{base.rstrip('/')}/{name}")
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        p = st.getPath()
        if st.isDirectory() and p.getName().startswith("v=") and \
                fs.exists(p.suffix("/_SUCCESS")):
            out.append(p.getName()[2:])
    return sorted(out)


def _new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def publish(df: DataFrame, base: str, name: str, version: str | None = None, keep: int = 2) -> str:
    """Write ``df`` as a new version ``base/<name>/v=<version>`` and drop
    versions older than the newest ``keep``. The previous version stays
    readable until the new one is committed, so a failed job (lost executors,
    killed driver) never leaves the table missing or half written."""
    version = version or _new_version()
    df.write.mode("errorifexists").parquet(f"{base.rstrip('/')}/{name}/v={version}")
    for old in _versions(df.sparkSession, base, name)[:-keep]:
        fs, p = fs_of(df.sparkSession, f"{base.rstrip('/')}/{name}/v={old}")
        fs.delete(p, True)
    return version


def refresh_materialized(t: Tables, base: str, keep: int = 2) -> dict[str, str]:
    """Recompute every materialized view into ``base/<name>/v=<version>``.

    A version becomes visible only once Spark's output committer has written
    its ``_SUCCESS`` marker; older versions beyond ``keep`` are removed.
    Returns ``{name: version}``.
    """
    version = _new_version()
    return {name: publish(build(t), base, name, version, keep) for name, build in MATERIALIZED.items()}


def read_latest(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The newest committed version of a published table or materialized view."""
    versions = _versions(spark, base, name)
    if not versions:
        raise FileNotFoundError(f"no committed version of {name} under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/{name}/v={versions[-1]}")


def append(df: DataFrame, base: str, name: str) -> str:
    """Add ``df`` to the table ``base/<name>`` as one batch of its own (INSERT).

    Earlier batches are not rewritten; the new one is seen once its
    ``_SUCCESS`` marker is there. Returns the batch's name.
    """
    batch = _new_version()
    df.write.mode("errorifexists").parquet(f"{base.rstrip('/')}/{name}/v={batch}")
    return batch


def read_appended(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of all committed batches of an appended table."""
    batches = _versions(spark, base, name)
    if not batches:
        raise FileNotFoundError(f"no committed batch of {name} under {base}")
    return spark.read.parquet(*[f"{base.rstrip('/')}/{name}/v={b}" for b in batches])


def _scratch(t: Tables) -> str:
    """A folder of this call below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"


@query("stored_monthly_revenue", ORACLE["mv_monthly_revenue"])
def stored_monthly_revenue(t: Tables, base: str | None = None) -> DataFrame:
    """The monthly view as read back after a refresh."""
    base = base or _scratch(t)
    refresh_materialized(t, base)
    return read_latest(t.spark, base, "mv_monthly_revenue")


@query("stored_category_performance", ORACLE["mv_category_performance"])
def stored_category_performance(t: Tables, base: str | None = None) -> DataFrame:
    """The category view as read back after a refresh."""
    base = base or _scratch(t)
    refresh_materialized(t, base)
    return read_latest(t.spark, base, "mv_category_performance")


@query("appended_orders", oracle("""
SELECT order_status, COUNT(*) AS orders, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM b_orders GROUP BY order_status"""))
def appended_orders(t: Tables, base: str | None = None) -> DataFrame:
    """Orders inserted status by status into one table, then counted there."""
    base = base or _scratch(t)
    o = t.orders.select("order_id", "order_status", "total_cents")
    for status in ("Delivered", "Pending"):
        append(o.where(F.col("order_status") == status), base, "orders")
    append(o.where(~F.col("order_status").isin("Delivered", "Pending") | F.col("order_status").isNull()), base, "orders")
    return (read_appended(t.spark, base, "orders").groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("orders"), dollars(F.sum("total_cents")).alias("revenue")))


# --------------------------------------------------------------------------
@query("update_segments", oracle("""
SELECT c.customer_id, c.customer_segment AS previous_segment,
       CASE WHEN spending.customer_id IS NULL THEN c.customer_segment
            WHEN COALESCE(spending.total, 0) >= 5000 THEN 'VIP'
            WHEN COALESCE(spending.total, 0) >= 1000 THEN 'Regular'
            ELSE 'New' END AS customer_segment
FROM b_customers c
LEFT JOIN (SELECT customer_id, SUM(total_amount) AS total FROM b_orders
           WHERE order_status != 'Cancelled' GROUP BY customer_id) spending
  ON c.customer_id = spending.customer_id"""))
def update_segments(t: Tables, vip: int = 5000, regular: int = 1000) -> DataFrame:
    """Segment from non-cancelled spend; customers without such orders keep
    their segment (the reference's UPDATE ... FROM only touches joined rows)."""
    spend = (t.valid_orders.groupBy("customer_id").agg(F.sum("total_amount").alias("_total")))
    j = t.customers.select("customer_id", "customer_segment").join(spend, "customer_id", "left")
    new = (F.when(F.col("_total").isNull(), F.col("customer_segment"))
           .when(F.col("_total") >= vip, "VIP").when(F.col("_total") >= regular, "Regular")
           .otherwise("New"))
    return j.select("customer_id", F.col("customer_segment").alias("previous_segment"),
                    new.alias("customer_segment"))


def write_segment_update(t: Tables, base: str, name: str = "customers") -> str:
    """Publish the customers table with updated segments as a new version
    (read it back with ``read_latest``); returns the version."""
    seg = update_segments(t).select("customer_id", "customer_segment")
    return publish(t.customers.drop("customer_segment").join(seg, "customer_id"), base, name)


# --------------------------------------------------------------------------
REPORT_START, REPORT_END = dt.date(2001, 1, 1), dt.date(2001, 8, 1)


@query("sales_report", oracle(f"""
SELECT DATE '{REPORT_START}' AS start_date, DATE '{REPORT_END}' AS end_date,
       CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS total_orders,
       {R(MEAN('total_amount'))} AS avg_order_value
FROM b_orders
WHERE order_date BETWEEN TIMESTAMP '{REPORT_START} 00:00:00' AND TIMESTAMP '{REPORT_END} 00:00:00'
  AND order_status != 'Cancelled'"""))
def sales_report(t: Tables, start: dt.date = REPORT_START, end: dt.date = REPORT_END) -> DataFrame:
    """Revenue, orders and mean order value between two dates. As in the
    reference, dates compare to timestamps at midnight: the end day counts
    only its 00:00 orders."""
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{end.isoformat()} 00:00:00").cast("timestamp_ntz")
    o = t.valid_orders.where(F.col("order_date").between(lo, hi))
    return o.agg(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"),
                 dollars(F.sum("total_cents")).alias("total_revenue"),
                 F.count(F.lit(1)).alias("total_orders"),
                 rnd(ratio(dollars(F.sum("total_cents")), F.count("total_cents"))).alias("avg_order_value"))


# --------------------------------------------------------------------------
@query("business_metrics", oracle(f"""
SELECT 'Total Revenue' AS metric_name, '$' || format('{{:,.2f}}', CAST(SUM(total_amount) AS DOUBLE)) AS metric_value
FROM b_orders WHERE order_status != 'Cancelled'
UNION ALL
SELECT 'Total Orders', CAST(COUNT(*) AS VARCHAR) FROM b_orders WHERE order_status != 'Cancelled'
UNION ALL
SELECT 'Active Customers', CAST(COUNT(DISTINCT customer_id) AS VARCHAR) FROM b_orders
WHERE order_date >= {TS_AGO(90)} AND order_status != 'Cancelled'
UNION ALL
SELECT 'Average Order Value', '$' || format('{{:,.2f}}', {R(MEAN('total_amount'))}) FROM b_orders
WHERE order_status != 'Cancelled'
UNION ALL
SELECT 'Total Products', CAST(COUNT(*) AS VARCHAR) FROM b_products WHERE is_active = TRUE"""))
def business_metrics(t: Tables) -> DataFrame:
    """Five headline figures as (metric_name, metric_value) text rows, from
    one pass over orders and one over products. Money is shown as
    ``$1,234.56`` (the reference's fixed-width currency mask would overflow
    to ``#`` beyond 999,999,999.99)."""
    recent = F.col("order_date") >= t.ts_days_ago(90)
    o = t.valid_orders.agg(
        dollars(F.sum("total_cents")).alias("rev"), F.count(F.lit(1)).alias("n"),
        F.countDistinct(F.when(recent, F.col("customer_id"))).alias("active"),
        rnd(ratio(dollars(F.sum("total_cents")), F.count("total_cents"))).alias("aov"))
    p = t.products_named.where(F.col("is_active") == F.lit(True)).agg(
        F.lit("Total Products").alias("metric_name"), F.count(F.lit(1)).cast("string").alias("metric_value"))
    money = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c), 2))
    rows = (("Total Revenue", money("rev")), ("Total Orders", F.col("n").cast("string")),
            ("Active Customers", F.col("active").cast("string")),
            ("Average Order Value", money("aov")))
    # one pass over orders gives four rows; the product count is a fifth
    return o.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric_name"), v.alias("metric_value")) for k, v in rows])).alias("m")
    ).select("m.*").unionByName(p)


# --------------------------------------------------------------------------
_COUNTED = (("Categories", "categories", "b_categories"), ("Products", "product_names", "b_products"),
            ("Customers", "customers", "b_customers"), ("Orders", "orders", "b_orders"),
            ("Order Items", "items", "b_items"), ("Reviews", "reviews", "b_reviews"),
            ("Marketing Campaigns", "campaigns", "b_campaigns"))


@query("table_counts", oracle("\nUNION ALL\n".join(
    f"SELECT '{label}: ' || CAST(COUNT(*) AS VARCHAR) AS count FROM {b}" for label, _, b in _COUNTED)))
def table_counts(t: Tables) -> DataFrame:
    """The load check: one 'Label: n' row per table."""
    parts = [getattr(t, attr).agg(F.concat(F.lit(f"{label}: "), F.count(F.lit(1)).cast("string"))
                                  .alias("count"))
             for label, attr, _ in _COUNTED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
