"""Sales analytics: monthly trend, daily running totals, payment mix, best
days, status mix.

All five aggregate the orders fact table once. Windows here run over the
aggregated days / months / methods, never over order rows, so they stay tiny
at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.common import count_if, dollars, mean, money, month_of, pct, rnd
from tillroll.functions.sqltext import MEAN, MONEY, MONTH, PCT, R, TS_AGO, oracle
from tillroll.registry import query
from tillroll.sources.bind import Tables


def _all():
    return Window.partitionBy()  # grand total over a small aggregate


@query("monthly_revenue", oracle(f"""
SELECT {MONTH('order_date')} AS month,
       COUNT(DISTINCT order_id) AS total_orders,
       {MONEY('total_amount')} AS total_revenue,
       {R(MEAN('total_amount'))} AS avg_order_value,
       COUNT(DISTINCT customer_id) AS unique_customers,
       {R(f"CAST(SUM(total_amount) AS DOUBLE) / COUNT(DISTINCT customer_id)")} AS revenue_per_customer
FROM b_orders WHERE order_status != 'Cancelled'
GROUP BY 1 ORDER BY month DESC"""))
def monthly_revenue(t: Tables) -> DataFrame:
    # order_id is the key of orders, so COUNT(DISTINCT order_id) is COUNT(order_id):
    # one distinct aggregate left (customers) instead of an Expand of two
    return (t.valid_orders
            .groupBy(month_of("order_date").alias("month"))
            .agg(F.count("order_id").alias("total_orders"),
                 money("total_cents").alias("total_revenue"),
                 rnd(mean("total_cents")).alias("avg_order_value"),
                 F.countDistinct("customer_id").alias("unique_customers"),
                 rnd(dollars(F.sum("total_cents")) / F.countDistinct("customer_id"))
                 .alias("revenue_per_customer"))
            .orderBy(F.col("month").desc()))


def _daily_sql(days: int) -> str:
    lag = "LAG(SUM(total_amount)) OVER (ORDER BY CAST(order_date AS DATE))"
    return oracle(f"""
SELECT CAST(order_date AS DATE) AS sale_date,
       COUNT(order_id) AS orders,
       {MONEY('total_amount')} AS daily_revenue,
       CAST(SUM(SUM(total_amount)) OVER (ORDER BY CAST(order_date AS DATE)) AS DOUBLE) AS running_total,
       {R(MEAN('total_amount'))} AS avg_order_value,
       CAST({lag} AS DOUBLE) AS prev_day_revenue,
       {R(f"CAST(SUM(total_amount) - {lag} AS DOUBLE) / NULLIF(CAST({lag} AS DOUBLE), 0e0) * 100e0")}
         AS revenue_growth_pct
FROM b_orders
WHERE order_date >= {TS_AGO(days)} AND order_status != 'Cancelled'
GROUP BY 1 ORDER BY sale_date DESC""")


@query("daily_sales_running", _daily_sql(30))
def daily_sales_running(t: Tables, days: int = 30) -> DataFrame:
    daily = (t.valid_orders.where(F.col("order_date") >= t.ts_days_ago(days))
             .groupBy(F.to_date("order_date").alias("sale_date"))
             .agg(F.count("order_id").alias("orders"),
                  F.sum("total_cents").alias("_rev"),
                  rnd(mean("total_cents")).alias("avg_order_value")))
    # at most `days` rows reach this single-partition window
    w = Window.orderBy("sale_date")
    prev = F.lag("_rev").over(w)
    return (daily.select(
                "sale_date", "orders",
                dollars("_rev").alias("daily_revenue"),
                dollars(F.sum("_rev").over(w)).alias("running_total"),
                "avg_order_value",
                dollars(prev).alias("prev_day_revenue"),
                rnd(dollars(F.col("_rev") - prev)
                    / F.nullif(dollars(prev), F.lit(0.0)) * 100.0).alias("revenue_growth_pct"))
            .orderBy(F.col("sale_date").desc()))


@query("revenue_by_payment", oracle(f"""
SELECT payment_method,
       COUNT(order_id) AS total_orders,
       {MONEY('total_amount')} AS total_revenue,
       {R(MEAN('total_amount'))} AS avg_order_value,
       {R(PCT('SUM(total_amount)', 'SUM(SUM(total_amount)) OVER ()'))} AS revenue_percentage,
       COUNT(CASE WHEN order_status = 'Cancelled' THEN 1 END) AS cancelled_orders,
       {R(PCT("COUNT(CASE WHEN order_status = 'Cancelled' THEN 1 END)", 'COUNT(*)'))} AS cancellation_rate
FROM b_orders GROUP BY payment_method ORDER BY total_revenue DESC"""))
def revenue_by_payment(t: Tables) -> DataFrame:
    agg = (t.orders.groupBy("payment_method")
           .agg(F.count("order_id").alias("total_orders"),
                F.sum("total_cents").alias("_rev"),
                rnd(mean("total_cents")).alias("avg_order_value"),
                count_if(F.col("order_status") == "Cancelled").alias("cancelled_orders"),
                F.count(F.lit(1)).alias("_n")))
    return (agg.select(
                "payment_method", "total_orders",
                dollars("_rev").alias("total_revenue"),
                "avg_order_value",
                rnd(pct(dollars("_rev"), dollars(F.sum("_rev").over(_all())))).alias("revenue_percentage"),
                "cancelled_orders",
                rnd(pct(F.col("cancelled_orders"), F.col("_n"))).alias("cancellation_rate"))
            .orderBy(F.col("total_revenue").desc_nulls_first()))


def _top_days_sql(k: int) -> str:
    return oracle(f"""
SELECT CAST(order_date AS DATE) AS sale_date,
       rpad(dayname(order_date), 9, ' ') AS day_of_week,
       COUNT(order_id) AS orders,
       {MONEY('total_amount')} AS revenue,
       {R(MEAN('total_amount'))} AS avg_order_value
FROM b_orders WHERE order_status != 'Cancelled'
GROUP BY 1, 2 ORDER BY revenue DESC, sale_date LIMIT {k}""")


@query("top_revenue_days", _top_days_sql(10))
def top_revenue_days(t: Tables, k: int = 10) -> DataFrame:
    return (t.valid_orders
            .groupBy(F.to_date("order_date").alias("sale_date"),
                     F.rpad(F.date_format("order_date", "EEEE"), 9, " ").alias("day_of_week"))
            .agg(F.count("order_id").alias("orders"),
                 money("total_cents").alias("revenue"),
                 rnd(mean("total_cents")).alias("avg_order_value"))
            .orderBy(F.col("revenue").desc_nulls_first(), F.col("sale_date").asc())
            .limit(k))


@query("revenue_by_status", oracle(f"""
SELECT order_status,
       COUNT(*) AS order_count,
       {MONEY('total_amount')} AS total_revenue,
       {R(MEAN('total_amount'))} AS avg_order_value,
       {R(PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()'))} AS order_percentage,
       CAST(MIN(total_amount) AS DOUBLE) AS min_order,
       CAST(MAX(total_amount) AS DOUBLE) AS max_order
FROM b_orders GROUP BY order_status ORDER BY total_revenue DESC"""))
def revenue_by_status(t: Tables) -> DataFrame:
    agg = (t.orders.groupBy("order_status")
           .agg(F.count(F.lit(1)).alias("order_count"),
                money("total_cents").alias("total_revenue"),
                rnd(mean("total_cents")).alias("avg_order_value"),
                dollars(F.min("total_cents")).alias("min_order"),
                dollars(F.max("total_cents")).alias("max_order")))
    return (agg.select("order_status", "order_count", "total_revenue", "avg_order_value",
                       rnd(pct(F.col("order_count"), F.sum("order_count").over(_all())))
                       .alias("order_percentage"),
                       "min_order", "max_order")
            .orderBy(F.col("total_revenue").desc_nulls_first()))
