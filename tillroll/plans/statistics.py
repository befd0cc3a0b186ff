"""Join order from stored statistics.

Row counts and column statistics of stored tables let the optimizer order the
joins of a star by what they leave over, instead of in the order they are
written in. ``store`` writes a table in the shared folder and has Spark collect
its statistics; ``ordering`` gives a session of its own in which cost-based
reordering is on, so that the caller's plans stay as they are.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.sqltext import oracle
from tillroll.plans.jobs import _scratch
from tillroll.registry import query
from tillroll.session import TASK_BYTES
from tillroll.sources.bind import Tables


def ordering(spark: SparkSession) -> SparkSession:
    """A session that shares ``spark``'s tables and orders joins by their cost."""
    own = spark.newSession()
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
        own.conf.set(key, "true")
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", *TASK_BYTES):
        own.conf.set(key, spark.conf.get(key))
    return own


def store(df: DataFrame, session: SparkSession, name: str, folder: str) -> str:
    """Write ``df`` to ``folder``, register it for the sessions of this application and collect statistics of the table and all its columns; returns the table's name."""
    df.write.parquet(f"{folder}/{name}")
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    session.catalog.createTable(table, path=f"{folder}/{name}", source="parquet")
    analyze(session, table)
    return table


def analyze(session: SparkSession, table: str) -> None:
    """Collect the statistics of ``table`` anew."""
    session.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def joined_tables(df: DataFrame) -> list[list[str]]:
    """Names of the stored tables by the step at which the optimized plan joins them: those of the innermost join first."""
    steps: dict[int, list[str]] = {}
    above: list[tuple[int, bool]] = []      # (indent, is a join) of the nodes around a line
    for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
        node = line.lstrip(" :+-")
        indent = len(line) - len(node)
        while above and above[-1][0] >= indent:
            above.pop()
        above.append((indent, node.startswith("Join")))
        table = re.match(r"Relation spark_catalog\.default\.([a-z_]+)_[0-9a-f]{12}\[", node)
        if table:
            steps.setdefault(sum(join for _, join in above), []).append(table[1])
    return [sorted(steps[k]) for k in sorted(steps, reverse=True)]


def star(session: SparkSession, items: str, orders: str, products: str) -> DataFrame:
    """Units and revenue per segment: written with the largest tables first."""
    return session.sql(f"""
SELECT p.supplier, COUNT(DISTINCT o.order_id) AS orders, CAST(SUM(i.quantity) AS BIGINT) AS units_sold,
       SUM(i.subtotal_e4) / 10000D AS revenue
FROM {items} i JOIN {orders} o ON o.order_id = i.order_id JOIN {products} p ON p.product_id = i.product_id
WHERE p.price_cents >= 98000 AND o.order_status = 'Delivered' GROUP BY p.supplier""")


@query("supplier_revenue_by_cost", oracle("""
SELECT p.supplier, COUNT(DISTINCT o.order_id) AS orders, CAST(SUM(i.quantity) AS BIGINT) AS units_sold,
       CAST(SUM(i.subtotal) AS DOUBLE) AS revenue
FROM b_items i JOIN b_orders o ON o.order_id = i.order_id JOIN b_products p ON p.product_id = i.product_id
WHERE p.price_cents >= 98000 AND o.order_status = 'Delivered' GROUP BY p.supplier"""))
def supplier_revenue_by_cost(t: Tables) -> DataFrame:
    """Revenue of the dearer products per supplier from stored tables, joined in the order of their cost."""
    own, folder = ordering(t.spark), _scratch(t)
    items = store(t.items.select("order_id", "product_id", "quantity", "subtotal_e4"), own, "items", folder)
    orders = store(t.orders.select("order_id", "order_status"), own, "orders", folder)
    products = store(t.raw("part").selectExpr("p_partkey AS product_id", "p_brand AS supplier", "CAST(FLOOR(p_retailprice * 100e0 + 0.5e0) AS BIGINT) AS price_cents"),
                     own, "products", folder)
    return star(own, items, orders, products)
