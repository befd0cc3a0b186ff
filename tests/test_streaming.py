"""Streaming ledger and dashboard equal their batch forms."""

from pyspark.sql import functions as F

from tillroll import Tables
from tillroll.plans.views import daily_dashboard
from tillroll.streaming.ledger import (compact_ledger, current_stock, inventory_ledger, ledger_stream, read_dashboard_stream,
                                       start_dashboard_stream, start_ledger_stream)


def _rows(df, key):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_ledger_stream_matches_batch_and_is_idempotent(spark, tables, scratch):
    items = tables.items.select("order_id", "product_id", "line_number", "quantity")
    src = f"{scratch}/items"
    # three arrivals, written as separate files
    for k in range(3):
        items.where(F.col("order_id") % 3 == k).write.mode("append").parquet(src)
    ledger, ckpt = f"{scratch}/ledger", f"{scratch}/ckpt"
    q = start_ledger_stream(spark, src, ledger, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    got = current_stock(tables.inventory, spark, ledger).select(*inventory_ledger(tables).columns)
    want = inventory_ledger(tables)
    assert _rows(got, "inventory_id") == _rows(want, "inventory_id")
    # replaying the same batch id rewrites the same partition: totals unchanged
    first = current_stock(tables.inventory, spark, ledger)
    assert first.where("units_ordered > 0 AND updated_at IS NULL").count() == 0
    q2 = start_ledger_stream(spark, src, ledger, ckpt)   # restart: nothing new to do
    q2.awaitTermination()
    stock = lambda: current_stock(tables.inventory, spark, ledger).select(*want.columns)
    assert _rows(stock(), "inventory_id") == _rows(want, "inventory_id")
    # a stream with a fresh checkpoint keeps to folders of its own: the items count once more
    start_ledger_stream(spark, src, ledger, f"{scratch}/other").awaitTermination()
    twice = {r.product_id: r.units_ordered for r in stock().collect()}
    assert twice == {r.product_id: 2 * r.units_ordered for r in want.collect()}
    assert compact_ledger(spark, ledger) == 4 and compact_ledger(spark, ledger) == 0
    assert {r.product_id: r.units_ordered for r in stock().collect()} == twice


def test_items_without_an_order_reach_the_stream(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    t.items = t.items.withColumn("order_id", F.when(F.col("order_id") % 5 != 0, F.col("order_id")))
    assert t.items.where("order_id IS NULL").count() > 0
    assert _rows(ledger_stream(t), "inventory_id") == _rows(inventory_ledger(t), "inventory_id")


def test_dashboard_stream_matches_batch(spark, tables, scratch):
    src = f"{scratch}/orders"
    cols = ["order_id", "customer_id", "order_date", "order_status", "discount_amount",
            "shipping_cost", "total_amount"]
    o = tables.orders.select(*cols)
    for y in (1995, 1998, 2001):   # arrivals in time order
        o.where(F.year("order_date") < y).where(F.year("order_date") >= y - 3).write.mode("append").parquet(src)
    start_dashboard_stream(spark, src, f"{scratch}/sink", f"{scratch}/ck").awaitTermination()
    # rows of days long past arrive last and count in their days
    late = o.where((F.year("order_date") < 1992) | (F.year("order_date") >= 2001) | F.col("order_date").isNull())
    late.write.mode("append").parquet(src)
    start_dashboard_stream(spark, src, f"{scratch}/sink", f"{scratch}/ck").awaitTermination()
    got = read_dashboard_stream(spark, f"{scratch}/sink")
    batch = daily_dashboard(tables.orders).select(*got.columns)
    assert _rows(got, "sale_date") == _rows(batch, "sale_date")


def test_touch_adds_audit_column_and_keeps_order_date(spark, tables):
    from tillroll.streaming.ledger import touch_updated_at
    o = tables.orders.select("order_id", "order_date")
    got = touch_updated_at(o)
    assert got.columns == ["order_id", "order_date", "updated_at"]
    assert got.where("updated_at IS NULL").count() == 0
    assert sorted(map(tuple, got.select("order_id", "order_date").collect())) == sorted(map(tuple, o.collect()))
