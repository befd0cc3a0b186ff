"""Inventory ledger: the reference's AFTER INSERT trigger on order items
(``quantity_available -= NEW.quantity`` on every stock row of the product),
re-expressed as set operations.

* Batch: stock minus the units of all items, per product. Order independent,
  so one aggregation replaces one UPDATE per inserted row.
* Stream: item files arrive in a directory; each micro-batch is reduced to
  units per product and written as its own folder of a delta ledger, named
  by the stream (the id kept in its checkpoint) and the batch. Re-running a
  batch (after a failure, or a replay from the checkpoint) overwrites the
  same folder with the same rows, and another stream has folders of its own,
  so the ledger is idempotent; current stock is base stock minus the summed
  deltas. Only the small per-batch aggregate is written, never the whole
  stock table. ``compact_ledger`` folds finished batches into one table.
  Late rows are counted like any other row: nothing is dropped by a
  watermark, because a decrement has no window to close.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.sqltext import oracle
from tillroll.plans.jobs import fs_of
from tillroll.plans.views import v_daily_dashboard_sql
from tillroll.registry import ORACLE, query
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.bind import Tables

ITEM_STREAM_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("line_number", T.IntegerType()),
    T.StructField("quantity", T.LongType()),
])


def apply_decrements(inventory: DataFrame, units: DataFrame) -> DataFrame:
    """``inventory`` with ``units`` (product_id, units) subtracted from every
    stock row of each product."""
    j = inventory.join(units, "product_id", "left")
    return j.select(
        "inventory_id", "product_id", "warehouse_location",
        F.col("quantity_available").alias("quantity_before"),
        F.coalesce("units", F.lit(0)).cast("bigint").alias("units_ordered"),
        (F.col("quantity_available") - F.coalesce("units", F.lit(0))).cast("bigint")
        .alias("quantity_available"))


@query("inventory_ledger", oracle("""
SELECT i.inventory_id, i.product_id, i.warehouse_location, i.quantity_available AS quantity_before,
       CAST(COALESCE(u.units, 0) AS BIGINT) AS units_ordered,
       CAST(i.quantity_available - COALESCE(u.units, 0) AS BIGINT) AS quantity_available
FROM b_inventory i
LEFT JOIN (SELECT product_id, SUM(quantity) AS units FROM b_items GROUP BY product_id) u
  ON u.product_id = i.product_id"""))
def inventory_ledger(t: Tables) -> DataFrame:
    """Stock after every order item has been applied (batch form)."""
    units = t.items.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return apply_decrements(t.inventory, units)


# --------------------------------------------------------------------------
def _batch_dir(batch: DataFrame, base: str, batch_id: int) -> str:
    """Folder of one micro-batch: the stream's id outlives restarts, and a new checkpoint is a new stream."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{base.rstrip('/')}/stream={stream}/batch_id={batch_id}"


def _write_delta(ledger_dir: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("product_id").agg(F.sum("quantity").alias("units"), F.current_timestamp().alias("updated_at"))
         .write.mode("overwrite").parquet(_batch_dir(batch, ledger_dir, batch_id)))
    return write


def start_ledger_stream(spark: SparkSession, items_dir: str, ledger_dir: str, checkpoint_dir: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the streaming ledger over item files landing in ``items_dir``.

    ``checkpoint_dir`` must be on shared storage; it records which files each
    batch consumed, so a restarted query replays exactly the unfinished batch.
    """
    reader = spark.readStream.schema(ITEM_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(items_dir)
    w = src.writeStream.foreachBatch(_write_delta(ledger_dir)).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


_DELTA = "product_id BIGINT, units BIGINT, updated_at TIMESTAMP"


def _committed(spark: SparkSession, folder: str) -> list[str]:
    """Sub-folders of ``folder`` with a ``_SUCCESS`` marker, by name."""
    fs, root = fs_of(spark, folder)
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(p.toString() for p in found if fs.exists(p.suffix("/_SUCCESS")))


def _batches(spark: SparkSession, base: str) -> list[str]:
    fs, root = fs_of(spark, base)
    streams = [s.getPath().toString() for s in fs.listStatus(root)
               if s.isDirectory() and s.getPath().getName().startswith("stream=")] if fs.exists(root) else []
    return [b for s in sorted(streams) for b in _committed(spark, s)]


def _place(folder: str) -> tuple[str, int]:
    """(stream, batch) of a batch folder."""
    stream, batch = folder.rstrip("/").rsplit("/", 2)[1:]
    return stream.removeprefix("stream="), int(batch.removeprefix("batch_id="))


def _deltas(spark: SparkSession, base: str) -> tuple[list[str], list[str], dict[str, int]]:
    """(folders to read, batches in them one by one, last batch folded into the newest compaction by stream).

    A stream commits its batches in order, so the last one folded stands for all before it: one number a stream."""
    done = _committed(spark, f"{base.rstrip('/')}/compacted")
    covered = {r.stream: r.batch for r in spark.read.schema("stream STRING, batch BIGINT").json(f"{done[-1]}/covers").collect()} if done else {}
    loose = [b for b in _batches(spark, base) if _place(b)[1] > covered.get(_place(b)[0], -1)]
    return ([f"{done[-1]}/units"] if done else []) + loose, loose, covered


def ledger_units(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """Units ordered per product by every committed batch, and when the last of them was booked."""
    folders, _, _ = _deltas(spark, ledger_dir)
    rows = spark.read.schema(_DELTA).parquet(*folders) if folders else spark.createDataFrame([], _DELTA)
    return rows.groupBy("product_id").agg(F.sum("units").alias("units"), F.max("updated_at").alias("updated_at"))


def _compact(spark: SparkSession, base: str, read: Callable[[SparkSession, str], DataFrame]) -> int:
    """Fold all committed batches below ``base`` into one table with what ``read`` gives; returns how many were folded.

    The new table and what it covers become visible together with its marker;
    only then are the batches and the compaction before it removed, and a reader
    skips covered ones, so that a job that dies in between changes nothing.
    """
    _, loose, covered = _deltas(spark, base)
    if not loose:
        return 0
    done = _committed(spark, f"{base.rstrip('/')}/compacted")
    number = int(done[-1].rsplit("/", 1)[1].split("-")[0]) + 1 if done else 0
    target = f"{base.rstrip('/')}/compacted/{number:06d}-{uuid.uuid4().hex}"
    read(spark, base).write.parquet(f"{target}/units")
    last = dict(covered)
    for b in loose:
        stream, batch = _place(b)
        last[stream] = max(batch, last.get(stream, -1))
    # one short row per stream
    spark.createDataFrame(sorted(last.items()), "stream STRING, batch BIGINT").coalesce(1).write.json(f"{target}/covers")
    fs, marker = fs_of(spark, f"{target}/_SUCCESS")
    fs.create(marker).close()
    for b in [*loose, *done[:-1]]:      # the one before stays for those who are reading it
        fs.delete(fs_of(spark, b)[1], True)
    return len(loose)


def compact_ledger(spark: SparkSession, ledger_dir: str) -> int:
    """Fold all committed batches of the ledger into one table; returns how many were folded."""
    return _compact(spark, ledger_dir, ledger_units)


def current_stock(inventory: DataFrame, spark: SparkSession, ledger_dir: str) -> DataFrame:
    """Base stock minus every committed ledger delta, with the time of the
    last booking (NULL for a product nobody ordered)."""
    units = ledger_units(spark, ledger_dir)
    return apply_decrements(inventory, units.drop("updated_at")).join(units.select("product_id", "updated_at"), "product_id", "left")


@query("ledger_stream", ORACLE["inventory_ledger"])
def ledger_stream(t: Tables, parts: int = 3) -> DataFrame:
    """The streaming ledger over the items as they arrive in ``parts`` files,
    compacted after the first run."""
    base = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    items = t.items.select("order_id", "product_id", "line_number", "quantity")
    for k in range(parts):
        items.where(F.pmod(F.coalesce("order_id", F.lit(0)), F.lit(parts)) == k).write.mode("append").parquet(f"{base}/items")
        start_ledger_stream(t.spark, f"{base}/items", f"{base}/ledger", f"{base}/checkpoint").awaitTermination()
        if k == 0:
            compact_ledger(t.spark, f"{base}/ledger")
    return current_stock(t.inventory, t.spark, f"{base}/ledger").drop("updated_at").select(
        "inventory_id", "product_id", "warehouse_location", "quantity_before", "units_ordered", "quantity_available")


def touch_updated_at(orders: DataFrame) -> DataFrame:
    """The reference's order "touch" function re-aimed: stamp an
    ``updated_at`` audit column on ingest (batch or stream). Unlike the
    original it never overwrites ``order_date``, which would destroy the
    business date every report groups by."""
    return orders.withColumn("updated_at", F.current_timestamp())


@query("order_touch", oracle("""
SELECT order_id, order_date, order_status, TRUE AS stamped, TRUE AS stamped_after_order FROM b_orders"""))
def order_touch(t: Tables) -> DataFrame:
    """Orders with the audit stamp: every row has one, none before its order date, and the order date is kept."""
    o = touch_updated_at(t.orders)
    after = F.col("order_date").isNull() | (F.col("updated_at").cast("timestamp_ntz") > F.col("order_date"))
    return o.select("order_id", "order_date", "order_status", F.col("updated_at").isNotNull().alias("stamped"), after.alias("stamped_after_order"))


# --------------------------------------------------------------------------
ORDER_STREAM_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("discount_amount", T.DecimalType(12, 2)),
    T.StructField("shipping_cost", T.DecimalType(12, 2)),
    T.StructField("total_amount", T.DecimalType(12, 2)),
])


def _write_days(sink_dir: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        st = F.col("order_status")
        day = F.to_date("order_date").alias("sale_date")
        # one row per day and customer: days add up, customers are counted when read
        (batch.groupBy(day, "customer_id")
         .agg(F.count("order_id").alias("total_orders"), F.sum("total_amount").alias("revenue_dec"),
              F.count("total_amount").alias("n_amount"), F.sum("discount_amount").alias("discounts_dec"),
              F.sum("shipping_cost").alias("shipping_dec"), F.count(F.when(st == "Delivered", 1)).alias("delivered_orders"),
              F.count(F.when(st == "Cancelled", 1)).alias("cancelled_orders"))
         .write.mode("overwrite").parquet(_batch_dir(batch, sink_dir, batch_id)))
    return write


def start_dashboard_stream(spark: SparkSession, orders_dir: str, sink_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Daily dashboard over an order stream (event time = order_date).

    Every micro-batch is reduced to one row per (day, customer) and written as
    its own folder, overwritten if the batch is replayed. Days stay open:
    nothing waits for a watermark, so every day shows at once and a row that
    arrives late is counted in its day like any other.
    """
    src = spark.readStream.schema(ORDER_STREAM_SCHEMA).parquet(orders_dir)
    return (src.writeStream.foreachBatch(_write_days(sink_dir)).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


_DAY_SUMS = {"total_orders": "BIGINT", "revenue_dec": "DECIMAL(38,2)", "n_amount": "BIGINT", "discounts_dec": "DECIMAL(38,2)",
             "shipping_dec": "DECIMAL(38,2)", "delivered_orders": "BIGINT", "cancelled_orders": "BIGINT"}


def dashboard_days(spark: SparkSession, sink_dir: str) -> DataFrame:
    """One row per day and customer over every committed batch."""
    folders, _, _ = _deltas(spark, sink_dir)
    parts = [spark.read.parquet(f) for f in folders]    # sums widen when they are folded, so types differ between folders
    out = None
    for rows in parts:
        rows = rows.select("sale_date", "customer_id", *[F.col(c).cast(k).alias(c) for c, k in _DAY_SUMS.items()])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], "sale_date DATE, customer_id BIGINT, " + ", ".join(f"{c} {k}" for c, k in _DAY_SUMS.items()))
    return out.groupBy("sale_date", "customer_id").agg(*[F.sum(c).cast(k).alias(c) for c, k in _DAY_SUMS.items()])


def compact_dashboard(spark: SparkSession, sink_dir: str) -> int:
    """Fold all committed batches of the dashboard into one table; returns how many were folded."""
    return _compact(spark, sink_dir, dashboard_days)


def read_dashboard_stream(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The dashboard of all days seen so far."""
    from tillroll.functions.common import ratio, rnd
    # a customer's batches of one day first, so that customers are then plain rows
    days = dashboard_days(spark, sink_dir).groupBy("sale_date").agg(
        F.count("customer_id").alias("unique_customers"), *[F.sum(c).alias(c) for c in _DAY_SUMS])
    return days.select(
        "sale_date", F.col("total_orders").cast("bigint").alias("total_orders"), "unique_customers",
        F.col("revenue_dec").cast("double").alias("revenue"),
        rnd(ratio("revenue_dec", "n_amount")).alias("avg_order_value"),
        F.col("discounts_dec").cast("double").alias("total_discounts"),
        F.col("shipping_dec").cast("double").alias("total_shipping"),
        F.col("delivered_orders").cast("bigint").alias("delivered_orders"),
        F.col("cancelled_orders").cast("bigint").alias("cancelled_orders"))


@query("dashboard_stream", v_daily_dashboard_sql(36500))
def dashboard_stream(t: Tables) -> DataFrame:
    """The streamed dashboard over all orders, the older half arriving last, compacted in between."""
    base = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/dashboard-{uuid.uuid4().hex}"
    o = t.orders.select(*ORDER_STREAM_SCHEMA.names)
    for late in (False, True):
        o.where((F.year("order_date") < 1998) == late).write.mode("append").parquet(f"{base}/orders")
        start_dashboard_stream(t.spark, f"{base}/orders", f"{base}/days", f"{base}/checkpoint").awaitTermination()
        if not late:
            compact_dashboard(t.spark, f"{base}/days")
    return read_dashboard_stream(t.spark, f"{base}/days")
