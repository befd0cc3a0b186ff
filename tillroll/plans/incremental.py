"""Monthly revenue kept up by change: refreshing does not read what did not change.

The store holds, per month, mergeable partial states: one row per customer
with counts and exact sums, and a sketch of the month's customers. A refresh
reduces the change (new rows, or rows taken back with sign -1) to such states,
reads the stored states of the months it touches and writes these months anew
into a folder of its own. What makes it visible is the manifest, one row per
month (its folder, its sketch, the number of the last batch), published as a
whole: a job that dies leaves the old manifest, a batch applied before is not
applied again, and months that are not touched stay in the files they are in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.common import dollars, month_of, ratio, rnd
from tillroll.functions.sketches import estimate, merged, sketch, within_error
from tillroll.functions.sqltext import KEPT, oracle
from tillroll.plans.jobs import _scratch, _versions, fs_of, publish, read_latest
from tillroll.registry import ORACLE, query
from tillroll.sources.bind import Tables

#: Sums of a state, by name: SQL over the orders, each times the row's sign.
SUMS = {"orders": "IF(order_id IS NULL, 0, 1)", "cents": "total_cents", "priced": "IF(total_cents IS NULL, 0, 1)",
        "discounts": "discount_cents", "tax": "tax_cents", "cancelled": "IF(order_status = 'Cancelled', 1, 0)", "rows_": "1"}
MANIFEST = "manifest"


def states_of(change: DataFrame) -> DataFrame:
    """(month, customer_id, sums ...): the change reduced to partial states; ``sign`` is 1 or -1."""
    return (change.groupBy(month_of("order_date").alias("month"), "customer_id")
            .agg(*[F.sum(F.expr(f"CAST(sign AS BIGINT) * {e}")).alias(n) for n, e in SUMS.items()]))


def _tag(month) -> F.Column:
    return F.coalesce(F.date_format(month, "yyyy-MM"), F.lit("none"))


def manifest(spark: SparkSession, base: str) -> dict[str, tuple[str, int]]:
    """{month tag: (folder, batch)} of the newest manifest: one entry a month."""
    if not _versions(spark, base, MANIFEST):
        return {}
    return {r.tag: (r.folder, r.batch) for r in read_latest(spark, base, MANIFEST).select("tag", "folder", "batch").collect()}


def _folders(spark: SparkSession, base: str, version: str) -> set[str]:
    """The folders that one manifest names: one a month."""
    return {r.folder for r in spark.read.parquet(f"{base.rstrip('/')}/{MANIFEST}/v={version}").select("folder").collect()}


def _read_states(spark: SparkSession, folders: list[str]) -> DataFrame:
    schema = "month DATE, customer_id BIGINT, " + ", ".join(f"{n} BIGINT" for n in SUMS)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def refresh(change: DataFrame, base: str, batch: int) -> list[str]:
    """Apply batch number ``batch`` of changed orders (columns of the orders table and ``sign``) to the store at ``base``.

    Returns the tags of the months written anew; none where a batch of this
    number or a later one has been applied already."""
    spark = change.sparkSession
    have = manifest(spark, base)
    if have and max(b for _, b in have.values()) >= batch:
        return []
    folder = f"{base.rstrip('/')}/states/b{batch:09d}-{uuid.uuid4().hex}"
    delta = states_of(change)
    delta.write.parquet(f"{folder}-delta")
    delta = spark.read.schema(delta.schema).parquet(f"{folder}-delta")
    touched = sorted(r.tag for r in delta.select(_tag("month").alias("tag")).distinct().collect())  # months of the calendar
    old = _read_states(spark, [have[m][0] for m in touched if m in have])
    both = (old.unionByName(delta).groupBy("month", "customer_id").agg(*[F.sum(n).alias(n) for n in SUMS])
            .where("rows_ <> 0").withColumn("tag", _tag("month")))
    # files follow the size of a month, not the number of tasks
    both.hint("rebalance", "tag").write.partitionBy("tag").parquet(folder)
    fs, _ = fs_of(spark, folder)
    left = [m for m in touched if fs.exists(fs_of(spark, f"{folder}/tag={m}")[1])]    # a month may have lost all its rows
    fresh = _read_states(spark, [f"{folder}/tag={m}" for m in left])
    rows = (fresh.groupBy(_tag("month").alias("tag")).agg(sketch("customer_id").alias("customers"))
            .select("tag", F.concat(F.lit(f"{folder}/tag="), F.col("tag")).alias("folder"), "customers"))
    if have:
        kept = read_latest(spark, base, MANIFEST).where(~F.col("tag").isin(touched))
        rows = rows.unionByName(kept.select("tag", "folder", "customers"))
    versions = _versions(spark, base, MANIFEST)
    dropped = _folders(spark, base, versions[-2]) if len(versions) > 1 else set()    # publish keeps the newest two
    version = publish(rows.withColumn("batch", F.lit(batch).cast("bigint")).coalesce(1), base, MANIFEST)
    # what only the dropped manifest names goes; the one before stays whole for those who are reading it
    for f in dropped - _folders(spark, base, version) - {f for f, _ in have.values()}:
        fs.delete(fs_of(spark, f)[1], True)
    fs.delete(fs_of(spark, f"{folder}-delta")[1], True)
    return touched


def monthly(spark: SparkSession, base: str) -> DataFrame:
    """The monthly view from the stored states."""
    states = _read_states(spark, [f for f, _ in manifest(spark, base).values()])
    return (states.groupBy("month")
            .agg(*[F.sum(n).alias(n) for n in SUMS], F.count("customer_id").alias("unique_customers"))
            .select("month", F.col("orders").alias("total_orders"), dollars("cents").alias("revenue"),
                    rnd(ratio(dollars("cents"), "priced")).alias("avg_order_value"), "unique_customers",
                    dollars("discounts").alias("total_discounts"), dollars("tax").alias("total_tax"),
                    F.col("cancelled").alias("cancelled_orders")))


def _loaded(t: Tables, base: str) -> str:
    """A store filled in two batches: the orders before 2001 with the cancelled ones of late 2000 booked by mistake;
    then those of 2001, the mistakes taken back."""
    o = t.orders
    late = F.col("order_date") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    wrong = (F.col("order_status") == "Cancelled") & (F.col("order_date") >= F.lit("2000-11-01 00:00:00").cast("timestamp_ntz")) & ~late
    good = F.col("order_status") != "Cancelled"
    undated = F.col("order_date").isNull()
    refresh(o.where((good & (~late | undated)) | wrong).withColumn("sign", F.lit(1)), base, 1)
    refresh(o.where((good & late) | wrong).withColumn("sign", F.when(wrong, -1).otherwise(1)), base, 2)
    return base


@query("refreshed_monthly_revenue", ORACLE["mv_monthly_revenue"])
def refreshed_monthly_revenue(t: Tables, base: str | None = None) -> DataFrame:
    """The monthly view after a first load and a refresh by change."""
    return monthly(t.spark, _loaded(t, base or _scratch(t))).orderBy(F.col("month").desc())


@query("distinct_customers_sketch", oracle(f"""
SELECT COALESCE(CAST(CAST(year(order_date) AS INTEGER) AS VARCHAR), 'all') AS period,
       COUNT(DISTINCT customer_id) AS exact_customers, TRUE AS estimate_within_error
FROM b_orders WHERE {KEPT} AND order_date IS NOT NULL GROUP BY GROUPING SETS ((year(order_date)), ())"""))
def distinct_customers_sketch(t: Tables, base: str | None = None) -> DataFrame:
    """Customers per year and over all: the exact count, and whether the
    estimate from the merged monthly sketches keeps the stated error."""
    base = _loaded(t, base or _scratch(t))
    months = read_latest(t.spark, base, MANIFEST).where("tag <> 'none'").select(F.substring("tag", 1, 4).alias("period"), "customers")
    years = months.groupBy("period").agg(merged("customers").alias("customers"))
    est = years.unionByName(years.agg(F.lit("all").alias("period"), merged("customers").alias("customers")).where("customers IS NOT NULL"))
    states = _read_states(t.spark, [f for f, _ in manifest(t.spark, base).values()]).where("month IS NOT NULL AND customer_id IS NOT NULL")
    pairs = states.select(F.year("month").cast("string").alias("period"), "customer_id").distinct()
    exact = pairs.groupBy("period").agg(F.count(F.lit(1)).alias("exact_customers")).unionByName(
        pairs.select("customer_id").distinct().agg(F.lit("all").alias("period"), F.count(F.lit(1)).alias("exact_customers")).where("exact_customers > 0"))
    return exact.join(est, "period").select(
        "period", "exact_customers", within_error(estimate("customers"), F.col("exact_customers")).alias("estimate_within_error"))
