"""Refresh by change: equal to a full rebuild, only touched months rewritten, batches applied once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tillroll.functions.sketches import estimate, merged, relative_error, sketch, within_error
from tillroll.plans import incremental
from tillroll.plans.views import mv_monthly_revenue

from .fixtures import fixture_tables, order


def _files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{base}/states") for f in names if f.startswith("part-")}


def _when(month, day):
    return dt.datetime(2024, month, day)


def test_only_touched_months_are_rewritten_and_the_result_is_a_full_rebuild(spark, scratch):
    first = [order(i, i % 7, _when(1 + i % 4, 1 + i % 20), "Delivered", 10 + i) for i in range(60)]
    more = [order(100 + i, 50 + i % 3, _when(4, 2 + i), "Pending", 5) for i in range(5)] + [order(200, 1, _when(6, 1), "Delivered", 9)]
    gone = first[3:4]                                           # January's? 3 % 4 == 3: an April row taken back
    t = fixture_tables(spark, orders=first)
    signed = lambda rows, s: fixture_tables(spark, orders=rows).orders.withColumn("sign", F.lit(s))
    assert incremental.refresh(signed(first, 1), scratch, 1) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    before = _files(scratch)
    change = signed(more, 1).unionByName(signed(gone, -1))
    assert incremental.refresh(change, scratch, 2) == ["2024-04", "2024-06"]
    after = _files(scratch)
    kept = {f: m for f, m in before.items() if "tag=2024-04" not in f}
    assert kept and {f: after.get(f) for f in kept} == kept           # same files, not written again
    assert all(f in after for f in before)                            # the last manifest but one can still be read
    full = fixture_tables(spark, orders=[o for o in first if o not in gone] + more)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(incremental.monthly(spark, scratch)) == rows(mv_monthly_revenue(full))
    # a batch that was applied is not applied again
    assert incremental.refresh(change, scratch, 2) == [] and incremental.refresh(change, scratch, 1) == []
    assert rows(incremental.monthly(spark, scratch)) == rows(mv_monthly_revenue(full))
    # once no kept manifest names it, the old April is removed
    assert incremental.refresh(signed([order(300, 9, _when(7, 1), "Delivered", 3)], 1), scratch, 3) == ["2024-07"]
    left = _files(scratch)
    assert not any("tag=2024-04" in f for f in before if f in left) and all(f in left for f in kept)
    assert t.orders.count() == 60


def test_a_month_that_loses_all_rows_and_undated_orders(spark, scratch):
    rows = [order(1, 1, _when(1, 1), "Delivered", 5), order(2, 2, _when(2, 1), "Delivered", 6), order(3, 3, None, "Delivered", 7)]
    t = fixture_tables(spark, orders=rows)
    incremental.refresh(t.orders.withColumn("sign", F.lit(1)), scratch, 1)
    assert incremental.refresh(t.orders.where("order_id = 2").withColumn("sign", F.lit(-1)), scratch, 2) == ["2024-02"]
    got = {r.month: r.total_orders for r in incremental.monthly(spark, scratch).collect()}
    assert got == {dt.date(2024, 1, 1): 1, None: 1}


def test_an_unfinished_refresh_changes_nothing(spark, scratch):
    t = fixture_tables(spark, orders=[order(1, 1, _when(1, 1), "Delivered", 5)])
    incremental.refresh(t.orders.withColumn("sign", F.lit(1)), scratch, 1)
    os.makedirs(f"{scratch}/states/b000000002-dead/tag=2024-01")      # written states, no manifest
    os.makedirs(f"{scratch}/manifest/v=99999999T000000000000-dead")   # a manifest without its marker
    assert [r.total_orders for r in incremental.monthly(spark, scratch).collect()] == [1]


def test_merged_sketches_keep_their_error(spark):
    df = spark.range(40_000).select((F.col("id") % 30_000).alias("c"), (F.col("id") % 12).alias("m"))
    parts = df.groupBy("m").agg(sketch("c").alias("s"))
    row = parts.agg(estimate(merged("s")).alias("est")).withColumn("ok", within_error(F.col("est"), F.lit(30_000))).first()
    assert row.ok and abs(row.est - 30_000) <= relative_error() * 30_000
    empty = df.where("m > 99").agg(estimate(sketch("c")).alias("e")).first().e
    assert empty == 0
    exact = spark.range(20).agg(estimate(sketch("id")).alias("e")).first().e
    assert exact == 20
