"""Materialized-view refresh, segment update write, table counts."""

from tillroll.plans.jobs import read_latest, refresh_materialized, write_segment_update
from tillroll.plans.views import mv_monthly_revenue


def test_refresh_publishes_new_versions_and_keeps_two(spark, tables, scratch):
    base = f"{scratch}/mv"
    versions = [refresh_materialized(tables, base)["mv_monthly_revenue"] for _ in range(3)]
    assert len(set(versions)) == 3
    stored = read_latest(spark, base, "mv_monthly_revenue")
    want = mv_monthly_revenue(tables)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.collect()))
    import os
    kept = sorted(d for d in os.listdir(f"{base}/mv_monthly_revenue") if d.startswith("v="))
    assert kept == [f"v={v}" for v in versions[-2:]]


def test_unfinished_version_is_invisible(spark, tables, scratch):
    import os
    base = f"{scratch}/mv2"
    v = refresh_materialized(tables, base)["mv_category_performance"]
    os.makedirs(f"{base}/mv_category_performance/v=99999999T000000000000-dead")  # no _SUCCESS
    assert read_latest(spark, base, "mv_category_performance").inputFiles()[0].count(v) == 1


def test_segment_update_write(spark, tables, scratch):
    write_segment_update(tables, scratch)
    df = read_latest(spark, scratch, "customers")
    assert df.count() == tables.customers.count()
    assert set(r[0] for r in df.select("customer_segment").distinct().collect()) <= {
        "VIP", "Regular", "New", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"}
