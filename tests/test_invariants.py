"""Invariants that hold whatever the data (SURVEY test strategy, point 3)."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import advanced, customer, marketing, product, sales
from tillroll.plans import views


@pytest.mark.parametrize("fn,col", [
    (sales.revenue_by_payment, "revenue_percentage"),
    (sales.revenue_by_status, "order_percentage"),
    (product.category_performance, "revenue_share_pct"),
    (customer.purchase_frequency, "customer_percentage"),
])
def test_shares_sum_to_100(tables, fn, col):
    total = fn(tables).agg(F.sum(col)).first()[0]
    assert abs(total - 100.0) < 0.05 * fn(tables).count()   # each share rounded to 0.01


def test_affinity_is_symmetric_and_cosine_bounded(tables):
    po = advanced.valid_order_products(tables).select("order_id", "product_id")
    pairs, _ = advanced.affinity_pairs(po, 1)
    rows = {(r.product_a, r.product_b): r.co_occurrence for r in pairs.collect()}
    assert rows and all(rows[(b, a)] == c for (a, b), c in rows.items())
    got = advanced.product_affinity(tables, min_co=1, k=1000)
    assert got.where("cosine_similarity > 1 or cosine_similarity <= 0").count() == 0


def test_corrected_totals_match_base_tables(tables):
    valid_items = tables.items.join(tables.valid_orders.select("order_id"), "order_id", "left_semi")
    item_rev = valid_items.agg(F.sum("subtotal_e4")).first()[0] / 1e4
    mv = views.mv_category_performance_corrected(tables).agg(F.sum("revenue")).first()[0]
    assert mv == pytest.approx(item_rev, rel=1e-12)
    camp = tables.valid_orders.where("campaign_id IS NOT NULL").agg(F.sum("total_cents")).first()[0] / 100
    direct = marketing.campaign_roi_direct(tables).agg(F.sum("campaign_revenue")).first()[0]
    assert direct == pytest.approx(camp, rel=1e-12)
    # corrected attribution never exceeds the campaigns' own order revenue
    corr = marketing.campaign_roi_corrected(tables).agg(F.sum("campaign_revenue")).first()[0]
    assert corr <= camp + 1e-6


def test_literal_fan_out_never_below_corrected(tables):
    lit = {r.campaign_id: r.campaign_revenue for r in marketing.campaign_roi(tables).collect()}
    cor = {r.campaign_id: r.campaign_revenue for r in marketing.campaign_roi_corrected(tables).collect()}
    assert all(lit[k] >= cor[k] for k in lit)
