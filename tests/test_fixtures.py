"""Hand-made edge cases with hand-computed answers (FIXTURES.md section 3)."""

import datetime as dt

from tillroll.operators import advanced, customer as cust, marketing, operations, product, sales
from tillroll.plans import jobs, views

from .fixtures import customer, fixture_tables, item, order, product as prod

TS = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_null_status_dropped_by_not_equal(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 10),
                                      order(2, 1, TS(2024, 1, 6), None, 20),
                                      order(3, 1, TS(2024, 1, 7), "Cancelled", 40)],
                       customers=[customer(1)])
    t.__dict__["valid_orders"] = t.orders.where("order_status != 'Cancelled'")
    assert rows(sales.monthly_revenue(t), "total_orders", "total_revenue") == [(1, 10.0)]


def test_only_cancelled_customer(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 2, 1), "Delivered", 10),
                                      order(2, 2, TS(2024, 2, 1), "Cancelled", 99)],
                       customers=[customer(1), customer(2), customer(3)])
    assert [r.customer_id for r in cust.customer_clv(t).collect()] == [1]
    vm = {r.customer_id: (r.total_orders, r.customer_status) for r in views.v_customer_metrics(t).collect()}
    assert vm == {1: (1, "Active"), 2: (0, "Never Purchased"), 3: (0, "Never Purchased")}
    seg = {r.customer_id: r.customer_segment for r in jobs.update_segments(t).collect()}
    assert seg == {1: "New", 2: "Regular", 3: "Regular"}   # no valid order: segment kept


def test_noon_order_one_and_a_half_days_before_as_of_is_one_day(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 2, 28, 12), "Delivered", 10)],
                       customers=[customer(1)], as_of=dt.date(2024, 3, 1))
    assert cust.customer_clv(t).first().days_since_last_order == 1


def test_review_fan_out_literal_vs_corrected(spark):
    its = [item(1, 7, 1, 2, 5), item(2, 7, 1, 1, 5), item(3, 7, 1, 4, 5)]
    revs = [(7, 1, 1, 5, "x", TS(2024, 1, 2), True), (7, 1, 2, 4, "y", TS(2024, 1, 3), True)]
    t = fixture_tables(spark, orders=[order(i, 1, TS(2024, 1, i), "Delivered", 10) for i in (1, 2, 3)],
                       items=its, products=[prod(7, "p7", 5)], reviews=revs, customers=[customer(1)])
    lit = product.review_analysis(t).first()
    cor = product.review_analysis_corrected(t).first()
    assert (lit.total_reviews, lit.five_star, lit.units_sold, lit.avg_rating) == (6, 3, 14, 4.5)
    assert (cor.total_reviews, cor.five_star, cor.units_sold, cor.avg_rating) == (2, 1, 7, 4.5)


def test_campaign_touched_twice_doubles_literal_revenue(spark):
    inter = [(1, 1, 1, TS(2024, 1, 1), TS(2024, 1, 3)), (2, 1, 1, TS(2024, 1, 2), None)]
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 100, campaign=1)],
                       customers=[customer(1)], interactions=inter)
    lit = {r.campaign_id: r for r in marketing.campaign_roi(t).collect()}[1]
    cor = {r.campaign_id: r for r in marketing.campaign_roi_corrected(t).collect()}[1]
    assert (lit.campaign_revenue, cor.campaign_revenue) == (200.0, 100.0)
    assert (lit.total_interactions, lit.conversions, lit.avg_order_value) == (1, 1, 100.0)
    att = {r.campaign_id: r for r in marketing.attribution(t).collect()}[1]
    assert (att.avg_days_to_conversion, att.attributed_revenue) == (2.0, 200.0)


def test_same_product_twice_in_one_order_basket(spark):
    its = [item(1, 1, 1, 1, 5), item(1, 1, 2, 1, 5), item(1, 2, 3, 1, 5)] + \
          [item(o, 1, 1, 1, 5) for o in (2, 3)] + [item(o, 2, 2, 1, 5) for o in (2, 3)]
    t = fixture_tables(spark, orders=[order(o, 1, TS(2024, 1, o), "Delivered", 10) for o in (1, 2, 3)],
                       items=its, products=[prod(1, "a", 5), prod(2, "b", 5)], customers=[customer(1)])
    lit = advanced.market_basket(t).first()
    assert lit.times_bought_together == 4          # 2 line pairs in order 1, 1 each in orders 2, 3
    assert lit.support_pct == round(4 * 100 / 3, 2)
    cor = advanced.market_basket_corrected(t).first()
    assert cor.times_bought_together == 3          # distinct orders


def test_churn_gaps_and_single_order_customers(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 1), "Delivered", 10),
                                      order(2, 1, TS(2024, 1, 11), "Delivered", 10),
                                      order(3, 1, TS(2024, 1, 31), "Delivered", 10),
                                      order(4, 1, TS(2024, 2, 20), "Cancelled", 10),
                                      order(5, 2, TS(2024, 1, 1), "Delivered", 10)],
                       customers=[customer(1), customer(2)], as_of=dt.date(2024, 3, 1))
    (r,) = advanced.churn_risk(t).collect()      # customer 2 has one order: excluded
    assert (r.customer_id, r.avg_days_between_orders, r.days_since_last_order) == (1, 15.0, 30)
    assert r.churn_risk == "Medium Risk"           # 30 > 22.5 but not > 30
    assert r.expected_next_purchase == TS(2024, 3, 6, 0)   # last order of any status + 15 days


def test_cohort_skipping_a_month(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 10),
                                      order(2, 1, TS(2024, 3, 5), "Delivered", 10),
                                      order(3, 2, TS(2024, 1, 9), "Delivered", 10)],
                       customers=[customer(1), customer(2)])
    (r,) = advanced.cohort_retention_corrected(t).collect()
    assert (r.month_0, r.month_1, r.month_2, r.retention_month_1_pct) == (2, 0, 1, 0.0)


def test_category_without_products(spark):
    cats = [(1, "Cat/A", None, 1), (2, "EMPTY", None, 2)]
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 10)],
                       items=[item(1, 1, 1, 2, 5)], products=[prod(1, "a", 5)], categories=cats,
                       customers=[customer(1)],
                       inventory=[(1, 1, "East Warehouse", 100, 50, dt.date(2024, 1, 1))])
    cp = {r.category_name: (r.products_in_category, r.orders) for r in product.category_performance(t).collect()}
    assert cp == {"Cat/A": (1, 1), "EMPTY": (0, 0)}
    assert [r.category_name for r in views.mv_category_performance(t).collect()] == ["Cat/A"]


def test_shipping_on_estimate_is_on_time(spark):
    d = dt.date
    ship = [(1, 1, d(2024, 1, 2), d(2024, 1, 6), d(2024, 1, 6), "UPS", "T1"),
            (2, 1, d(2024, 1, 2), d(2024, 1, 9), d(2024, 1, 6), "UPS", "T2"),
            (3, 1, d(2024, 1, 2), None, d(2024, 1, 6), "UPS", "T3")]
    t = fixture_tables(spark, shipping=ship)
    r = operations.shipping_performance(t).first()
    assert (r.total_shipments, r.on_time_deliveries, r.delayed_deliveries, r.avg_delay_days) == (2, 1, 1, 3.0)


def test_sales_report_end_day_only_at_midnight(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 31, 0), "Delivered", 10),
                                      order(2, 1, TS(2024, 1, 31, 12), "Delivered", 20)],
                       customers=[customer(1)])
    r = jobs.sales_report(t, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).first()
    assert (r.total_orders, r.total_revenue) == (1, 10.0)


def test_asof_last_touch_attribution(spark):
    from tillroll.operators import extras
    inter = [(1, 1, 1, TS(2024, 1, 1), None), (2, 1, 2, TS(2024, 1, 10), None),
             (3, 2, 3, TS(2024, 1, 20), None)]
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 10),    # -> campaign 1
                                      order(2, 1, TS(2024, 1, 10), "Delivered", 20),   # tie -> campaign 2
                                      order(3, 1, TS(2024, 2, 1), "Delivered", 40),    # carried -> 2
                                      order(4, 2, TS(2024, 1, 19), "Delivered", 80)],  # before touch
                       customers=[customer(1), customer(2)], interactions=inter)
    got = {r.campaign_name: (r.orders, r.revenue) for r in extras.attribution_asof_last_touch(t).collect()}
    assert got == {"Summer Sale 2024": (1, 10.0), "Back to School": (2, 60.0), "Unattributed": (1, 80.0)}


def test_null_status_kept_where_the_filter_admits_it(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 2, 1), None, 10),
                                      order(2, 2, TS(2024, 2, 1), "Delivered", 20)],
                       customers=[customer(1), customer(2)])
    assert sorted(r.customer_id for r in cust.customer_clv(t).collect()) == [1, 2]   # OR IS NULL
    assert sorted(r.customer_id for r in cust.vip_customers(t).collect()) == [2]     # plain !=
    assert rows(cust.purchase_frequency(t), "order_count", "customers") == [(1, 2)]


def test_churn_orders_all_on_one_day_have_zero_gap(spark):
    t = fixture_tables(spark, orders=[order(1, 1, TS(2024, 1, 5), "Delivered", 10),
                                      order(2, 1, TS(2024, 1, 5), "Delivered", 20)],
                       customers=[customer(1)], as_of=dt.date(2024, 3, 1))
    (r,) = advanced.churn_risk(t).collect()
    assert (r.avg_days_between_orders, r.churn_risk, r.expected_next_purchase) == \
        (0.0, "High Risk", TS(2024, 1, 5))


def test_acquisition_null_signup_month_sorts_last(spark):
    t = fixture_tables(spark, customers=[customer(1, signup=dt.date(2024, 1, 3)),
                                         customer(2, signup=dt.date(2024, 2, 9)),
                                         customer(3, signup=None)])
    got = {r.month: r.cumulative_customers for r in cust.customer_acquisition(t).collect()}
    assert got == {dt.date(2024, 1, 1): 1, dt.date(2024, 2, 1): 2, None: 3}
