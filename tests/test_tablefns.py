"""Single-key calls of the table functions equal the batch result for that key."""

from pyspark.sql import functions as F

from tillroll.plans import tablefns as TF


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_customer_ltv_single(tables):
    cid = tables.orders.select("customer_id").first()[0]
    assert _rows(TF.customer_ltv(tables, customer_id=cid)) == \
        _rows(TF.customer_ltv(tables).where(F.col("customer_id") == cid))


def test_top_products_single_category(tables):
    cat = tables.products.select("category_id").first()[0]
    for fn in (TF.top_products_by_category, TF.top_products_by_category_corrected):
        one = fn(tables, category_id=cat, k=5)
        assert one.count() <= 5
        assert _rows(one) == _rows(fn(tables, k=5).where(F.col("category_id") == cat))


def test_campaign_roi_single(tables):
    for fn in (TF.campaign_roi_fn, TF.campaign_roi_fn_corrected):
        assert _rows(fn(tables, campaign_id=3)) == _rows(fn(tables).where("campaign_id = 3"))


def test_purchase_history_single(tables):
    cid = tables.orders.select("customer_id").first()[0]
    got = TF.purchase_history(tables, customer_id=cid, days=3650)
    assert _rows(got) == _rows(TF.purchase_history(tables, days=3650).where(F.col("customer_id") == cid))


def test_recommend_single_seed(tables):
    pid = tables.items.select("product_id").first()[0]
    assert _rows(TF.recommend_products(tables, product_id=pid)) == \
        _rows(TF.recommend_products(tables).where(F.col("product_id") == pid))
