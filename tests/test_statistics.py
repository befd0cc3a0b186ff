"""The join order follows the stored statistics: it changes when they do."""

from pyspark.sql import functions as F

from tillroll.plans import statistics as st


def _order(spark, session, folder, name, dear, delivered):
    """Joined tables of the star over made-up tables in which ``dear`` and ``delivered`` of 100 rows pass the filters."""
    base = f"{folder}/{name}"
    items = st.store(spark.range(4000).select((F.col("id") % 1000).alias("order_id"), (F.col("id") % 500).alias("product_id"),
                                              F.lit(1).cast("bigint").alias("quantity"), F.lit(5).cast("bigint").alias("subtotal_e4")), session, "items", base)
    status = F.when(F.col("id") % 100 < delivered, "Delivered").otherwise(F.concat(F.lit("s"), (F.col("id") % (1 if delivered > 50 else 60)).cast("string")))
    orders = st.store(spark.range(1000).select(F.col("id").alias("order_id"), status.alias("order_status")), session, "orders", base)
    price = F.when(F.col("id") % 100 < dear, 98000 + F.col("id") % 100).otherwise(F.lit(97_990) if dear > 50 else F.col("id"))
    products = st.store(spark.range(500).select(F.col("id").alias("product_id"), F.lit("S").alias("supplier"), price.alias("price_cents")), session, "products", base)
    df = st.star(session, items, orders, products)
    return df, st.joined_tables(df)


def test_join_order_changes_with_the_statistics(spark, scratch):
    own = st.ordering(spark)
    df, few_dear = _order(spark, own, scratch, "a", dear=2, delivered=90)
    _, few_delivered = _order(spark, own, scratch, "b", dear=95, delivered=1)
    # the table that leaves least over is joined to the items first
    assert few_dear == [["items", "products"], ["orders"]] and few_delivered == [["items", "orders"], ["products"]]
    assert df.collect()[0].supplier == "S"


def test_the_callers_session_is_left_as_it_is(spark):
    st.ordering(spark)
    assert spark.conf.get("spark.sql.cbo.enabled") == "false" and spark.conf.get("spark.sql.cbo.joinReorder.enabled") == "false"
