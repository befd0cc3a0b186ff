"""Seeded generators: reproducible, distributed, invariants hold."""

from pyspark.sql import functions as F

from tillroll.operators.generate import seed_catalog, synth_dimensions, synth_orders


def test_generators_are_reproducible_and_consistent(spark):
    cat = seed_catalog(spark)
    assert cat["categories"].count() == 15
    a = synth_orders(spark, cat["products"], n_orders=300, seed=5)
    b = synth_orders(spark, cat["products"], n_orders=300, seed=5)
    assert sorted(map(tuple, a["orders"].collect())) == sorted(map(tuple, b["orders"].collect()))
    items, orders = a["order_items"], a["orders"]
    assert items.select("order_item_id").distinct().count() == items.count()
    per = items.groupBy("order_id").agg(F.count("*").alias("n"), F.sum("subtotal").alias("s"))
    assert per.where("n < 1 or n > 5").count() == 0
    j = orders.join(per, "order_id")
    assert j.where(F.round(F.col("s") * 1.08 + F.col("shipping_cost"), 2) != F.col("total_amount")).count() == 0
    assert a["shipping"].count() == orders.where("order_status = 'Delivered'").count()
    dims = synth_dimensions(spark, cat["products"], n_customers=50)
    assert dims["customers"].select("email").distinct().count() == 50
