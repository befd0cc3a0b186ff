"""Range-bucketed row numbers and NTILE equal Spark's single-partition window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.ranking import add_ntiles, add_row_number


def _frame(spark, n=997):
    # one hot value holding a third of the rows, plus spread values
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 41).alias("v"),
        (F.col("id") * 37 % 101).cast("double").alias("w"))


@pytest.mark.parametrize("nb", [1, 2, 5, 13])
def test_ntile_matches_builtin(spark, nb):
    df = _frame(spark)
    got = add_ntiles(df, [("a", 5, [("v", True), ("k", True)]),
                          ("b", 4, [("w", False), ("k", True)])], ranges=nb)
    want = df.select("k",
                     F.ntile(5).over(Window.orderBy("v", "k")).alias("a"),
                     F.ntile(4).over(Window.orderBy(F.col("w").desc(), "k")).alias("b"))
    assert sorted(map(tuple, got.select("k", "a", "b").collect())) == sorted(map(tuple, want.collect()))


def test_ntile_small_inputs(spark):
    for n in (1, 3, 7, 10):
        df = _frame(spark, n)
        got = add_ntiles(df, [("t", 5, [("v", True), ("k", True)])], ranges=3)
        want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("t"))
        assert sorted(map(tuple, got.select("k", "t").collect())) == sorted(map(tuple, want.collect()))


def test_seven_equal_customers_split_2_2_1_1_1(spark):
    df = spark.range(1, 8).select(F.col("id").alias("customer_id"), F.lit(3).alias("frequency"))
    got = add_ntiles(df, [("f", 5, [("frequency", False), ("customer_id", True)])], ranges=2)
    sizes = sorted((r["f"], r["count"]) for r in got.groupBy("f").count().collect())
    assert sizes == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1)]
    # the tie-break is the id: customers 1, 2 land in tile 1
    assert [r["customer_id"] for r in got.where("f = 1").orderBy("customer_id").collect()] == [1, 2]


def test_row_number_matches_builtin(spark):
    df = _frame(spark)
    got = add_row_number(df, "rn", [("v", False), ("k", True)], ranges=6)
    want = df.select("k", F.row_number().over(Window.orderBy(F.col("v").desc(), "k")).alias("rn"))
    assert sorted(map(tuple, got.select("k", "rn").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("nb", [1, 4])
def test_null_keys_rank_as_in_a_window(spark, nb):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float(i % 7)) for i in range(83)], "k long, v double")
    got = add_ntiles(df, [("a", 5, [("v", True), ("k", True)]), ("d", 5, [("v", False), ("k", True)])], ranges=nb)
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("a"),
                     F.ntile(5).over(Window.orderBy(F.col("v").desc(), "k")).alias("d"))
    assert sorted(map(tuple, got.select("k", "a", "d").collect())) == sorted(map(tuple, want.collect()))


def test_a_thousand_ranges(spark):
    df = _frame(spark, 4000)
    got = add_ntiles(df, [("a", 5, [("v", True), ("k", True)])], ranges=1000)
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("a"))
    assert sorted(map(tuple, got.select("k", "a").collect())) == sorted(map(tuple, want.collect()))


def test_empty_frame(spark):
    assert add_ntiles(_frame(spark, 0), [("a", 5, [("v", True), ("k", True)])]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 23, 3000])
def test_ntile_by_selection_of_whole_numbers(spark, n):
    # a third of the rows share a value, a seventh have none; ids run against the values
    df = spark.range(n).select(
        (5000 - F.col("id")).alias("k"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 31 % 997).alias("v"),
        (F.col("id") % 2).cast("int").alias("w"))
    got = add_ntiles(df, [("a", 5, [("v", True), ("k", True)]), ("b", 7, [("v", False), ("k", True)]), ("c", 4, [("w", False), ("k", False)]),
                          ("d", 1, [("v", True), ("k", True)])])
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("a"), F.ntile(7).over(Window.orderBy(F.desc("v"), "k")).alias("b"),
                     F.ntile(4).over(Window.orderBy(F.desc("w"), F.desc("k"))).alias("c"), F.lit(1).alias("d"))
    assert sorted(map(tuple, got.select("k", "a", "b", "c", "d").collect())) == sorted(map(tuple, want.collect()))


def test_rfm_plan_writes_nothing_and_sorts_only_the_cut_buckets(spark, tables, monkeypatch):
    from pyspark.sql import DataFrame

    from tillroll.operators.customer import _rfm_scored
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("checkpoint while the plan is built"))
    plan = _rfm_scored(tables, False)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("n,buckets", [(0, 8), (1, 8), (2, 8), (2000, 8), (2000, 64)])
def test_percent_rank_matches_builtin(spark, n, buckets, asc):
    # one value holds a third of the rows, several percentiles long
    from tillroll.functions.ranking import add_percent_rank
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(50)).when(F.col("id") % 11 == 0, None)
                               .otherwise(F.col("id") * 37 % 211).alias("v"))
    got = add_percent_rank(df, "p", "v", asc, buckets)
    want = df.select("id", F.percent_rank().over(Window.orderBy(F.col("v").asc() if asc else F.col("v").desc())).alias("p"))
    assert sorted(map(tuple, got.select("id", "p").collect())) == sorted(map(tuple, want.collect()))
