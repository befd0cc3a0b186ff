"""Closure by path doubling, fixed-size samples, decomposition and forecast on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.functions.hierarchy import closure
from tillroll.operators import series
from tillroll.operators.samples import fixed_sample


def _closed(spark, edges):
    above, cycles = closure(spark.createDataFrame(edges, "node string, parent string"))
    return {(r.node, r.ancestor): r.steps for r in above.collect()}, {r.node for r in cycles.collect()}


def test_closure_of_a_long_chain_and_a_bush(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(13)]
    bush = [("x", "n5"), ("y", "n5"), ("z", "x"), ("z", "x"), (None, "q"), ("root", None)]
    got, cycles = _closed(spark, chain + bush)
    want = {(f"n{i}", f"n{j}"): j - i for i in range(13) for j in range(i + 1, 14)}
    for leaf, start in (("x", 5), ("y", 5)):
        want |= {(leaf, f"n{j}"): j - start + 1 for j in range(start, 14)}
    want |= {("z", "x"): 1} | {("z", f"n{j}"): j - 5 + 2 for j in range(5, 14)}
    assert got == want and cycles == set()


def test_cycles_are_reported_and_leave_the_rest_alone(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("tail", "a"), ("tip", "tail"), ("me", "me"), ("leaf", "mid"), ("mid", "top")]
    got, cycles = _closed(spark, edges)
    assert cycles == {"a", "b", "c", "me"}
    assert got == {("leaf", "mid"): 1, ("leaf", "top"): 2, ("mid", "top"): 1}
    assert _closed(spark, []) == ({}, set())
    with pytest.raises(ValueError, match="more than one parent"):
        _closed(spark, [("a", "b"), ("a", "c")])


def test_sample_is_the_same_for_any_partitioning_and_has_its_size(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("g"))
    rows = lambda d: sorted(r.id for r in d.collect())
    one = rows(fixed_sample(df.coalesce(1), 100, ["id"], seed=5))
    assert len(one) == 100 and one == rows(fixed_sample(df.repartition(13), 100, ["id"], seed=5))
    assert one != rows(fixed_sample(df, 100, ["id"], seed=6))
    # the sample of the parts' samples is that of the whole
    parts = fixed_sample(df.where("id < 700"), 100, ["id"], seed=5).unionByName(fixed_sample(df.where("id >= 700"), 100, ["id"], seed=5))
    assert one == rows(fixed_sample(parts, 100, ["id"], seed=5))
    by = fixed_sample(df.where("g < 2 OR id < 30"), 40, ["id"], within=["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in by} == {0: 40, 1: 40, 2: 10}
    plan = fixed_sample(df, 40, ["id"], within=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and rows(fixed_sample(df, 0, ["id"])) == []


def _months(spark, values, name="A"):
    rows = [(name, dt.date(2000 + i // 12, 1 + i % 12, 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "category string, month date, e4 long")


def test_decomposition_adds_up_and_finds_a_known_season(spark, tables, monkeypatch):
    season = [-6, -5, -4, -3, -2, -1, 1, 2, 3, 4, 5, 6]
    values = [(1000 + 10 * i + 100 * season[i % 12]) * 10_000 for i in range(48)]
    monkeypatch.setattr(series, "category_months", lambda t: _months(spark, values))
    got = sorted(series.trend_decompose(tables).collect(), key=lambda r: r.month)
    assert [r.trend is None for r in got] == [True] * 6 + [False] * 36 + [True] * 6
    for i, r in enumerate(got):
        assert abs(r.season - 100 * season[i % 12]) < 0.01
        if r.trend is not None:
            assert abs(r.trend - (1000 + 10 * i)) < 0.01 and abs(r.trend + r.season + r.remainder - r.revenue) < 0.02


def test_forecast_follows_the_recursion_and_needs_a_year(spark, tables, monkeypatch):
    values = [(500 + 7 * i + (i * i) % 11) * 10_000 for i in range(30)]
    both = _months(spark, values).unionByName(_months(spark, values[:11], "short"))
    monkeypatch.setattr(series, "category_months", lambda t: both)
    y = [v / 1e4 for v in values]
    level, trend = sum(y[:12]) / 12, 0.0
    season = [v - level for v in y[:12]]
    for v in y[12:]:
        new = series.ALPHA * (v - season[0]) + (1 - series.ALPHA) * (level + trend)
        trend = series.BETA * (new - level) + (1 - series.BETA) * trend
        season = season[1:] + [series.GAMMA * (v - new) + (1 - series.GAMMA) * season[0]]
        level = new
    got = series.revenue_forecast(tables).orderBy("months_ahead").collect()
    assert [(r.category, r.month, r.months_ahead) for r in got] == [("A", dt.date(2002, 6 + h, 1), h) for h in (1, 2, 3)]
    assert all(abs(r.forecast - (level + h * trend + season[h - 1])) < 0.01 for h, r in zip((1, 2, 3), got, strict=True))
