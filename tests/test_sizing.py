"""What one task is dealt does not grow with the input: registered queries have
partitions in proportion to their stored input, whatever the caller's session has."""

import re

import pytest

from tillroll import Tables, registry, session
from tillroll.session import TASK_BYTES, _bytes, sized_session, stored_bytes
from tillroll.sources.driver import DRIVER_SCHEMAS, table_path

from .conftest import SF_SMALL
from .helpers import canon

PATHS = [table_path(SF_SMALL, t) for t in DRIVER_SCHEMAS]
NARROW = 8 << 10    # bytes of input a partition, so that the small tables are many partitions
registry.load_all()


@pytest.fixture()
def few(spark):
    """The caller's session has four shuffle partitions, whatever tests before have set."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "4")
    yield 4
    spark.conf.set(key, old)


def _rows(df):
    return canon(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", ["market_basket", "market_basket_min5", "category_performance", "mv_category_performance_corrected",
                                  "recommend_products", "cancellation_rate_by_product", "dq_foreign_key", "mv_category_performance",
                                  "best_sellers"])
def test_shuffles_have_partitions_in_proportion_to_the_input(spark, tables, monkeypatch, few, name):
    monkeypatch.setattr(session, "PARTITION_BYTES", NARROW)
    most = stored_bytes(spark, PATHS) // NARROW
    assert most > 5 * few
    df = registry.runner(name)(spark, SF_SMALL)
    dealt = [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]
    assert dealt and min(dealt) >= most, dealt
    assert _rows(df) == _rows(registry.QUERIES[name](tables))


@pytest.mark.parametrize("name", ["stored_monthly_revenue", "stored_category_performance", "supplier_revenue_by_cost"])
def test_stored_results_are_built_and_read_with_them(spark, tables, monkeypatch, few, name):
    monkeypatch.setattr(session, "PARTITION_BYTES", NARROW)
    df = registry.runner(name)(spark, SF_SMALL)
    assert int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) >= stored_bytes(spark, PATHS) // NARROW
    assert _rows(df) == _rows(registry.QUERIES[name](Tables(spark, SF_SMALL)))


def test_partitions_grow_with_the_input_and_the_callers_session_stays(spark, scratch, few):
    before = spark.conf.getAll
    counts = []
    for n, size in enumerate((10 * session.PARTITION_BYTES, 100 * session.PARTITION_BYTES + 1)):
        with open(f"{scratch}/{n}.parquet", "wb") as f:
            f.truncate(size)
        own = sized_session(spark, [f"{scratch}/{n}.parquet", f"{scratch}/none.parquet"])
        counts.append(own.conf.get("spark.sql.shuffle.partitions"))
        assert all(_bytes(own.conf.get(k)) <= most for k, most in TASK_BYTES.items())
    assert counts == ["10", "101"]
    assert spark.conf.getAll == before


def test_settings_of_the_caller_hold(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    try:
        spark.conf.set(key, "1k")
        spark.conf.set("spark.sql.shuffle.partitions", "77")
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        own = sized_session(spark, PATHS)
        assert [_bytes(own.conf.get(key)), own.conf.get("spark.sql.shuffle.partitions"), own.conf.get("spark.sql.session.timeZone")] == [1024, "77", "Asia/Tokyo"]
    finally:
        spark.conf.unset(key)
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text,size", [("64m", 64 << 20), ("64MB", 64 << 20), ("67108864b", 64 << 20), ("67108864", 64 << 20), ("1g", 1 << 30), ("2 KiB", 2048)])
def test_sizes_as_spark_writes_them(text, size):
    assert _bytes(text) == size
