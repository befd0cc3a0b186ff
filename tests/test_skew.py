"""A hot order (a third of all lines) is split by AQE in the registered
operators, and their results stay those of the oracle."""

import os

import pytest
from pyspark.sql import functions as F

from tillroll import Tables, registry
from tillroll.session import RECOMMENDED_CONF

from .conftest import SF_SMALL
from .helpers import TABLES, duck, same

FORCE = "spark.sql.adaptive.forceOptimizeSkewedJoin"
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",           # force the sort-merge join used at scale
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    FORCE: RECOMMENDED_CONF[FORCE],
}


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The small tables with one order that holds a third of all lines."""
    folder = str(tmp_path_factory.mktemp("hot"))
    for t in TABLES:
        if t != "lineitem":
            os.symlink(f"{SF_SMALL}/{t}.parquet", f"{folder}/{t}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    order = (spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderstatus = 'F'").orderBy("o_orderkey").first().o_orderkey)
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").orderBy("p_partkey").select("p_partkey")
    n = lines.count() // 2
    keys = [r.p_partkey for r in parts.collect()]
    hot = (lines.limit(n).withColumn("l_orderkey", F.lit(order).cast("bigint"))
           .withColumn("_n", F.monotonically_increasing_id() % len(keys))
           .withColumn("l_partkey", F.element_at(F.array(*[F.lit(k).cast("bigint") for k in keys]), (F.col("_n") + 1).cast("int")))
           .drop("_n"))
    lines.unionByName(hot).repartition(16).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("name", ["best_sellers", "market_basket", "product_affinity", "recommend_products",
                                  "v_product_performance_corrected", "cancellation_rate_by_product"])
def test_hot_order_is_split_and_exact(spark, hot_dir, name):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        df = registry.QUERIES[name](Tables(spark, hot_dir))
        con = duck(hot_dir, lineitem=f"{hot_dir}/lineitem.parquet/*.parquet")
        ok, detail = same(df, con, registry.ORACLE[name])
        assert ok, detail
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
