"""Interval sums and the forward as-of join against brute force; a hot user is spread over tasks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.functions.asof import asof_join
from tillroll.functions.intervals import interval_sums

BASE = dt.datetime(2024, 1, 1)
LEFT = "pid long, user long, ts timestamp_ntz, cents long"
RIGHT = "aid long, user long, at timestamp_ntz, campaign long"


def _events(seed, n, m, users, hours=24 * 12):
    rnd = random.Random(seed)
    when = lambda: BASE + dt.timedelta(minutes=rnd.randrange(hours * 60))
    left = [(i, rnd.randrange(users), when(), rnd.randrange(1, 9000)) for i in range(n)]
    right = [(1000 + j, rnd.randrange(users), when(), rnd.randrange(5)) for j in range(m)]
    # exact ties: at the purchase, and at both ends of a two-day window
    for j, p in enumerate(left[:30]):
        right.append((5000 + j, p[1], p[2] - dt.timedelta(days=2 * (j % 2)), 7))
    return left, right


def _brute(left, right, lo, hi):
    out = {}
    for pid, user, ts, _ in left:
        inside = [] if user is None or ts is None else [
            r for r in right if r[1] == user and r[2] is not None and ts + dt.timedelta(seconds=lo) <= r[2] <= ts + dt.timedelta(seconds=hi)]
        out[pid] = (len(inside), sum(r[3] or 0 for r in inside))
    return out


def _sums(spark, left, right, lo, hi):
    got = interval_sums(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), key="user", left_id="pid",
                        left_ts="ts", right_ts="at", lo=lo, hi=hi, sums={"n": F.lit(1), "s": F.col("campaign")})
    return {r.pid: (r.n, r.s) for r in got.collect()}


def test_interval_sums_equal_pairs(spark):
    left, right = _events(3, 250, 300, 6)
    for lo, hi in ((-2 * 86400, 0), (0, 86400), (-3600, 3600), (-86400, -1)):
        assert _sums(spark, left, right, lo, hi) == _brute(left, right, lo, hi)


def test_null_keys_times_values_and_empty_sides(spark):
    t = BASE
    left = [(1, None, t, 1), (2, 5, None, 1), (3, 5, t, 1)]
    right = [(10, None, t, 1), (11, 5, None, 1), (12, 5, t, None), (13, 5, t, 4)]
    assert _sums(spark, left, right, -10, 0) == {1: (0, 0), 2: (0, 0), 3: (2, 4)}
    assert _sums(spark, left, [], -10, 0) == {1: (0, 0), 2: (0, 0), 3: (0, 0)}
    assert _sums(spark, [], right, -10, 0) == {}


def test_forward_asof_equals_brute_force(spark):
    left, right = _events(8, 200, 150, 5)
    right += [(9000 + i, r[1], r[2], 40 + i) for i, r in enumerate(right[:20])]   # ties between right rows
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), key="user", left_ts="ts", right_ts="at",
                    right_tiebreak="aid", carry=["aid"], forward=True)
    want = {}
    for pid, user, ts, _ in left:
        later = [(at, aid) for aid, u, at, _ in right if u == user and at >= ts]
        want[pid] = min(later)[1] if later else None
    assert {r.pid: r.aid for r in got.collect()} == want


def test_a_hot_user_makes_no_pairs_and_is_spread(spark):
    # one user has a third of 6,000 rows; its purchases x touches would be a million pairs
    rnd = random.Random(2)
    left = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 900), BASE + dt.timedelta(seconds=rnd.randrange(86400 * 5)), 1) for i in range(3000)]
    right = [(j, 0 if j % 3 == 0 else rnd.randrange(1, 900), BASE + dt.timedelta(seconds=rnd.randrange(86400 * 5)), 1) for j in range(3000)]
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = interval_sums(l, r, key="user", left_id="pid", left_ts="ts", right_ts="at", lo=-86400, hi=0, sums={"n": F.lit(1)})
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert "_k#" in plan and "hashpartitioning(_k" in plan and "_slice" in plan   # dealt by user and minute
    hot = [x for x in rows if x.pid % 3 == 0]
    assert len({x.part for x in hot}) > 1 and sum(x.n for x in hot) == sum(
        1 for p in left if p[1] == 0 for q in right if q[1] == 0 and p[2] - dt.timedelta(days=1) <= q[2] <= p[2])
