"""As-of join against a brute-force answer on a small fixture."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.functions.asof import asof_join


def test_asof_matches_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    orders = [(i, rnd.randint(1, 6), base + dt.timedelta(hours=rnd.randint(0, 24 * 20))) for i in range(300)]
    touches = [(100 + j, rnd.randint(1, 6), base + dt.timedelta(hours=rnd.randint(0, 24 * 20)), rnd.randint(1, 10))
               for j in range(200)]
    # exact time ties between an order and touches of its customer
    touches += [(900 + j, o[1], o[2], 99) for j, o in enumerate(orders[:20])]
    left = spark.createDataFrame(orders, "order_id long, customer_id long, order_date timestamp_ntz")
    right = spark.createDataFrame(touches, "aid long, customer_id long, ts timestamp_ntz, campaign_id long")
    got = asof_join(left, right, key="customer_id", left_ts="order_date", right_ts="ts",
                    right_tiebreak="aid", carry=["campaign_id", "aid"])
    got = {r.order_id: (r.campaign_id, r.aid) for r in got.collect()}
    want = {}
    for oid, cust, t in orders:
        cands = [(ts, aid, camp) for aid, c, ts, camp in touches if c == cust and ts <= t]
        want[oid] = (max(cands)[2], max(cands)[1]) if cands else (None, None)
    assert got == want


def test_null_keys_and_times_match_nothing(spark):
    t = dt.datetime(2024, 1, 5)
    left = spark.createDataFrame([(1, None, t), (2, 5, None), (3, 5, t), (4, None, None)],
                                 "order_id long, customer_id long, order_date timestamp_ntz")
    right = spark.createDataFrame([(10, None, t, 7), (11, 5, None, 8), (12, 5, t, 9)],
                                  "aid long, customer_id long, ts timestamp_ntz, campaign_id long")
    got = asof_join(left, right, key="customer_id", left_ts="order_date", right_ts="ts",
                    right_tiebreak="aid", carry=["campaign_id"])
    assert {(r.order_id, r.campaign_id) for r in got.collect()} == {(1, None), (2, None), (3, 9), (4, None)}
