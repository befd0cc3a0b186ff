"""Event-time windows: repeated and late rows, closed and open windows, replays."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.streaming.windows import EVENT_SCHEMA, _rows, read_windows, start_split, start_windows

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _batch(rows):
    out = {}
    for event_id, ts, kind, cents in {r[0]: r for r in rows}.values():
        if ts is not None:
            n, s = out.get((ts.replace(minute=0, second=0), kind), (0, 0))
            out[ts.replace(minute=0, second=0), kind] = n + 1, s + cents
    return out


def test_stream_equals_batch_with_repeated_and_late_rows(spark, scratch):
    rnd = random.Random(6)
    every = [(i, BASE + dt.timedelta(minutes=i * 10), rnd.choice("ab"), rnd.randrange(100)) for i in range(600)]   # four days
    first = every[:300] + every[:300:7]                                 # repeats in the same file
    second = every[300:590] + every[290:300]                            # repeats of on-time rows
    late = [(1000 + i, BASE + dt.timedelta(minutes=i), "c", 5) for i in range(50)]   # new events of the first hour, far too late
    third = late + every[:20] + every[590:] + [(2000, None, "a", 1)]      # late repeats, and a row without a time
    seen = []
    for rows in (first, second, third):
        seen += rows
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        start_split(spark, f"{scratch}/in", f"{scratch}/w", delay_hours=6).awaitTermination()
        start_windows(spark, f"{scratch}/w", delay_hours=6).awaitTermination()
        got = read_windows(spark, f"{scratch}/w").select(F.unix_timestamp("window_start").alias("w"), "event_type", "events", "cents").collect()
        want = {(int(w.timestamp()), k): v for (w, k), v in _batch(seen).items()}
        assert {(r.w, r.event_type): (r.events, r.cents) for r in got} == want
    side = _rows(spark, f"{scratch}/w", late=True)
    assert side.count() == len(late) + 20 + 1                           # nothing is lost
    closed = spark.read.parquet(f"{scratch}/w/closed")
    assert 0 < closed.count() < len(got)                                # closed by the watermark, others still open
    # nothing new: a further run changes nothing
    start_split(spark, f"{scratch}/in", f"{scratch}/w", delay_hours=6).awaitTermination()
    start_windows(spark, f"{scratch}/w", delay_hours=6).awaitTermination()
    again = read_windows(spark, f"{scratch}/w").select(F.unix_timestamp("window_start").alias("w"), "event_type", "events", "cents").collect()
    assert sorted(again) == sorted(got)
