"""As-of join: for every left row, the nearest right row of the same key at or
before (or at or after) the left row's time.

Spark has no as-of join, and the usual window over a whole key's timeline
puts one busy key into one task. Here the timeline is cut into minutes:

1. left and right rows are unioned, tagged, and given the minute of their time;
2. per (key, minute) the outermost right row of that minute is found with
   ``max_by`` (``min_by`` when looking forward);
3. a window over the key's active minutes (one row each, so bounded by the
   calendar) carries the right row of other minutes on;
4. a window per (key, minute) carries right rows on within the minute and
   falls back to the carried-in value.

Every window works on one minute of one key, or on one summary row per active
minute; no step needs a whole key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def minute_of(df: DataFrame, ts: str) -> Column:
    """Whole minutes of column ``ts``, as a number that grows with time. (Zoned
    times count from the epoch; local ones have no zone to jump in.)"""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.floor(F.unix_micros(F.col(ts)) / F.lit(60_000_000))
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * 1440 + F.hour(ts) * 60 + F.minute(ts)


def asof_join(left: DataFrame, right: DataFrame, *, key: str, left_ts: str, right_ts: str,
              right_tiebreak: str, carry: Sequence[str], forward: bool = False) -> DataFrame:
    """``left`` with the ``carry`` columns of the latest ``right`` row having
    the same ``key`` and ``right_ts <= left_ts`` (ties on time broken by the
    largest ``right_tiebreak``); NULL when there is none. ``forward`` looks
    the other way: the earliest row with ``right_ts >= left_ts``, ties broken
    by the smallest.

    A NULL key or time matches nothing: such right rows are dropped, such left
    rows keep NULLs (they are set aside, so they never meet in one window)."""
    known = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    aside = left.where(~known)
    left = left.where(known)
    right = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
    right_types = right.select(*carry).schema
    lcols = [c for c in left.columns if c != key]
    lstruct = F.struct(*[F.col(c) for c in lcols]).alias("_l")
    rstruct = F.struct(*[F.col(c) for c in carry]).alias("_r")
    null_l = F.lit(None).cast(left.select(lstruct).schema["_l"].dataType).alias("_l")
    null_r = F.lit(None).cast(right.select(rstruct).schema["_r"].dataType).alias("_r")
    # kind 0 = right row, 1 = left row: at equal times a right row comes first
    u = (left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_ts"), F.lit(1).alias("_kind"),
                     F.lit(None).cast("long").alias("_tb"), lstruct, null_r)
         .unionByName(right.select(F.col(key).alias("_k"), F.col(right_ts).alias("_ts"), F.lit(0).alias("_kind"),
                                   F.col(right_tiebreak).cast("long").alias("_tb"), null_l, rstruct)))
    u = u.withColumn("_slice", minute_of(u, "_ts"))
    along = (lambda c: F.col(c).desc()) if forward else (lambda c: F.col(c).asc())
    outermost = F.min_by if forward else F.max_by
    right_slices = (u.where(F.col("_kind") == 0).groupBy("_k", "_slice")
                    .agg(outermost("_r", F.struct("_ts", "_tb")).alias("_slice_last")))
    left_slices = u.where(F.col("_kind") == 1).select("_k", "_slice").distinct()
    # one row per active minute of a key: the window below is bounded by the calendar
    passed = Window.partitionBy("_k").orderBy(along("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    start = (left_slices.join(right_slices, ["_k", "_slice"], "full")
             .select("_k", "_slice", F.last("_slice_last", ignorenulls=True).over(passed).alias("_carry")))
    within = (Window.partitionBy("_k", "_slice").orderBy(along("_ts"), "_kind", along("_tb"))
              .rowsBetween(Window.unboundedPreceding, 0))
    j = u.join(start, ["_k", "_slice"], "left")
    res = (j.withColumn("_m", F.coalesce(F.last("_r", ignorenulls=True).over(within), F.col("_carry")))
           .where(F.col("_kind") == 1))
    matched = res.select(F.col("_k").alias(key), "_l.*", *[F.col(f"_m.{c}").alias(c) for c in carry])
    return matched.unionByName(aside.select(key, *lcols, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right_types]))
