"""Interval join with sums: for every left row, the sums of the right rows of
the same key whose time lies within an interval around the left row's time.

A join on the interval makes every pair, which for one busy key is the square
of its rows. Sums need no pairs: what lies in an interval is the running sum at
its end less the running sum before its start. Each left row becomes two marks
(start and end), the marks and the right rows are one timeline, and the
running sums are taken per key in two steps, as in the as-of join: within one
minute of a key, and over one summary row per active minute (bounded by the
calendar). So a key with a third of all rows is spread over its minutes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.asof import minute_of


def interval_sums(left: DataFrame, right: DataFrame, *, key: str, left_id: str, left_ts: str, right_ts: str,
                  lo: int, hi: int, sums: Mapping[str, Column]) -> DataFrame:
    """(``left_id``, one column per entry of ``sums``): totals of the right rows
    with ``left_ts + lo <= right_ts <= left_ts + hi`` (seconds, both ends included).

    ``left_id`` is unique among the left rows; ``sums`` maps names to whole-number
    columns of ``right`` (``F.lit(1)`` counts rows). Left rows without such rows,
    and those with a NULL key or time, get zeros; NULL values add nothing."""
    known = left.where(F.col(key).isNotNull() & F.col(left_ts).isNotNull())
    names = list(sums)
    zero = [F.lit(0).cast("bigint").alias(n) for n in names]

    def moved(seconds: int) -> Column:
        return F.col(left_ts) + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))

    # at equal times: starts (kind 0), then right rows (1), then ends (2)
    marks = known.select(F.col(key).alias("_k"), F.col(left_id).alias("_id"), F.explode(F.array(
        F.struct(moved(lo).alias("_ts"), F.lit(0).alias("_kind")), F.struct(moved(hi).alias("_ts"), F.lit(2).alias("_kind")))).alias("_e"))
    marks = marks.select("_k", "_id", "_e._ts", "_e._kind", *zero)
    rows = (right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
            .select(F.col(key).alias("_k"), F.lit(None).cast(left.schema[left_id].dataType).alias("_id"), F.col(right_ts).alias("_ts"),
                    F.lit(1).alias("_kind"), *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in sums.items()]))
    u = marks.unionByName(rows)
    u = u.withColumn("_slice", minute_of(u, "_ts"))
    before = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = u.groupBy("_k", "_slice").agg(*[F.sum(n).alias(n) for n in names]).select(
        "_k", "_slice", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names])
    within = Window.partitionBy("_k", "_slice").orderBy("_ts", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    running = u.select("_k", "_slice", "_id", "_kind", *[F.sum(n).over(within).alias(n) for n in names]).where(F.col("_kind") != 1)
    ends = running.join(slices, ["_k", "_slice"])
    sign = F.when(F.col("_kind") == 2, 1).otherwise(-1)
    found = ends.groupBy("_id").agg(*[F.sum(sign * (F.col(n) + F.col(f"_before_{n}"))).alias(n) for n in names])
    aside = left.where(F.col(key).isNull() | F.col(left_ts).isNull()).select(F.col(left_id).alias("_id"), *zero)
    return found.unionByName(aside).withColumnRenamed("_id", left_id)
