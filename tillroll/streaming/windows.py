"""Event-time windows over a stream with repeated and late rows, nothing lost.

Two queries work on one folder:

* the first reads the arriving files and puts every row on one of two sides, by
  the watermark it keeps itself: the greatest event time of *earlier* batches
  less the allowed delay. On-time rows go to one table, rows behind the
  watermark (and rows without a time) to a side table. Each batch is a folder
  of its own, overwritten if it is replayed, with its greatest event time beside;
* the second is the stateful one: over the on-time rows, ``withWatermark``,
  ``dropDuplicatesWithinWatermark`` on the event id and counts per window and
  event type, which leave the state store once the watermark has passed the
  window's end. Its watermark never runs ahead of the first query's, so the
  state drops no row that the first one let through.

``read_windows`` adds up the closed windows, the windows still open (from the
on-time rows of these windows alone) and the late rows that are new events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.common import dollars
from tillroll.functions.sqltext import oracle
from tillroll.registry import query
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.bind import Tables
from tillroll.streaming.ledger import _batch_dir, _batches, _place

WINDOW, DELAY_HOURS = "1 hour", 24
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("cents", T.LongType()),
])


def _split(base: str, delay_hours: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = _batch_dir(batch, f"{base}/marks", batch_id)
        earlier = [m for m in _batches(spark, f"{base}/marks") if _place(m)[0] == _place(own)[0] and _place(m)[1] < batch_id]
        # one row a batch
        mark = spark.read.schema("seen TIMESTAMP").parquet(*earlier).agg(F.max("seen")).first()[0] if earlier else None
        late = F.col("ts").isNull()
        if mark is not None:
            late = late | (F.col("ts") < F.lit(mark) - F.make_dt_interval(hours=F.lit(delay_hours)))
        (batch.withColumn("late", F.when(late, "yes").otherwise("no")).write.mode("overwrite").partitionBy("late")
         .parquet(_batch_dir(batch, f"{base}/rows", batch_id)))
        batch.agg(F.max("ts").alias("seen")).write.mode("overwrite").parquet(own)
    return write


def start_split(spark: SparkSession, arriving: str, base: str, delay_hours: int = DELAY_HOURS) -> StreamingQuery:
    """The first query: event files in ``arriving`` to ``base``/rows, each row on time or late."""
    return (spark.readStream.schema(EVENT_SCHEMA).parquet(arriving).writeStream.foreachBatch(_split(base, delay_hours))
            .option("checkpointLocation", f"{base}/checkpoint-split").trigger(availableNow=True).start())


def _measures() -> list:
    return [F.count(F.lit(1)).alias("events"), F.sum("cents").alias("cents")]


def _keys() -> list:
    return [F.window("ts", WINDOW)["start"].alias("window_start"), F.col("event_type")]


def start_windows(spark: SparkSession, base: str, delay_hours: int = DELAY_HOURS) -> StreamingQuery:
    """The second query: on-time rows to ``base``/closed, one row per closed window and event type."""
    rows = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{base}/rows/stream=*/batch_id=*/late=no")
    counted = (rows.withWatermark("ts", f"{delay_hours} hours").dropDuplicatesWithinWatermark(["event_id"])
               .groupBy(F.window("ts", WINDOW), "event_type").agg(*_measures())
               .select(F.col("window.start").alias("window_start"), "event_type", "events", "cents"))
    return (counted.writeStream.format("parquet").outputMode("append").option("path", f"{base}/closed")
            .option("checkpointLocation", f"{base}/checkpoint-windows").trigger(availableNow=True).start())


def _rows(spark: SparkSession, base: str, late: bool) -> DataFrame:
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("late", T.StringType())])
    folders = _batches(spark, f"{base}/rows")
    rows = spark.read.schema(schema).option("basePath", f"{base}/rows").parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.where(F.col("late") == ("yes" if late else "no")).select(*EVENT_SCHEMA.names)


def read_windows(spark: SparkSession, base: str) -> DataFrame:
    """(window_start, event_type, events, cents) of all events seen so far, each counted once."""
    closed = spark.read.schema("window_start TIMESTAMP, event_type STRING, events LONG, cents LONG").parquet(f"{base}/closed")
    on_time = _rows(spark, base, late=False)
    # windows are bounded by the calendar; a closed one has a row for each of its types
    open_rows = (on_time.withColumn("window_start", F.window("ts", WINDOW)["start"])
                 .join(closed.select("window_start").distinct(), "window_start", "left_anti"))
    still = open_rows.dropDuplicates(["event_id"]).groupBy("window_start", "event_type").agg(*_measures())
    late = (_rows(spark, base, late=True).where("ts IS NOT NULL").dropDuplicates(["event_id"])
            .join(on_time.select("event_id"), "event_id", "left_anti"))
    more = late.groupBy(*_keys()).agg(*_measures())
    return (closed.unionByName(still).unionByName(more).groupBy("window_start", "event_type")
            .agg(F.sum("events").alias("events"), F.sum("cents").alias("cents")))


@query("event_windows_stream", oracle("""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / 100e0 AS value
FROM events WHERE ts IS NOT NULL GROUP BY ALL"""))
def event_windows_stream(t: Tables) -> DataFrame:
    """Hourly events per type from a stream in which every tenth event comes twice and every fiftieth comes last of all."""
    base = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/windows-{uuid.uuid4().hex}"
    e = t.raw("events")
    # event times have no zone and the stream's clock has one: they are taken as UTC, whatever the session's zone
    instant = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"))
    e = e.select("event_id", instant.alias("ts"), "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    half = F.unix_micros("ts") < 1_705_276_800_000_000      # 15 January 2024
    held = F.col("event_id") % 50 == 7
    again = F.explode(F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0))))
    arrivals = [e.where(half & ~held), e.where(~half & ~held), e.where(held).unionByName(e.where(F.col("event_id") % 40 == 0))]
    for rows in arrivals:
        rows.withColumn("n", again).drop("n").write.mode("append").parquet(f"{base}/arriving")
        start_split(t.spark, f"{base}/arriving", base).awaitTermination()
        start_windows(t.spark, base).awaitTermination()
    return read_windows(t.spark, base).select(
        F.expr("timestampadd(MICROSECOND, unix_micros(window_start), TIMESTAMP_NTZ '1970-01-01 00:00:00')").alias("window_start"), "event_type", "events", dollars("cents").alias("value"))
