"""Attribution of purchases to the touches within a look-back window.

Every purchase event is credited to the same user's clicks of the seven days up
to it: the first one, all of them evenly, or by position (40 % first, 40 %
last, 20 % over those between). Shares are whole millionths of a cent, so sums
do not depend on the order of the rows. No purchase is paired with its touches:
the number of touches in a purchase's window, and in turn the shares a touch
gets from the purchases after it, are interval sums; first and last touches are
as-of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.asof import asof_join
from tillroll.functions.common import dollars, rnd
from tillroll.functions.intervals import interval_sums
from tillroll.functions.sqltext import R, oracle
from tillroll.registry import query
from tillroll.sources.bind import Tables

LOOK_BACK_DAYS = 7
DAY = 86_400
MICRO = 1_000_000


def purchases(t: Tables) -> DataFrame:
    return (t.raw("events").where(F.col("event_type") == "purchase")
            .select("event_id", F.col("user_id").alias("customer_id"), "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents")))


def touches(t: Tables) -> DataFrame:
    return t.interactions.select("attribution_id", "customer_id", "interaction_date", "campaign_id")


#: CTEs of the oracles: purchases, and each with the touches in its window, numbered from both ends.
_BOUGHT = "bought AS (SELECT event_id, user_id, ts, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM events WHERE event_type = 'purchase')"
_PATHS = f"""{_BOUGHT},
steps AS (SELECT b.event_id, b.cents, i.campaign_id, COUNT(*) OVER w AS n,
                 ROW_NUMBER() OVER (PARTITION BY b.event_id ORDER BY i.interaction_date, i.attribution_id) AS nth,
                 ROW_NUMBER() OVER (PARTITION BY b.event_id ORDER BY i.interaction_date DESC, i.attribution_id DESC) AS nth_back
          FROM bought b JOIN b_interactions i ON i.customer_id = b.user_id
            AND i.interaction_date BETWEEN b.ts - INTERVAL {LOOK_BACK_DAYS} DAY AND b.ts
          WINDOW w AS (PARTITION BY b.event_id))"""


def _named(t: Tables, per: DataFrame, *columns) -> DataFrame:
    return (per.join(t.campaigns.select("campaign_id", "campaign_name"), "campaign_id", "left")
            .select(F.coalesce("campaign_name", F.lit("Unattributed")).alias("campaign_name"), *columns))


@query("attribution_window_first", oracle("""
SELECT COALESCE(c.campaign_name, 'Unattributed') AS campaign_name, COUNT(*) AS purchases,
       CAST(SUM(b.cents) AS DOUBLE) / 100e0 AS revenue
FROM bought b LEFT JOIN steps s ON s.event_id = b.event_id AND s.nth = 1
LEFT JOIN b_campaigns c ON c.campaign_id = s.campaign_id GROUP BY 1""", ctes=_PATHS))
def attribution_window_first(t: Tables, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Every purchase credited to the user's first touch within its window."""
    start = purchases(t).withColumn("opens", F.col("ts") - F.make_dt_interval(days=F.lit(days)))
    m = asof_join(start, touches(t), key="customer_id", left_ts="opens", right_ts="interaction_date",
                  right_tiebreak="attribution_id", carry=["campaign_id", "interaction_date"], forward=True)
    campaign = F.when(F.col("interaction_date") <= F.col("ts"), F.col("campaign_id"))
    per = m.groupBy(campaign.alias("campaign_id")).agg(F.count(F.lit(1)).alias("purchases"), F.sum("cents").alias("_cents"))
    return _named(t, per, "purchases", dollars("_cents").alias("revenue"))


def _with_touch_count(bought: DataFrame, seen: DataFrame, days: int) -> DataFrame:
    """Purchases with ``n``, the number of touches in their window."""
    n = interval_sums(bought, seen, key="customer_id", left_id="event_id", left_ts="ts", right_ts="interaction_date",
                      lo=-days * DAY, hi=0, sums={"n": F.lit(1)})
    return bought.join(n, "event_id")


@query("attribution_window_linear", oracle(f"""
SELECT COALESCE(c.campaign_name, 'Unattributed') AS campaign_name, COUNT(s.event_id) AS touches,
       {R(f'CAST(SUM(COALESCE(CAST(s.cents AS HUGEINT) * {MICRO} // s.n, CAST(b.cents AS HUGEINT) * {MICRO})) AS DOUBLE) / 1e8')} AS revenue
FROM bought b LEFT JOIN steps s ON s.event_id = b.event_id
LEFT JOIN b_campaigns c ON c.campaign_id = s.campaign_id GROUP BY 1""", ctes=_PATHS))
def attribution_window_linear(t: Tables, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Every purchase split evenly over the touches within its window; ``touches`` counts the shares."""
    seen = touches(t)
    bought = _with_touch_count(purchases(t), seen, days)
    shared = bought.where("n > 0").withColumn("share", F.expr(f"(cents * {MICRO}) div n"))
    got = interval_sums(seen, shared.select("customer_id", "ts", "share"), key="customer_id", left_id="attribution_id",
                        left_ts="interaction_date", right_ts="ts", lo=0, hi=days * DAY, sums={"share": F.col("share"), "n": F.lit(1)})
    per = (seen.join(got, "attribution_id").where("n > 0").groupBy("campaign_id")
           .agg(F.sum("n").alias("touches"), F.sum(F.col("share").cast("decimal(38,0)")).alias("_share")))
    rest = bought.where("n = 0").groupBy(F.lit(None).cast("bigint").alias("campaign_id")).agg(
        F.lit(0).cast("bigint").alias("touches"), F.sum((F.col("cents") * MICRO).cast("decimal(38,0)")).alias("_share"))
    return _named(t, per.unionByName(rest), "touches", rnd(dollars("_share", 8)).alias("revenue"))


@query("attribution_window_position", oracle(f"""
SELECT COALESCE(c.campaign_name, 'Unattributed') AS campaign_name,
       {R(f'''CAST(SUM(CASE WHEN s.n IS NULL THEN CAST(b.cents AS HUGEINT) * {MICRO}
                            WHEN s.n <= 2 THEN CAST(b.cents AS HUGEINT) * {MICRO} // s.n
                            WHEN s.nth = 1 OR s.nth_back = 1 THEN CAST(b.cents AS HUGEINT) * {MICRO} * 2 // 5
                            ELSE CAST(b.cents AS HUGEINT) * {MICRO} // (5 * (s.n - 2)) END) AS DOUBLE) / 1e8''')} AS revenue
FROM bought b LEFT JOIN steps s ON s.event_id = b.event_id
LEFT JOIN b_campaigns c ON c.campaign_id = s.campaign_id GROUP BY 1""", ctes=_PATHS))
def attribution_window_position(t: Tables, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Every purchase split by position within its window: 40 % to the first touch, 40 % to the last and 20 % evenly
    to those between (all to a single touch, halves to two)."""
    seen = touches(t)
    bought = _with_touch_count(purchases(t), seen, days)
    whole = F.col("cents") * MICRO
    between = F.when(F.col("n") <= 2, F.expr(f"(cents * {MICRO}) div n")).otherwise(F.expr(f"(cents * {MICRO}) div (5 * (n - 2))"))
    shared = bought.where("n > 0").withColumn("share", between)
    # every touch gets the middle share, then the ends what they have more
    got = interval_sums(seen, shared.select("customer_id", "ts", "share"), key="customer_id", left_id="attribution_id",
                        left_ts="interaction_date", right_ts="ts", lo=0, hi=days * DAY, sums={"share": F.col("share"), "n": F.lit(1)})
    credit = seen.join(got, "attribution_id").where("n > 0").select("campaign_id", "share")
    ends = shared.where("n > 2").withColumn("opens", F.col("ts") - F.make_dt_interval(days=F.lit(days))).withColumn(
        "more", F.expr(f"(cents * {MICRO} * 2) div 5") - F.col("share")).select("event_id", "customer_id", "ts", "opens", "more")
    for side, forward in (("opens", True), ("ts", False)):
        credit = credit.unionByName(asof_join(ends, seen, key="customer_id", left_ts=side, right_ts="interaction_date",
                                              right_tiebreak="attribution_id", carry=["campaign_id"], forward=forward)
                                    .select("campaign_id", F.col("more").alias("share")))
    credit = credit.unionByName(bought.where("n = 0").select(F.lit(None).cast("bigint").alias("campaign_id"), whole.alias("share")))
    per = credit.groupBy("campaign_id").agg(F.sum(F.col("share").cast("decimal(38,0)")).alias("_share"))
    return _named(t, per, rnd(dollars("_share", 8)).alias("revenue"))
