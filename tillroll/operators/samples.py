"""Random samples of a fixed size that are the same rows however the table is dealt out.

Every row gets a number from the MD5 of a seed and its key; the ``k`` least are
the sample (bottom-k). Samples of parts merge into the sample of the whole:
each partition keeps its own ``k`` before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.sqltext import oracle
from tillroll.registry import query
from tillroll.sources.bind import Tables

SEED = 2024


def draw(keys: Sequence[str], seed: int) -> Column:
    """The row's number: hexadecimal text, the same on every engine with MD5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).cast("binary"))


def fixed_sample(df: DataFrame, k: int, keys: Sequence[str], seed: int = SEED, within: Sequence[str] = ()) -> DataFrame:
    """``k`` rows of ``df`` (all, if there are fewer), or ``k`` of every group of ``within``; ``keys`` are unique."""
    drawn = df.withColumn("__draw", draw(keys, seed))
    if not within:
        return drawn.orderBy("__draw", *keys).limit(k).drop("__draw")
    nth = F.row_number().over(Window.partitionBy(*within).orderBy("__draw", *keys))
    return drawn.withColumn("__nth", nth).where(F.col("__nth") <= k).drop("__draw", "__nth")


_DRAW = f"md5('{SEED}:' || CAST(order_id AS VARCHAR) || ':' || CAST(product_id AS VARCHAR))"
_COLUMNS = ("order_id", "product_id", "customer_id", "rating")


@query("review_sample", oracle(f"SELECT {', '.join(_COLUMNS)} FROM b_reviews ORDER BY {_DRAW} LIMIT 500"))
def review_sample(t: Tables, k: int = 500) -> DataFrame:
    """500 random reviews, as the source's generator takes 500 random order lines."""
    return fixed_sample(t.reviews.select(*_COLUMNS), k, ["order_id", "product_id"])


@query("review_sample_by_rating", oracle(f"""
SELECT {', '.join(_COLUMNS)} FROM b_reviews QUALIFY ROW_NUMBER() OVER (PARTITION BY rating ORDER BY {_DRAW}) <= 50"""))
def review_sample_by_rating(t: Tables, k: int = 50) -> DataFrame:
    """50 random reviews of every rating."""
    return fixed_sample(t.reviews.select(*_COLUMNS), k, ["order_id", "product_id"], within=["rating"])
