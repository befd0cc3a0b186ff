"""Exact global NTILE, PERCENT_RANK and row numbers without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task.

**NTILE by selection.** Only the rows at the ends of the tiles matter. One
aggregation gives approximate percentiles just beside each end (a few numbers);
they cut the order into buckets, whose rows are counted exactly; the bucket that
holds an end is the only one that is sorted, and the (value, id) found there
decides the tile of every row by comparison with constants. Whatever the
percentiles are, the counts make the result exact. These three small queries run
while the plan is built and return some dozens of numbers each. A value that is a percentile itself may be that of
very many rows: it is a bucket of its own, cut further by id.

**PERCENT_RANK** counts rows per distinct value, so that ties are one row and
need no order; running sums go within buckets of values and over the buckets.

**Row numbers** (and NTILE over keys that are not whole numbers) need every
row's place: the rows are range-partitioned on the whole order and sorted within
their ranges, ``monotonically_increasing_id`` holds a row's range and its place
in it, and the frame is checkpointed at that point. A row's number is its place
plus the rows of all earlier ranges.

NULL keys sort as in Spark's own windows (first ascending, last descending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.session import ensure_checkpoint_dir

# an ordering: [(column name, ascending), ...]; the last column must be unique
Order = Sequence[tuple[str, bool]]

#: monotonically_increasing_id keeps the partition above this many bits
PLACE_BITS = 33


def _sort_cols(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def _numbered(df: DataFrame, order: Order, ranges: int | None) -> DataFrame:
    """``df`` with ``__rn`` (row number from 1) and ``__n`` (all rows)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _sort_cols(order)
    placed = (df.repartitionByRange(ranges, *cols).sortWithinPartitions(*cols)
              .withColumn("__at", F.monotonically_increasing_id()).checkpoint())
    part = F.shiftright("__at", PLACE_BITS)
    counts = placed.groupBy(part.alias("__range")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    offsets = counts.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__off"),
                            F.sum("__rows").over(Window.partitionBy()).alias("__n"))
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (placed.withColumn("__range", part).join(F.broadcast(offsets), "__range")
            .withColumn("__rn", (F.col("__off") + place + 1).cast("bigint"))
            .drop("__at", "__range", "__off"))


def ntile_of(rn: Column, rows: Column, tiles: int) -> Column:
    """NTILE bucket (1-based) of 1-based row number ``rn`` among ``rows``."""
    q = F.floor(rows / tiles)
    r = rows - q * tiles
    big = r * (q + 1)
    small = r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(small).cast("int")


def _whole(df: DataFrame, name: str) -> bool:
    t = df.schema[name].dataType
    return isinstance(t, T.IntegralType) or isinstance(t, T.DecimalType) and t.scale == 0 and t.precision <= 18


#: Distance, as a share of all rows, of the percentiles beside a tile's end, and their accuracy (rank error at most 1 in so many).
BESIDE, ACCURACY = 0.002, 2_000
#: Pieces by id of a value that may hold very many rows.
ID_PIECES = 16


def _rising(name: str, asc: bool) -> str:
    """SQL of the key as a whole number that grows along the order."""
    return f"CAST(`{name}` AS BIGINT)" if asc else f"(-CAST(`{name}` AS BIGINT))"


def _above(c: str, limits: Sequence[int]) -> str:
    """SQL of how many of the ``limits`` are below ``c``. (One constant array: a tree of comparisons
    makes a plan that takes longer to compile than small tables take to read.)"""
    if not limits:
        return "0"
    return f"size(filter(array({', '.join(f'{x}L' for x in limits)}), x -> x < {c}))"


def _cut_tiles(df: DataFrame, specs: Sequence[tuple[str, int, Order]]) -> DataFrame:
    """``add_ntiles`` by selection, for orders of two whole numbers (value, unique id)."""
    wanted, ids = [], {}
    for k, (_, tiles, ((v, asc), (i, up))) in enumerate(specs):
        ends = sorted({min(max(e / tiles + d, 0.0), 1.0) for e in range(1, tiles) for d in (-BESIDE, BESIDE)})
        wanted.append(F.percentile_approx(F.expr(_rising(v, asc)), ends or [0.5], ACCURACY).alias(f"v{k}"))
        if (i, up) not in ids:
            ids[i, up] = f"i{k}"
            wanted.append(F.percentile_approx(F.expr(_rising(i, up)), [j / ID_PIECES for j in range(1, ID_PIECES)], ACCURACY).alias(f"i{k}"))
    near = df.agg(*wanted).first()      # a few numbers per order

    places = []
    for k, (_, _, ((v, asc), (i, up))) in enumerate(specs):
        value, own = _rising(v, asc), _rising(i, up)
        limits, pieces = sorted(set(near[f"v{k}"] or [])), sorted(set(near[ids[i, up]] or []))
        at = f"{value} IN ({', '.join(f'{x}L' for x in limits)})" if limits else "FALSE"
        bucket = f"CASE WHEN {value} IS NULL THEN {-1 if asc else 2 * len(limits) + 2} ELSE 2 * {_above(value, limits)} + IF({at}, 1, 0) END"
        piece = f"CASE WHEN {value} IS NULL OR {at} THEN {_above(own, pieces)} ELSE 0 END"
        places.append(F.expr(f"named_struct('s', {k}, 'b', {bucket}, 'p', {piece}, 'v', COALESCE({value}, 0L), 'i', {own})"))
    rows = df.select(F.explode(F.array(*places)).alias("x")).select("x.*")
    # a few dozen buckets and pieces an order
    counts = sorted(tuple(r) for r in rows.groupBy("s", "b", "p").agg(F.count(F.lit(1)).alias("c")).collect())
    cuts = {}
    for k, (_, tiles, _) in enumerate(specs):
        own = [(b, p, c) for s, b, p, c in counts if s == k]
        n = sum(c for *_, c in own)
        ends = [e * (n // tiles) + min(e, n % tiles) for e in range(1, tiles)] if n else []
        before = 0
        for b, p, c in own:
            for end in ends:
                if before < end <= before + c:
                    cuts.setdefault((k, b, p), set()).add(end - before)
            before += c
    found = []
    if cuts:
        inside = " OR ".join(f"(s = {s} AND b = {b} AND p = {p})" for s, b, p in cuts)
        wanted = " OR ".join(f"(s = {s} AND b = {b} AND p = {p} AND nth IN ({', '.join(map(str, sorted(nth)))}))" for (s, b, p), nth in cuts.items())
        nth = F.row_number().over(Window.partitionBy("s", "b", "p").orderBy("v", "i"))
        found = rows.where(inside).withColumn("nth", nth).where(wanted).collect()    # one row per tile end
    tiles_of = []
    for k, (name, _, ((v, asc), (i, up))) in enumerate(specs):
        value, own = _rising(v, asc), _rising(i, up)
        nulls = -1 if asc else 2 * len(set(near[f"v{k}"] or [])) + 2
        passed = []
        for r in found:
            if r.s == k and r.b == nulls:
                passed.append(f"({value} IS NULL AND {own} > {r.i}L)" + (f" OR {value} IS NOT NULL" if asc else ""))
            elif r.s == k:
                passed.append(f"{value} > {r.v}L OR ({value} = {r.v}L AND {own} > {r.i}L)" + ("" if asc else f" OR {value} IS NULL"))
        tiles_of.append(F.expr(" + ".join(["1", *(f"CASE WHEN {x} THEN 1 ELSE 0 END" for x in passed)])).cast("int").alias(name))
    return df.select("*", *tiles_of)


def add_ntiles(df: DataFrame, specs: Sequence[tuple[str, int, Order]], *, ranges: int | None = None) -> DataFrame:
    """Add one ``NTILE(n) OVER (ORDER BY ...)`` column per spec ``(name, n, order)``.

    Orders of a whole number and a unique whole id are tiled by selection, all
    in one go; others by row numbers over ``ranges`` ranges (default
    ``spark.sql.shuffle.partitions``).
    """
    short = [s for s in specs if len(s[2]) == 2 and all(_whole(df, c) for c, _ in s[2])]
    if short:
        df = _cut_tiles(df, short)
    for name, tiles, order in specs:
        if not any(name == s[0] for s in short):
            df = (_numbered(df, order, ranges)
                  .withColumn(name, ntile_of(F.col("__rn"), F.col("__n"), tiles)).drop("__rn", "__n"))
    return df


def add_row_number(df: DataFrame, name: str, order: Order, *, ranges: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY ...)`` computed range by range."""
    return _numbered(df, order, ranges).withColumnRenamed("__rn", name).drop("__n")


def add_percent_rank(df: DataFrame, name: str, by: str, asc: bool = True, buckets: int = 256) -> DataFrame:
    """Add ``PERCENT_RANK() OVER (ORDER BY by)`` for every row; ``by`` is a whole number.

    Rows are counted per value first, so a value with very many rows is one row
    in its bucket and all its rows get one rank. Buckets are ranges of values
    between approximate percentiles; a bucket's distinct values are one window."""
    value = F.expr(_rising(by, asc))
    near = df.agg(F.percentile_approx(value, [j / buckets for j in range(1, buckets)], 10_000)).first()[0]
    limits = sorted(set(near or []))
    bucket = F.when(value.isNull(), F.lit(-1 if asc else len(limits) + 1)).otherwise(F.expr(_above(_rising(by, asc), limits)))
    values = df.select(bucket.cast("int").alias("__b"), value.alias("__v")).groupBy("__b", "__v").agg(F.count(F.lit(1)).alias("__c"))
    earlier = Window.unboundedPreceding, -1
    totals = values.groupBy("__b").agg(F.sum("__c").alias("__t"))
    # one row per bucket
    totals = totals.select("__b", F.coalesce(F.sum("__t").over(Window.orderBy("__b").rowsBetween(*earlier)), F.lit(0)).alias("__off"),
                           F.sum("__t").over(Window.partitionBy()).alias("__n"))
    inside = F.coalesce(F.sum("__c").over(Window.partitionBy("__b").orderBy("__v").rowsBetween(*earlier)), F.lit(0))
    ranked = values.select("__b", "__v", inside.alias("__in")).join(F.broadcast(totals), "__b").select(
        "__v", F.when(F.col("__n") <= 1, F.lit(0.0)).otherwise((F.col("__off") + F.col("__in")).cast("double") / (F.col("__n") - 1)).alias(name))
    out = df.withColumn("__w", value).join(ranked, F.col("__w").eqNullSafe(F.col("__v")))
    return out.drop("__w", "__v")
