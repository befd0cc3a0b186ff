"""Near-duplicate embeddings by binary codes of a random rotation.

Every vector, at length 1 and rotated at random, is coded by its signs; the
code is stored with its correction factor, the cosine between the vector and
its code. ``<code, q> / factor`` is an unbiased estimate of the cosine with
another vector q, and what the code leaves out bounds the error: a pair whose
estimate stays below the threshold by more than the bound is settled, the
others are computed again from the vectors in double precision (RaBitQ, Gao and
Long 2024, both bounds stated at the threshold).

Which pairs are looked at: ``TABLES`` tables of a few Gaussian sign bits each.
A vector lies in one bucket a table and visits those whose flipped bits have
the smallest squared margins. Sign flips depend on the angle alone, so the
limit on the margins that keeps the odds of missing a pair at the threshold at
``MISS`` follows from the angle and the number of bits, whatever the data.

Groups of near copies are not expanded into pairs. Equal vectors are one node
from the first step on. Crowded buckets are looked through for balls with a
radius of half the threshold's angle around the mean of near rows: all members
of a ball are linked. Balls then meet each other and single vectors as one
object each; angle and radii settle most of these meetings as a whole, and only
where they do not, members are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.neighbours import _matrix, _unit, valid_vectors
from tillroll.llm.storage import written
from tillroll.llm.textarrays import mix

TABLES, MISS = 12, 1e-9
#: Rows that a bucket holds on average, about, and the most sign bits of a table.
PER_BUCKET, MOST_BITS = 64, 24
#: Standard deviations that the code's error bound allows for (odds of 2e-9 a pair).
SIGMAS = 6.0
#: Rows from which a bucket is looked through for balls, rows sampled there a round, sampled rows that make a ball, balls a round, rounds.
CROWDED, LOOKED, SEEDS, BALLS, ROUNDS = 256, 64, 4, 8, 6
#: Rows of one bucket that a task holds; larger ones are dealt to slots.
SLOT_ROWS = 8_192
#: Safety margin of angles, above the error of an arc cosine near 0.
SLACK = 1e-7


# -- hashing and codes ------------------------------------------------------

def _margin_limit(bits: int, angle: float, one_sided: bool, seed: int = 5, trials: int = 100_000) -> float:
    """Sum of squared margins of flipped bits within which a pair at ``angle`` stays in one table often enough."""
    need = 1 - MISS ** (1 / TABLES)
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(trials, bits))
    b = np.cos(angle) * a + np.sin(angle) * rng.normal(size=(trials, bits))
    flipped = (a > 0) != (b > 0)
    cost = (a * a * flipped).sum(1)
    if not one_sided:
        cost = np.minimum(cost, (b * b * flipped).sum(1))
    return float(np.quantile(cost, need))


@dataclass
class Codes:
    """Rotation (orthogonal), table directions (table, bit, dimension) and the margin limits of single vectors and of balls."""

    rotation: np.ndarray
    directions: np.ndarray
    limit: float
    ball_limit: float

    @classmethod
    def fit(cls, d: int, rows: int, threshold: float, seed: int = 23) -> Codes:
        rng = np.random.default_rng(seed)
        q, r = np.linalg.qr(rng.normal(size=(d, d)))
        bits = int(np.clip(round(np.log2(max(rows, 1) / PER_BUCKET)), 1, MOST_BITS))
        angle = float(np.arccos(threshold))
        balls = max(_margin_limit(bits, 2 * angle, False), _margin_limit(bits, 1.5 * angle, True))
        return cls(q * np.sign(np.diag(r)), rng.normal(size=(TABLES + 1, bits, d)), _margin_limit(bits, angle, False), balls)

    def margins(self, unit: np.ndarray, table: int) -> np.ndarray:
        return unit @ self.directions[table].T

    @staticmethod
    def keys(table: int, number: np.ndarray) -> np.ndarray:
        """Bucket keys of sign bits read as numbers."""
        return mix(number * np.uint64(2 * TABLES + 3) + np.uint64(table + 1)).view(np.int64)

    @staticmethod
    def numbers(margins: np.ndarray) -> np.ndarray:
        """The sign bits of every row of margins as one number."""
        return (margins > 0).astype(np.uint64) @ (np.uint64(1) << np.arange(margins.shape[1], dtype=np.uint64))

    def homes(self, table: int, unit: np.ndarray) -> np.ndarray:
        return self.keys(table, self.numbers(self.margins(unit, table)))

    def visits(self, table: int, margins: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of every bucket whose flipped bits have squared margins of the row's limit at most in sum.

        All rows at once: bits are taken by rising margin, and every set of flips that still has room gets a copy with the next bit."""
        squared = margins * margins
        order = np.argsort(squared, axis=1)
        cost = np.take_along_axis(squared, order, axis=1)
        row, total, flips = np.arange(len(margins)), np.zeros(len(margins)), np.zeros(len(margins), np.uint64)
        for j in range(margins.shape[1]):
            more = np.flatnonzero(total + cost[row, j] <= limits[row])
            if not len(more):
                break
            at = row[more]
            bit = np.uint64(1) << order[at, j].astype(np.uint64)
            row, total, flips = np.concatenate([row, at]), np.concatenate([total, total[more] + cost[at, j]]), np.concatenate([flips, flips[more] | bit])
        return row, self.keys(table, self.numbers(margins)[row] ^ flips)


def estimates(signs: np.ndarray, factor: np.ndarray, rotated: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the cosines of rotated unit vectors (rows) with coded ones (columns)."""
    return (rotated @ signs.T) / (np.sqrt(np.float32(signs.shape[1])) * factor)


def error_bound(factor: np.ndarray, cosine: np.ndarray, d: int) -> np.ndarray:
    """How far the estimate of a pair with this cosine may be off."""
    lost = np.sqrt(np.maximum(0, 1 - factor * factor)) / factor
    return lost * np.sqrt(np.maximum(0, 1 - cosine * cosine)) * min(1.0, SIGMAS / np.sqrt(max(d - 1, 1)))


# -- balls ------------------------------------------------------------------

def _centres(angle: float):
    """Centres of the dense places among the rows looked at in one bucket."""
    near, half = np.cos(0.75 * angle), np.cos(0.5 * angle)

    def run(rows: pa.Table) -> pa.Table:
        unit = _unit(_matrix(rows.column("v").combine_chunks()))
        cosine = unit @ unit.T
        left, found = np.ones(len(unit), bool), []
        while len(found) < BALLS:
            close = (cosine >= near) & left[None, :] & left[:, None]
            count = close.sum(axis=1)
            if not len(count) or count.max() < SEEDS:
                break
            mean = unit[close[int(np.argmax(count))]].mean(axis=0)
            size = np.sqrt((mean * mean).sum())
            if size == 0:
                break
            found.append(mean / size)
            taken = (unit @ found[-1] >= half) | close[int(np.argmax(count))]
            left &= ~taken
        if not found:
            return pa.table({"bucket": pa.array([], pa.int64()), "centres": pa.array([], pa.list_(pa.list_(pa.float64())))})
        return pa.table({"bucket": rows.column("bucket").slice(0, 1).cast(pa.int64()),
                         "centres": pa.array([[c.tolist() for c in found]], pa.list_(pa.list_(pa.float64())))})
    return run


def _nearest(angle: float):
    """Adds the nearest centre of a row's bucket, where it is within half the angle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = _unit(_matrix(b.column(2)))
            ball, far = np.full(b.num_rows, -1, np.int32), np.zeros(b.num_rows)
            buckets = b.column(3).to_numpy()
            edge = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets)) if len(buckets) else np.zeros(0, int)
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if not b.column(4)[int(lo)].is_valid:
                    continue
                cosine = unit[lo:hi] @ np.array(b.column(4)[int(lo)].as_py()).T
                best = cosine.argmax(axis=1)
                a = np.arccos(np.clip(cosine[np.arange(hi - lo), best], -1, 1))
                inside = a <= angle / 2 - SLACK
                ball[lo:hi], far[lo:hi] = np.where(inside, best, -1), a
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(4)] + [pa.array(ball), pa.array(far)],
                                             ["node", "copies", "v", "bucket", "ball", "far"])
    return run


def _balls(nodes: DataFrame, angle: float) -> DataFrame | None:
    """(node, copies, v, object, centre, radius, weight) of every node that lies in a ball with others; None without balls.

    Every round looks at a bounded sample of each bucket that is still crowded; the result of the join does not depend
    on what is found, only its cost does."""
    columns = ["node", "copies", "v", "bucket"]
    left, parts = nodes.select(*columns), []
    for round_ in range(ROUNDS):
        crowd = written(left.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED), "vectors-crowded")
        rows = crowd.agg(F.sum("n")).first()[0]
        if not rows:
            break
        left = written(left.join(crowd.select("bucket"), "bucket", "left_semi").select(*columns), "vectors-left")
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("node", F.lit(round_)), "node"))
        looked = left.withColumn("nth", nth).filter(F.col("nth") <= LOOKED).select("bucket", "v")
        centres = written(looked.groupBy("bucket").applyInArrow(_centres(angle), "bucket long, centres array<array<double>>"), "vectors-centres")
        dealt = written(left.join(centres, "bucket", "left").select(*columns, "centres").mapInArrow(
            _nearest(angle), "node long, copies long, v array<double>, bucket long, ball int, far double"), "vectors-dealt")
        inside = dealt.filter("ball >= 0")
        whole = inside.groupBy("bucket", "ball").agg(F.min("node").alias("object"), F.max("far").alias("radius"),
                                                     F.sum("copies").alias("weight"), F.count("*").alias("n")).filter("n > 1")
        whole = written(whole.join(centres, "bucket").select(
            "bucket", "ball", "object", "radius", "weight", F.element_at("centres", F.col("ball") + 1).alias("centre")), "vectors-balls")
        parts.append(inside.join(whole, ["bucket", "ball"]).select("node", "copies", "v", "object", "centre", "radius", "weight"))
        left = dealt.filter("ball < 0").select(*columns)
        if left.count() > 0.95 * rows:
            break
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return written(out, "vectors-members")


# -- meetings ---------------------------------------------------------------

_ROW = "bucket long, kind int, object long, data binary, scale float, lost float, radius double"


def _coded(codes, want_index: bool):
    """Index rows (the rotated vector in 8-bit steps, at home) or probe rows (the code, at every bucket visited)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codes.value
        # a few rows at a time: a ball may visit thousands of buckets
        for b in (whole.slice(lo, 1024) for whole in batches for lo in range(0, whole.num_rows, 1024)):
            unit = _unit(_matrix(b.column(1)))
            objects, radius = b.column(0), b.column(2).to_numpy()
            rotated = unit @ c.rotation.T
            if want_index:
                step = np.abs(rotated).max(axis=1) / 127
                steps = np.round(rotated / step[:, None]).astype(np.int8)
                lost = np.sqrt(((rotated - steps * step[:, None]) ** 2).sum(axis=1))
                data, scale = [x.tobytes() for x in steps], step
            else:
                data = [x.tobytes() for x in np.packbits(rotated > 0, axis=1)]
                scale, lost = np.abs(rotated).sum(axis=1) / np.sqrt(unit.shape[1]), np.zeros(len(unit))
            for t in range(TABLES):
                if want_index:
                    keys, at = c.homes(t, unit), np.arange(len(unit))
                else:
                    at, keys = c.visits(t, c.margins(unit, t), np.where(radius > 0, c.ball_limit, c.limit))
                for lo in range(0, len(at), 65_536):
                    part = at[lo:lo + 65_536]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[lo:lo + 65_536]), pa.array(np.full(len(part), 0 if want_index else 1, np.int32)), objects.take(pa.array(part)),
                         pa.array([data[i] for i in part], pa.binary()), pa.array(scale[part].astype(np.float32)), pa.array(lost[part].astype(np.float32)),
                         pa.array(radius[part])], ["bucket", "kind", "object", "data", "scale", "lost", "radius"])
    return run


def _estimated(d: int, angle: float):
    """(a, b): the pairs of a bucket that their estimates do not settle. Index rows come before probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            bucket, slot, kind = columns[:3]
            change = (bucket[1:] != bucket[:-1]) | (slot[1:] != slot[:-1]) | (kind[1:] != kind[:-1])
            edge = np.append(np.flatnonzero(np.append(True, change)), len(bucket)) if len(bucket) else np.zeros(0, int)
            left, right = [], []
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                place = (bucket[lo], slot[lo])
                if place != at:
                    at, held, ready = place, [], None
                objects, data, scale, lost, radius = (c[lo:hi] for c in columns[3:])
                if kind[lo] == 0:
                    held.append((objects, np.frombuffer(b"".join(data), np.int8).reshape(-1, d), scale, lost, radius))
                    continue
                if ready is None:
                    if not held:
                        continue
                    own, steps, size, rest, wide = (np.concatenate(x) for x in zip(*held, strict=True))
                    ready, held = (own, steps * size[:, None].astype(np.float32), rest, wide), []
                own, rotated, rest, wide = ready
                bits = np.unpackbits(np.frombuffer(b"".join(data), np.uint8).reshape(hi - lo, -1), axis=1, count=d)
                signs = bits.astype(np.float32) * 2 - 1
                for x in range(0, hi - lo, 1024):
                    y = slice(x, x + 1024)
                    about = estimates(signs[y], scale[y], rotated)
                    bar = np.cos(np.minimum(angle + wide[:, None] + radius[y][None, :], np.pi))
                    bar = bar - error_bound(scale[y][None, :], bar, d) - rest[:, None] / scale[y][None, :] - 1e-5
                    i, j = np.nonzero(about >= bar)
                    a, b = own[i], objects[y][j]
                    other = a != b
                    left.append(np.minimum(a, b)[other])
                    right.append(np.maximum(a, b)[other])
            if left:
                pair = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])
    return run


def _meetings(objects: DataFrame, codes: Codes, d: int, angle: float) -> DataFrame:
    """(a, b), a < b: pairs of objects whose codes do not rule a link out, as a written table."""
    shared = objects.sparkSession.sparkContext.broadcast(codes)  # as large as the square of the dimensions
    bare = objects.select("object", "centre", "radius")
    index = bare.mapInArrow(_coded(shared, True), _ROW)
    probes = bare.mapInArrow(_coded(shared, False), _ROW)
    large = written(index.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > SLOT_ROWS)
                    .select("bucket", F.ceil(F.col("n") / SLOT_ROWS).cast("int").alias("slots")), "vectors-large")
    if large.head(1):
        slots = F.coalesce("slots", F.lit(1))
        index = index.join(large, "bucket", "left").withColumn("slot", F.pmod(F.xxhash64("object"), slots).cast("int"))
        probes = probes.join(large, "bucket", "left").withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
    else:
        index, probes = index.withColumn("slot", F.lit(0)), probes.withColumn("slot", F.lit(0))
    columns = ["bucket", "slot", "kind", "object", "data", "scale", "lost", "radius"]
    both = index.select(*columns).unionByName(probes.select(*columns))
    found = both.repartition("bucket", "slot").sortWithinPartitions("bucket", "slot", "kind").mapInArrow(_estimated(d, angle), "a long, b long")
    return written(found.distinct(), "vectors-meetings")


def _cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    x, y = _matrix(a), _matrix(b)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _settled(threshold: float, angle: float, first: int, second: int, radii: tuple[int | None, int | None]):
    """Adds ``state`` to rows with vectors in columns ``first`` and ``second``: 1 linked as a whole, 0 open, -1 no link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wide = sum((b.column(r).to_numpy() for r in radii if r is not None), np.zeros(b.num_rows))
            cosine = _cosines(b.column(first), b.column(second)) if b.num_rows else np.zeros(0)
            far = np.arccos(np.clip(cosine, -1, 1))
            whole = np.where(far + wide <= angle - SLACK, 1, np.where(far - wide > angle + SLACK, -1, 0))
            state = np.where(wide > 0, whole, np.where(cosine >= threshold, 1, -1)).astype(np.int32)
            kept = state >= 0
            columns = [i for i in range(b.num_columns) if i not in (first, second, *radii)]
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(kept)) for i in columns] + [pa.array(state[kept])],
                                             [b.schema.names[i] for i in columns] + ["state"])
    return run


# -- links ------------------------------------------------------------------

def links(vectors: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component): every row of ``vectors`` with the number of other rows whose cosine is ``threshold`` or more, and the smallest key reachable by links.

    Vectors that are null, empty, zero, of another length than most, or hold
    null or non-finite entries link with nothing, as do rows without a key. A
    repeated key is another row. Other columns are not read; an empty table
    gives no rows. ``threshold`` is above 0.71, so that twice its angle stays
    below a right angle."""
    every = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = valid_vectors(every, "id", "v")
    most = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if most is None:
        return every.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    d, angle = most["d"], float(np.arccos(threshold))
    marked = valid_marks(every, d)
    codes = Codes.fit(d, most["n"], threshold)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket = codes.homes(TABLES, _unit(_matrix(b.column(4)))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pa.array(bucket)], [*b.schema.names, "bucket"])

    same = marked.filter("valid").groupBy("h", "g").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = written(same.select("h", "g", "least", "copies", "v").mapInArrow(
        homes, "h long, g int, least long, copies long, v array<double>, bucket long").withColumn("node", F.monotonically_increasing_id()),
        "vectors-nodes")
    inside = _balls(nodes, angle)
    single = nodes.select(F.col("node").alias("object"), F.col("v").alias("centre"), F.lit(0.0).alias("radius"), F.col("copies").alias("weight"))
    if inside is not None:
        balls = inside.groupBy("object").agg(F.first("centre").alias("centre"), F.first("radius").alias("radius"), F.first("weight").alias("weight"))
        single = single.join(inside.select(F.col("node").alias("object")), "object", "left_anti").unionByName(balls)
    objects = written(single, "vectors-objects")

    met = _meetings(objects, codes, d, angle)
    a = objects.select(F.col("object").alias("a"), F.col("centre").alias("va"), F.col("radius").alias("ra"))
    b = objects.select(F.col("object").alias("b"), F.col("centre").alias("vb"), F.col("radius").alias("rb"))
    settled = written(met.join(a, "a").join(b, "b").select("a", "b", "va", "vb", "ra", "rb").mapInArrow(
        _settled(threshold, angle, 2, 3, (4, 5)), "a long, b long, state int"), "vectors-settled")
    linked = settled.filter("state = 1").select("a", "b")
    weight = objects.select("object", "weight")
    # what every member of an object gains by links of the object as a whole
    gained = (linked.join(weight.withColumnRenamed("object", "b"), "b").select(F.col("a").alias("object"), "weight")
              .unionByName(linked.join(weight.withColumnRenamed("object", "a"), "a").select(F.col("b").alias("object"), "weight")))
    edges, own = linked, None
    if inside is not None and settled.filter("state = 0").head(1):
        more, more_edges, own = _members_compared(settled.filter("state = 0").select("a", "b"), nodes, inside, objects, threshold, angle)
        gained, edges = gained.unionByName(more), edges.unionByName(more_edges)
    gained = written(gained.groupBy("object").agg(F.sum("weight").alias("gained")), "vectors-gained")
    root = written(components(edges, name="vectors-components"), "vectors-roots")

    at = nodes.select("node", "h", "g", "copies", "least", F.col("node").alias("object"), F.col("copies").alias("weight"))
    if inside is not None:
        at = nodes.select("node", "h", "g", "copies", "least").join(inside.select("node", "object", "weight"), "node", "left").select(
            "node", "h", "g", "copies", "least", F.coalesce("object", "node").alias("object"), F.coalesce("weight", "copies").alias("weight"))
    at = (at.join(gained, "object", "left").join(root.withColumnRenamed("node", "object"), "object", "left")
          .withColumn("root", F.coalesce("root", "object")))
    if own is not None:
        at = at.join(own, "node", "left")
    at = written(at.select("h", "g", "least", "root", (F.col("weight") - 1 + F.coalesce("gained", F.lit(0))
                 + (F.coalesce("own", F.lit(0)) if own is not None else F.lit(0))).alias("n_links")), "vectors-found")
    label = written(at.groupBy("root").agg(F.min("least").alias("component")), "vectors-labels")
    found = written(at.join(label, "root").select("h", "g", "n_links", "component"), "vectors-numbered")
    return (marked.filter("valid").select("id", "h", "g").join(found, ["h", "g"]).select("id", "n_links", "component")
            .unionByName(marked.filter("NOT valid").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))))


def valid_marks(every: DataFrame, d: int) -> DataFrame:
    """(id, v, valid, h, g): each row, whether it takes part, and two hashes of its vector (96 bits together)."""
    v = F.col("v").cast("array<double>")
    fine = (F.col("id").isNotNull() & (F.size(v) == d) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
            & F.exists(v, lambda x: F.coalesce(x != 0.0, F.lit(False))))
    return (every.select("id", v.alias("v"), F.coalesce(fine, F.lit(False)).alias("valid"))
            .withColumn("h", F.xxhash64("v")).withColumn("g", F.hash("v")))


def _members_compared(open_: DataFrame, nodes: DataFrame, inside: DataFrame, objects: DataFrame, threshold: float, angle: float):
    """Meetings that angle and radii leave open, by members: what objects gain (object, weight), edges (a, b), and what nodes gain (node, own).

    A member of one side first meets the other object as a whole; only members still open meet its members."""
    members = written(inside.select("object", "node", "copies", "v").unionByName(
        objects.filter("radius = 0").select("object", F.col("object").alias("node"), F.col("weight").alias("copies"), F.col("centre").alias("v"))),
        "vectors-all-members")
    # side a is the ball where only one is
    turned = open_.join(objects.select(F.col("object").alias("a"), F.col("radius").alias("ra")), "a").select(
        F.when(F.col("ra") > 0, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("ra") > 0, F.col("b")).otherwise(F.col("a")).alias("b"))
    one = members.select(F.col("object").alias("a"), F.col("node").alias("na"), F.col("copies").alias("ca"), F.col("v").alias("va"))
    whole = objects.select(F.col("object").alias("b"), F.col("weight").alias("wb"), F.col("centre").alias("vb"), F.col("radius").alias("rb"))
    first = written(turned.join(one, "a").join(whole, "b").select("a", "b", "na", "ca", "wb", "va", "vb", "rb").mapInArrow(
        _settled(threshold, angle, 5, 6, (7, None)), "a long, b long, na long, ca long, wb long, state int"), "vectors-member-whole")
    sure = first.filter("state = 1")
    two = members.select(F.col("object").alias("b"), F.col("node").alias("nb"), F.col("copies").alias("cb"), F.col("v").alias("vb"))
    pairs = (first.filter("state = 0").select("a", "b", "na", "ca").join(one.select("na", "va"), "na").join(two, "b")
             .select("a", "b", "na", "ca", "nb", "cb", "va", "vb")
             .mapInArrow(_settled(threshold, angle, 6, 7, (None, None)), "a long, b long, na long, ca long, nb long, cb long, state int"))
    pairs = written(pairs.drop("state"), "vectors-member-pairs")
    own = (sure.select(F.col("na").alias("node"), F.col("wb").alias("own"))
           .unionByName(pairs.select(F.col("na").alias("node"), F.col("cb").alias("own")))
           .unionByName(pairs.select(F.col("nb").alias("node"), F.col("ca").alias("own")))
           .groupBy("node").agg(F.sum("own").alias("own")))
    more = sure.select(F.col("b").alias("object"), F.col("ca").alias("weight"))
    edges = sure.select("a", "b").unionByName(pairs.select("a", "b")).distinct()
    return more, edges, written(own, "vectors-own")
