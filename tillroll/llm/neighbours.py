"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where the largest cosine is the smallest
Euclidean distance. Each of ``TABLES`` hash tables maps a vector to a bucket
by the cells (of width ``WIDTH``) of a few Gaussian projections. A query
visits, besides its own bucket, perturbed ones: for a neighbour at the
distance met in a sample each cell offset has a known probability, and buckets
are visited in falling order of the product until it is smaller than what
``RECALL`` of the sample's true neighbours need. Candidates of all tables are
merged and ranked by their exact cosine.

The index is dealt out by bucket; buckets with very many rows are split into
slots that their queries all visit. Of equal vectors only the ``k`` + 1 with
the smallest ids can be among anyone's ``k`` nearest, so no more are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.storage import written
from tillroll.llm.textarrays import mix

TABLES, WIDTH = 4, 1.0
#: Rows that a bucket holds on average at least, about; the most projections of a table follow from it.
PER_BUCKET = 64
#: Rows (those with the smallest id hash) that the fit looks at, and queries among them.
SAMPLE, SAMPLE_QUERIES = 4_000, 300
#: Share of the sample's true neighbours whose buckets must be visited.
RECALL = 0.95
#: Cell offsets looked at on each side.
REACH = 4
#: Comparisons that visiting a bucket costs, about, and sample queries that the price of a hashing is measured on.
PROBE, PRICED = 200, 30
#: Index bytes that one part holds, about, and the fewest rows of a bucket that is split.
PART_BYTES, SPLIT_ROWS = 8 << 20, 50_000


def _phi(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution function (Abramowitz and Stegun 7.1.26, error below 2e-7)."""
    z = np.abs(x) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-z * z)
    return np.where(x >= 0, 1 - tail / 2, tail / 2)


@dataclass
class Hashing:
    """Projections (table, projection, dimension), offsets, spread of a neighbour's projection, and the cost at which probing stops."""

    direction: np.ndarray
    shift: np.ndarray
    spread: float
    stop: float = 0.0

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Real-valued cell coordinates of unit vectors: (vector, table, projection)."""
        return np.einsum("nd,tmd->ntm", unit, self.direction) / WIDTH + self.shift

    @staticmethod
    def keys(table: int, cells: np.ndarray) -> np.ndarray:
        """Bucket keys of cell coordinates (bucket, projection)."""
        h = np.full(len(cells), table + 1, np.uint64)
        for j in range(cells.shape[1]):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, j].astype(np.int64).view(np.uint64))
        return h.view(np.int64)

    def costs(self, place: np.ndarray) -> np.ndarray:
        """Minus log probability of every cell offset, less that of the likeliest one: (projection, offset)."""
        inner = place - np.floor(place)
        edge = (np.arange(-REACH, REACH + 2)[None, :] - inner[:, None]) * WIDTH / self.spread
        p = np.diff(_phi(edge), axis=1)
        cost = -np.log(np.maximum(p, 1e-300))
        return cost - cost.min(axis=1, keepdims=True)

    def visit_count(self, place: np.ndarray, enough: float) -> float:
        """How many buckets ``probes`` would visit; counting ends above ``enough``."""
        cost, total = np.sort(self.costs(place), axis=1), np.zeros(1)
        for row in cost:
            total = (total[:, None] + row[None, :np.searchsorted(row, self.stop, side="right")]).ravel()
            total = total[total <= self.stop]
            if len(total) > enough:
                return np.inf
        return len(total)

    def probes(self, table: int, place: np.ndarray) -> np.ndarray:
        """Keys of the buckets to visit, likeliest first, down to the stopping cost."""
        cost = self.costs(place)
        total, cells = np.zeros(1), np.zeros((1, 0), np.int64)
        for j in range(len(place)):
            each = (total[:, None] + cost[j][None, :]).ravel()
            keep = np.flatnonzero(each <= self.stop)
            total = each[keep]
            offset = keep % cost.shape[1] - REACH + int(np.floor(place[j]))
            cells = np.concatenate([cells[keep // cost.shape[1]], offset[:, None]], axis=1)
        return self.keys(table, cells[np.argsort(total, kind="stable")])


def valid_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows whose vector is neither null, empty nor zero and has only finite components."""
    v = F.col(vector).cast("array<double>")
    return (vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .filter(F.exists("v", lambda x: x != 0.0)))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True) if len(m) else m
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True)) if len(m) else m


def _offset_costs(h: Hashing, place: np.ndarray, cell: np.ndarray, query: int, rows: np.ndarray) -> np.ndarray:
    """Cost at which a query's probing reaches each of ``rows``, in its best table (infinite beyond the offsets looked at)."""
    best = np.full(len(rows), np.inf)
    for t in range(TABLES):
        cost = h.costs(place[query, t])
        offset = cell[rows, t] - cell[query, t] + REACH
        inside = ((offset >= 0) & (offset <= 2 * REACH)).all(axis=1)
        total = np.take_along_axis(cost.T, np.clip(offset, 0, 2 * REACH), axis=0).sum(axis=1)
        best = np.minimum(best, np.where(inside, total, np.inf))
    return best


def fit(sample: np.ndarray, rows: int, k: int, seed: int = 11) -> Hashing:
    """Hashing for ``rows`` vectors like those of ``sample`` (one a row).

    The number of projections is the one whose queries cost least, as the
    sample shows it: buckets visited (``PROBE`` comparisons each) and candidates
    met, at the stop that ``RECALL`` of the true neighbours need. Vectors that
    no hashing separates get few projections and so few, large buckets; the
    visits of a query grow more slowly than the table. The sample's neighbours
    are farther than those among all rows, so the stop found here visits more
    than all rows need.
    """
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    most = int(np.clip(round(np.log2(max(rows, 1) / PER_BUCKET) / 2), 1, 16))
    direction, shift = rng.normal(size=(TABLES, most, d)), rng.random((TABLES, most))
    unit = _unit(sample)
    n = min(SAMPLE_QUERIES, len(unit))
    if n < 2:
        return Hashing(direction, shift, 1.0, np.inf)
    cosine = unit[:n] @ unit.T
    cosine[np.arange(n), np.arange(n)] = -2
    near = np.argsort(-cosine, axis=1)[:, :min(k, len(unit) - 1)]
    distance = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(cosine, near, axis=1)))
    spread = float(max(np.median(distance), 0.05))
    best, least = None, np.inf
    for m in range(1, most + 1):
        h = Hashing(direction[:, :m], shift[:, :m], spread)
        place = h.places(unit)
        cell = np.floor(place).astype(np.int64)
        h.stop = float(np.quantile([_offset_costs(h, place, cell, i, near[i]) for i in range(n)], RECALL))
        tried = range(min(n, PRICED))
        visits = np.mean([sum(h.visit_count(place[i, t], least / PROBE) for t in range(TABLES)) for i in tried])
        met = np.mean([(_offset_costs(h, place, cell, i, np.arange(len(unit))) <= h.stop).mean() for i in tried])
        price = PROBE * visits + rows * met
        if price < least:
            best, least = h, price
    return best


def _exact(vectors: np.ndarray, norms: np.ndarray, q: np.ndarray, norm: float) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal values."""
    return (vectors * q).sum(axis=1) / (norms * norm)


def _top(ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, spot: np.ndarray, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) of the ``k`` rows nearest to ``q`` among those at ``spot``, the query's own left out."""
    norm = float(np.sqrt((q * q).sum()))
    # where a good part of the rows is meant, all products at once are cheaper than a copy of these rows
    product = (vectors @ q)[spot] if 4 * len(spot) > len(vectors) else vectors[spot] @ q
    rough = product / (norms[spot] * norm)
    rough[ids[spot] == own] = -np.inf
    if len(rough) > k:
        bar = np.partition(rough, -k)[-k] - 1e-9
        at = spot[rough >= bar]
    else:
        at = spot
    at = at[ids[at] != own]
    score = _exact(vectors[at], norms[at], q, norm)
    order = np.lexsort((ids[at], -score))[:k]
    return ids[at][order], score[order]


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows of ``vectors`` found, other than itself.

    Both tables have an integer ``key`` and an array ``vector``. Rows with a
    null key and vectors that are null, empty, zero, of another length than
    most, or hold null or non-finite components take no part on either side.
    ``score`` is the cosine of the original vectors in double precision; equal
    scores are ranked by smaller key. A repeated key counts as one vector where
    the vectors are equal. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, key, vector)
    every = valid_vectors(queries, key, vector).distinct()
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if size is None:
        return empty
    d, n = size["d"], size["n"]
    rows, every = rows.filter(F.size("v") == d), every.filter(F.size("v") == d)
    few = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    h = fit(_matrix(few.column("v").combine_chunks()), n, k)
    least = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    shared = spark.sparkContext.broadcast(h)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.floor(shared.value.places(_unit(_matrix(b.column(1))))) if b.num_rows else None
            for t in range(TABLES if b.num_rows else 0):
                keys = shared.value.keys(t, cell[:, t])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys)], ["id", "v", "bucket"])

    index = written(least.select("id", "v").mapInArrow(buckets, "id bigint, v array<double>, bucket bigint"), "neighbours-index")
    split_at = max(SPLIT_ROWS, n * TABLES // 100_000)  # so that at most 100,000 buckets are split
    large = index.groupBy("bucket").agg(F.count("*").alias("c")).filter(F.col("c") > split_at).collect()
    slots = spark.sparkContext.broadcast({x["bucket"]: -(-x["c"] // split_at) for x in large})
    parts = max(1, -(-n * TABLES * d * 8 // PART_BYTES))

    def part(bucket: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return (mix(bucket.view(np.uint64) + slot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 0))
            many = np.array([slots.value.get(x, 1) for x in bucket.tolist()], np.int64) if slots.value else np.ones(len(bucket), np.int64)
            at = part(bucket, mix(ids.view(np.uint64)) % many.astype(np.uint64))
            one = pa.ListArray.from_arrays(pa.array(np.arange(len(bucket) + 1, dtype=np.int32)), b.column(2))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.zeros(len(at), np.int32)), b.column(0), b.column(1), one],
                                             ["part", "kind", "id", "v", "buckets"])

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1))
            place = shared.value.places(_unit(m)) if len(m) else None
            for i, own in enumerate(b.column(0).to_pylist()):
                visit = np.concatenate([shared.value.probes(t, place[i, t]) for t in range(TABLES)])
                if slots.value:
                    many = np.array([slots.value.get(x, 1) for x in visit.tolist()], np.int64)
                    slot = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    visit = np.repeat(visit, many)
                else:
                    slot = np.zeros(len(visit), np.int64)
                at = part(visit, slot)
                order = np.argsort(at, kind="stable")
                edge = np.flatnonzero(np.append(True, np.diff(at[order]) > 0))
                groups = pa.ListArray.from_arrays(pa.array(np.append(edge, len(order)).astype(np.int32)), pa.array(visit[order]))
                count = len(edge)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[order][edge]), pa.array(np.ones(count, np.int32)), pa.array(np.full(count, own)),
                     b.column(1).take(pa.array(np.full(count, i))), groups], ["part", "kind", "id", "v", "buckets"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nearest of every query among the rows of its buckets in this part; index rows come before queries."""
        at, ids, held, bucket = None, [], [], []
        ready = None
        for b in batches:
            columns = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)]
            v, edge = _matrix(b.column(3)), np.append(0, np.cumsum([len(x) for x in b.column(4)]))
            visit = b.column(4).flatten().to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for i, (p, kind) in enumerate(zip(columns[0].tolist(), columns[1].tolist(), strict=True)):
                if p != at:
                    at, ids, held, bucket, ready = p, [], [], [], None
                if kind == 0:
                    ids.append(columns[2][i])
                    held.append(v[i])
                    bucket.append(visit[edge[i]])
                    continue
                if ready is None:
                    order = np.argsort(bucket, kind="stable")
                    m = np.array(held).reshape(len(ids), -1)[order]
                    own = np.array(ids, np.int64)[order]
                    number = np.unique(own, return_inverse=True)[1]
                    ready = (own, m, np.sqrt((m * m).sum(axis=1)), np.array(bucket, np.int64)[order], number)
                    held = []
                own, m, norms, sorted_bucket, number = ready
                if not len(own):
                    continue
                wanted = visit[edge[i]:edge[i + 1]]
                low, high = np.searchsorted(sorted_bucket, wanted), np.searchsorted(sorted_bucket, wanted, side="right")
                spot = np.concatenate([np.arange(x, y) for x, y in zip(low[high > low], high[high > low], strict=True)]) if (high > low).any() else np.zeros(0, np.int64)
                one = np.full(number.max() + 1, -1)  # the tables' candidates merged: one row of each id
                one[number[spot]] = spot
                spot = one[one >= 0]
                got, score = _top(own, m, norms, spot, int(columns[2][i]), v[i], k)
                out += [(int(columns[2][i]), int(x), float(s)) for x, s in zip(got, score, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], kind_) for j, kind_ in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                                             ["query_id", "vec_id", "score"])

    schema = "part bigint, kind int, id bigint, v array<double>, buckets array<bigint>"
    both = index.mapInArrow(placed, schema).unionByName(every.mapInArrow(probing, schema))
    best = both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(ranked, "query_id bigint, vec_id bigint, score double")
    merged = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
