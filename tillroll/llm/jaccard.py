"""N-gram Jaccard join with signature trees.

1. Every text becomes its set of word shingles; equal sets are one from here on.
2. A set's sketch is its ``SKETCH`` smallest shingle hashes. Two linked sets
   share at least ``LEAST_SHARED`` of them, so a set with fewer sketch hashes
   that any other set has is out, and the rest meet on the rarest of their
   shared hashes (prefix filter in the order of document frequency). Sets
   connected through such meetings are a block.
3. Within a block a signature tree is built: leaves hold sets, nodes the
   OR-combined token bitmap and the size range of all sets below. A dual
   traversal of the tree with itself drops node pairs whose maximum possible
   overlap or size ratio cannot reach the threshold, and pairs whose sets are
   all in one component already; what remains is compared exactly.
4. Links give connected components.

Step 2's bound is not a cap: of the smallest ``SKETCH`` hashes of the union of
two sets at least three quarters are expected in both, and fewer than
``LEAST_SHARED`` = 3/8 come up with odds below 1e-13 for a linked pair (sets of
up to 72 shingles: never). ``sketch=None`` takes the full prefix instead, whose
guarantee holds without odds.

Blocks of more than ``CHUNK_TOKENS`` shingles are split at random into chunks.
All chunks share a few pivot sets, which joins what is alike across them; sets
outside the block's main component are then compared with every chunk. No
group, however large, is held by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.storage import free, written
from tillroll.llm.textarrays import Words, chunks, mix
from tillroll.llm.workers import tidied

WIDTH = 5
#: Similarity of a link, as a fraction.
PART, WHOLE = 75, 100
SKETCH, LEAST_SHARED, SURE = 96, 36, 72
CHUNK_TOKENS = 2_000_000
LEAF, FAN = 32, 4
PIVOTS = 64


# -- sets -------------------------------------------------------------------

def row_sets(buf: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles of all rows, each row's distinct ones ascending; edges of the rows; 64-bit id of each row's set)."""
    doc, shingle = Words(buf, offsets).shingles(width)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1]))[:len(doc)]
    doc, shingle = doc[new], shingle[new]
    edge = np.searchsorted(doc, np.arange(len(offsets)))
    total = np.append(np.uint64(0), np.cumsum(mix(shingle), dtype=np.uint64))
    crossed = np.append(np.uint64(0), np.cumsum(mix(shingle ^ np.uint64(0x9FB21C651E98DF25)) ** np.uint64(2), dtype=np.uint64))
    ids = mix((total[edge[1:]] - total[edge[:-1]]) + mix(crossed[edge[1:]] - crossed[edge[:-1]]))
    return shingle, edge, ids


def _sets(width: int, sketch: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, ids, small = [], [], []
            for first, end, buf, offsets in chunks(b.column(2)):
                shingle, edge, own = row_sets(buf, offsets, width)
                n = np.diff(edge)
                count += n.tolist()
                ids += [int(x) if k else None for x, k in zip(own.view(np.int64), n, strict=True)]
                size = n if sketch is None else np.minimum(n, sketch)
                if sketch is None:  # prefix of the allowed misses and one
                    size = n - -(-n * PART // WHOLE) + 1
                small += [shingle[a:a + k].tobytes() for a, k in zip(edge[:-1].tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(count, pa.int64()), pa.array(ids, pa.int64()), pa.array(small, pa.binary())],
                ["key", "mark", "n", "set", "sketch"])
    return run


def text_sets(docs: DataFrame, key: str, text: str, width: int, sketch: int | None) -> DataFrame:
    """(key, mark, n, set, sketch) of every row; set is null where there is no word."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(tidied(_sets(width, sketch)), "key bigint, mark bigint, n bigint, set bigint, sketch binary")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, token) of every (set, packed tokens)."""
    for b in batches:
        flat = [np.frombuffer(x.as_py(), np.int64) for x in b.column(1)]
        if not flat:
            continue
        sets = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(x) for x in flat])
        tokens = np.concatenate(flat)
        for i in range(0, len(sets), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(sets[i:i + 100_000]), pa.array(tokens[i:i + 100_000])], ["set", "token"])


# -- candidates -------------------------------------------------------------

def least_shared(n, sketch: int | None):
    """Sketch hashes that a set of ``n`` shingles shares with any set linked to it, at least."""
    if sketch is None:
        return F.lit(1)
    need = F.ceil(n * PART / WHOLE)
    return F.when(n <= SURE, need).otherwise(F.least(need, F.lit(LEAST_SHARED)))


def meetings(sets: DataFrame, sketch: int | None) -> DataFrame:
    """(set, token): the hashes on which sets that may be linked meet.

    Document frequencies come from one partial aggregation. They are a written
    table, so that the join back shuffles both of its sides itself and
    adaptive execution can split a hash that very many sets have.
    """
    tokens = sets.select("set", "sketch").mapInArrow(tidied(_unpack), "set bigint, token bigint")
    often = written(tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "jaccard-frequencies")
    shared = tokens.join(often, "token")
    each = (shared.groupBy("set").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
            .join(sets.select("set", "n"), "set"))
    need = least_shared(F.col("n"), sketch).cast("int")
    kept = each.filter(F.size("t") >= need)
    if sketch is not None:
        kept = kept.withColumn("t", F.slice("t", F.lit(1), F.greatest(F.size("t") - need + 1, F.lit(0))))
    return kept.select("set", F.explode("t.token").alias("token"))


def blocks(sets: DataFrame, sketch: int | None) -> DataFrame:
    """(node, root): sets connected through shared meeting hashes (sets without a meeting are left out)."""
    met = written(meetings(sets, sketch), "jaccard-meetings")
    lead = written(met.groupBy("token").agg(F.min("set").alias("lead"), F.max("set").alias("last")).filter("lead <> last"),
                   "jaccard-leads")
    edges = met.join(lead.select("token", "lead"), "token").filter("set <> lead").select("set", "lead").distinct()
    return components(edges, "set", "lead", "jaccard-blocks")


# -- signature tree ---------------------------------------------------------

class SignatureTree:
    """Sets of one chunk, ordered by their smallest shingle so that alike ones share leaves."""

    def __init__(self, tokens: list[np.ndarray], size: np.ndarray, bits: int):
        n = len(tokens)
        first = np.array([t[0] if len(t) else 0 for t in tokens], np.uint64)
        self.order = np.lexsort((size, first))
        self.tokens = [tokens[i] for i in self.order]
        self.size = size[self.order]
        words = bits // 64
        map0 = np.zeros((n, words), np.uint64)
        for i, t in enumerate(self.tokens):
            bit = t & np.uint64(bits - 1)
            np.bitwise_or.at(map0[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        self.map = map0
        self.extra = self.size - np.bitwise_count(map0).sum(axis=1)  # tokens that share a bit with another one
        # levels of nodes: (first set, end set); level 0 are the leaves
        self.levels = []
        low = np.arange(0, n, LEAF)
        high = np.minimum(low + LEAF, n)
        part = map0
        while True:
            starts = low if not self.levels else np.arange(0, len(self.levels[-1][0]), FAN)
            source = part
            maps = np.bitwise_or.reduceat(source, starts, axis=0)
            self.levels.append((low, high, maps,
                                np.minimum.reduceat(self.size, low), np.maximum.reduceat(self.size, low),
                                np.maximum.reduceat(self.extra, low)))
            if len(low) == 1:
                break
            part = maps
            low, high = low[::FAN], np.append(high[FAN - 1::FAN], high[-1:] if len(high) % FAN else high[:0])

    def children(self, level: int, node: int) -> range:
        return range(node * FAN, min(node * FAN + FAN, len(self.levels[level - 1][0])))


def linked(size_a: int, size_b: int, common: int) -> bool:
    return WHOLE * common >= PART * (size_a + size_b - common)


def _possible(min_a, max_a, min_b, max_b, bound):
    """Whether sets of such sizes with at most ``bound`` common shingles can be linked."""
    need = np.maximum(PART * (min_a + min_b) / (WHOLE + PART), np.maximum(min_a, min_b) * PART / WHOLE)
    return (WHOLE * max_a >= PART * min_b) & (WHOLE * max_b >= PART * min_a) & (bound >= need - 1e-9)


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Common entries of two ascending arrays."""
    if len(a) > len(b):
        a, b = b, a
    i = np.searchsorted(b, a)
    i[i == len(b)] = 0
    return int((b[i] == a).sum()) if len(b) else 0


def dual_traversal(a: SignatureTree, b: SignatureTree, label_a: np.ndarray, label_b: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of two trees (or one with itself), as many as are needed to connect what is linked.

    ``label_a`` and ``label_b`` (tree order) hold component labels, which are
    updated as links are found; equal labels need no link.
    """
    own = a is b
    found: list[tuple[int, int]] = []

    def joined(low_a: int, high_a: int, low_b: int, high_b: int) -> bool:
        one, two = label_a[low_a:high_a], label_b[low_b:high_b]
        return one[0] == two[0] and bool((one == one[0]).all() and (two == two[0]).all())

    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        low_a, high_a, map_a, min_a, max_a, extra_a = (x[i] for x in a.levels[la])
        low_b, high_b, map_b, min_b, max_b, extra_b = (x[j] for x in b.levels[lb])
        same = own and la == lb and i == j
        if not same:
            bound = np.bitwise_count(map_a & map_b).sum() + min(extra_a, extra_b)
            if not _possible(min_a, max_a, min_b, max_b, bound):
                continue
        if joined(low_a, high_a, low_b, high_b):
            continue
        if la or lb:
            down_a = a.children(la, i) if la and la >= lb else None
            down_b = b.children(lb, j) if lb and lb >= la else None
            pairs = [(la - 1 if down_a is not None else la, x, lb - 1 if down_b is not None else lb, y)
                     for x in (down_a if down_a is not None else (i,)) for y in (down_b if down_b is not None else (j,))
                     if not same or x <= y]
            # nodes with themselves come first (they are taken off the end): their links spare the rest
            stack += sorted(pairs, key=lambda p: (own and p[0] == p[2] and p[1] == p[3], -abs(p[1] - p[3])))
            continue
        bits = np.bitwise_count(a.map[low_a:high_a, None, :] & b.map[None, low_b:high_b, :]).sum(axis=2)
        bound = bits + np.minimum(a.extra[low_a:high_a, None], b.extra[None, low_b:high_b])
        size_a, size_b = a.size[low_a:high_a, None], b.size[None, low_b:high_b]
        x, y = np.nonzero(_possible(size_a, size_a, size_b, size_b, bound) & (label_a[low_a:high_a, None] != label_b[None, low_b:high_b]))
        for p, q in zip((x + low_a).tolist(), (y + low_b).tolist(), strict=True):
            one, two = label_a[p], label_b[q]
            if one == two or same and p >= q:
                continue
            if linked(int(a.size[p]), int(b.size[q]), common_count(a.tokens[p], b.tokens[q])):
                found.append((p, q))
                label_a[label_a == two] = one
                if not own:
                    label_b[label_b == two] = one
    return found


def tree_links(ids: np.ndarray, size: np.ndarray, tokens: list[np.ndarray], probe: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links of a chunk's sets (``probe`` false) among themselves or, if there are probes, between probes and the others."""
    # bits for the mean set: a longer one only prunes less, and all bitmaps take about half a byte a token
    bits = 1 << max(9, min(16, (4 * int(size.mean()) + 1).bit_length()))

    def tree(which: np.ndarray) -> tuple[SignatureTree, np.ndarray]:
        at = np.flatnonzero(which)
        t = SignatureTree([tokens[i] for i in at], size[at], bits)
        return t, at[t.order]

    # probes are there as members of their own chunks too: each is compared with every other set once at least
    one, at = tree(~probe)
    if not probe.any():
        return [(int(ids[at[p]]), int(ids[at[q]])) for p, q in dual_traversal(one, one, *([label[at].copy()] * 2))]
    two, at2 = tree(probe)
    return [(int(ids[at[p]]), int(ids[at2[q]])) for p, q in dual_traversal(one, two, label[at].copy(), label[at2].copy())]


def _chunk_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every chunk in rows sorted by chunk: (chunk, set, n, tokens, probe, label)."""
    held: list[tuple] = []

    def links() -> pa.RecordBatch:
        n = len(held)
        alone = not any(h[4] for h in held)
        out = tree_links(np.array([h[1] for h in held]), np.array([h[2] for h in held]),
                         [np.frombuffer(h[3], np.uint64) for h in held], np.array([h[4] for h in held]),
                         np.array([h[5] for h in held])) if n > 1 and (alone or not all(h[4] for h in held)) else []
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([q for _, q in out], pa.int64())],
                                          ["a", "b"])

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and row[0] != held[0][0]:
                yield links()
                held = []
            held.append(row)
    if held:
        yield links()


def _dealt(rows: DataFrame) -> DataFrame:
    """Links of (chunk, set, n, tokens, probe, label), one chunk at a time in memory."""
    return (rows.repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(tidied(_chunk_links), "a bigint, b bigint"))


def _tokens(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            sets = b.column(1).to_pylist()
            # repeated rows of one document come one after another from the join
            new = pa.array([x != y for x, y in zip(sets, [last, *sets], strict=False)], pa.bool_())
            last = sets[-1] if sets else last
            b = b.filter(new)
            out: list[bytes] = []
            for _, _, buf, offsets in chunks(b.column(3)):
                shingle, edge, _ = row_sets(buf, offsets, width)
                out += [shingle[a:z].tobytes() for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], ["block", "set", "n", "tokens"])
    return run


def links(docs: DataFrame, sets: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
          sketch: int | None = SKETCH, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(a, b): links between distinct sets that connect every pair of linked sets, directly or through others.

    ``sets`` is what :func:`distinct_sets` gives for ``docs``.
    """
    block = blocks(sets, sketch)
    chosen = sets.join(block.select(F.col("node").alias("set"), F.col("root").alias("block")), "set")
    rep = chosen.select("block", "set", "n", F.col("key").alias("__key"), F.col("mark").alias("__mark"))
    texts = (docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
             .join(rep, F.col("key").eqNullSafe(F.col("__key")) & (F.col("mark") == F.col("__mark")))
             .select("block", "set", "n", "text"))
    full = written(texts.mapInArrow(tidied(_tokens(width)), "block bigint, set bigint, n bigint, tokens binary"), "jaccard-tokens")
    total = written(full.groupBy("block").agg(F.sum("n").alias("tokens"), F.count("*").alias("sets")), "jaccard-blocks")
    many = F.ceil(F.col("tokens") / chunk_tokens).cast("int")
    part = F.pmod(F.xxhash64("set", F.lit(1)), F.col("k")).cast("int")
    sized = full.join(total.select("block", many.alias("k"), F.col("sets").alias("block_sets")), "block").withColumn("part", part)
    pivot = (F.col("k") > 1) & (F.pmod(F.xxhash64("set", F.lit(2)), F.greatest(F.floor(F.col("block_sets") / PIVOTS), F.lit(1))) == 0)
    parts = sized.withColumn("part", F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array("part"))))
    first = written(_dealt(parts.select(F.xxhash64("block", "part").alias("chunk"), "set", "n", F.col("tokens"),
                                        F.lit(False).alias("probe"), F.col("set").alias("label"))), "jaccard-links")
    large = total.filter(many > 1).select("block")
    if not large.head(1):
        return first
    # split blocks: what is outside the main component meets every chunk
    root = components(first, name="jaccard-first")
    wide = written(sized.filter("k > 1").join(root, sized["set"] == root["node"], "left")
                   .select("block", "set", "n", "tokens", "k", "part", F.coalesce("root", "set").alias("label")), "jaccard-large")
    main = written(wide.groupBy("block", "label").agg(F.count("*").alias("c"))
                   .groupBy("block").agg(F.max_by("label", F.struct("c", "label")).alias("main")), "jaccard-main")
    marked = wide.join(main, "block")
    out = marked.filter("label <> main")
    slots = written(out.groupBy("block").agg(F.ceil(F.sum("n") / chunk_tokens).cast("int").alias("j")), "jaccard-slots")
    members = marked.join(slots, "block").select(
        "block", "part", F.explode(F.sequence(F.lit(0), F.col("j") - 1)).alias("slot"), "set", "n", "tokens", "label",
        F.lit(False).alias("probe"))
    probes = out.join(slots, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"),
        F.pmod(F.xxhash64("set", F.lit(3)), F.col("j")).cast("int").alias("slot"), "set", "n", "tokens", "label",
        F.lit(True).alias("probe"))
    second = _dealt(members.unionByName(probes).select(
        F.xxhash64("block", "part", "slot", F.lit(4)).alias("chunk"), "set", "n", "tokens", "probe", "label"))
    return first.unionByName(written(second, "jaccard-links"))


def distinct_sets(rows: DataFrame) -> DataFrame:
    """One row per set: the smallest (key, mark) that has it (a null key only if there is no other), its size and sketch."""
    return (rows.filter("set IS NOT NULL").groupBy("set")
            .agg(F.min(F.struct(F.col("key").isNull().alias("void"), "key", "mark")).alias("r"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
            .select("set", "r.key", "r.mark", "n", "sketch"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                    sketch: int | None = SKETCH, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per row of ``docs``: integer ``key`` (null stays), ``mark`` (hash of
    the text), ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    Words are runs outside white space with A-Z in lower case; fewer than
    ``width`` words are one shingle. Null and empty texts and texts without
    words have 0 shingles and are linked with nothing: their component is
    their own key. Equal sets are linked, whether rows repeat or only agree.
    A component of null keys alone has a null id. Other columns are not read.
    """
    return grouped(docs, key, text, width, sketch, chunk_tokens).drop("root")


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
            sketch: int | None = SKETCH, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """What :func:`near_duplicates` gives, and ``root``: the set that names a row's group (null without words)."""
    rows = written(text_sets(docs, key, text, width, sketch), "jaccard-sets")
    sets = written(distinct_sets(rows), "jaccard-distinct")
    root = written(components(links(docs, sets, key, text, width, sketch, chunk_tokens), name="jaccard-final"), "jaccard-roots")
    rooted = sets.join(root, sets["set"] == root["node"], "left").select("set", "key", F.coalesce("root", "set").alias("root"))
    # most sets are alone: only those with a link look for their component's smallest key
    least = written(root.join(sets, root["node"] == sets["set"]).groupBy("root").agg(F.min("key").alias("component")),
                    "jaccard-least")
    named = (rooted.join(least, "root", "left")
             .select(F.col("set").alias("__set"), "root", F.when(F.col("component").isNotNull(), F.col("component"))
                     .otherwise(F.col("key")).alias("component")))
    own = rows.select("key", "mark", "n", "set")
    return own.join(named, own["set"] == named["__set"], "left").select(
        "key", "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"), "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, its columns unchanged.

    The row with the smallest key stays (of several with that key the one with
    the smallest text hash; rows equal in key and text are one document and
    one of them stays). Groups are told apart by their texts: unlinked texts
    that share a key each stay. Rows without words are no duplicates of
    anything and all stay. A null key stays only where its whole group has
    null keys.
    """
    groups = (grouped(docs, key, text)
              .groupBy("key", "mark", "root", (F.col("n_shingles") > 0).alias("worded")).agg(F.count("*").alias("times")))
    stays = (groups.filter("worded").groupBy("root")
             .agg(F.min(F.struct(F.col("key").isNull().alias("void"), "key", "mark", "times")).alias("s"))
             .select("s.key", "s.mark", "s.times"))
    own, mark, times = free(docs, "__key", "__mark", "__times")
    empty = groups.filter("NOT worded").select("key", "mark", F.lit(1).cast("long").alias("times"))
    kept = (stays.unionByName(empty)
            .select(F.col("key").alias(own), F.col("mark").alias(mark), F.col("times").alias(times)))
    condition = docs[key].cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(docs[text]) == F.col(mark))
    found = docs.join(kept, condition)
    columns = [docs[c] for c in docs.columns]
    return found.filter(F.col(times) == 1).select(*columns).unionByName(
        found.filter(F.col(times) > 1).select(*columns).dropDuplicates([key, text]))
