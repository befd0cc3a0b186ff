"""Jaccard join, substring removal, decontamination and neighbours against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillroll.llm import decontaminate, jaccard, neighbours, substrings
from tillroll.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def prose(rnd, n, words=WORDS):
    out, size = [], 0
    while size < n:
        k = min(rnd.randrange(4, 14), n - size)
        out.append(" ".join(rnd.choice(words) for _ in range(k)).capitalize() + ".")
        size += k
    return " ".join(out)


def edited(rnd, text, share):
    return " ".join(w if rnd.random() > share else rnd.choice(WORDS) for w in text.split(" "))


# -- n-gram Jaccard join ----------------------------------------------------

def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_components(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    where, parent = defaultdict(set), {k: k for k in sets}
    for k, s in sets.items():
        for x in s:
            where[x].add(k)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in sets.items():
        for other in set().union(*(where[x] for x in s)) if s else ():
            both = len(s & sets[other])
            if other > k and 100 * both >= 75 * (len(s) + len(sets[other]) - both):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def families(seed=5):
    rnd = random.Random(seed)
    texts, k = {}, 0
    for size in (40, 12, 5, 2, 2, 1, 1, 1):
        base = prose(rnd, rnd.choice((30, 120, 400)))
        for _ in range(size):
            texts[k] = edited(rnd, base, rnd.choice((0, 0.01, 0.02, 0.03, 0.05, 0.1)))
            k += 1
    line = prose(rnd, 60)
    for _ in range(25):  # a passage that many texts share links none of them
        texts[k] = line + " " + prose(rnd, 80)
        k += 1
    for t in ("", None, "  \n", "one", "ONE", "one two three four", "one two three four five", "É é", "é é"):
        texts[k] = t
        k += 1
    texts[k] = "long " * 30000
    return texts


@pytest.mark.parametrize("how", [{}, {"sketch": None}, {"chunk_tokens": 1500}])
def test_components_equal_brute_force(spark, how):
    texts = families()
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id bigint, text string, component_id string")
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, **how).collect()}
    assert got == brute_components(texts)


def test_large_block_is_split_and_stays_exact(spark):
    rnd = random.Random(9)
    base, other = prose(rnd, 200), prose(rnd, 200)
    texts = {k: edited(rnd, base, 0.02) for k in range(150)}
    chain = base.split(" ")
    for k in range(150, 170):  # a chain from one text to another, linked step by step only
        at = int(len(chain) * (k - 150) / 20)
        texts[k] = " ".join(other.split(" ")[:at] + chain[at:])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, chunk_tokens=2000).collect()}
    assert got == brute_components(texts)


def test_repeated_null_and_empty_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (2, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.key, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (2, 0, 2), (2, 0, 2)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, "a b c d e f"), (None, "x y"), (2, None), (2, "")], key=str)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_keep_one_keeps_one_of_each_group(spark):
    texts = families(6)
    df = spark.createDataFrame([(k, t, k) for k, t in texts.items()], "doc_id bigint, text string, n_chars bigint")
    kept = jaccard.keep_one(df)
    want = {c if n else k for k, (n, c) in brute_components(texts).items()}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want


def test_keep_one_with_repeated_keys_keeps_every_group(spark):
    rnd = random.Random(21)
    texts = [prose(rnd, 60) for _ in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (5, texts[1] + " end"), (1, texts[1]), (1, texts[2]), (6, texts[3]), (None, texts[3] + " end"),
            (None, "x y z"), (None, "X y z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=str)
    want = [(1, t) for t in texts[:3]] + [(6, texts[3])]
    assert [r for r in got if r[0]] == sorted(want, key=str) and [t.lower() for k, t in got if k is None] == ["x y z"]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(7, 7), (None, 3), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 1000 for k in range(1000, 1200)}, 2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- substring removal ------------------------------------------------------

def test_later_copies_of_a_passage_go(spark):
    rnd = random.Random(2)
    passage = " ".join(" ".join(rnd.choice(WORDS) for _ in range(9)).capitalize() + "." for _ in range(7))
    own = {k: (prose(rnd, 40), prose(rnd, 40)) for k in range(6)}
    rows = [(k, f"{a}\n{passage}\n{b}" if k in (1, 3, 4) else f"{a}\n{b}", "en", 0) for k, (a, b) in own.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string, n_chars bigint")
    got = {r.doc_id: r for r in substrings.remove_repeats(df).collect()}
    before = {r[0]: r[1] for r in rows}
    for k in (0, 1, 2, 5):
        assert got[k].text == before[k] and got[k].n_chars == 0
    for k in (3, 4):
        assert got[k].text.split() == " ".join(own[k]).split() and got[k].n_chars == len(got[k].text)
    spans = {r.key: r for r in substrings.repeated_spans(df).collect()}
    assert set(spans) == {3, 4} and spans[3].earlier == [1] and [e - s for s, e in zip(spans[3].start, spans[3].end)] == [63]


def brute_spans(texts):
    """Word offsets to remove, from the definition of runs."""
    seen, out = {}, defaultdict(set)
    for k in sorted(texts):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", texts[k]) if w]
        cuts = [0] + [i + 1 for i, w in enumerate(words) if w[-1] in ".!?" or i == len(words) - 1]
        spans = set()
        for i in range(len(cuts) - 1):
            j = next((j for j in range(i + 2, len(cuts)) if cuts[j] - cuts[i] >= 20), None)
            h = next((h for h in range(i - 1, -1, -1) if cuts[i + 1] - cuts[h] >= 20), None)
            spans |= {(cuts[i], cuts[j])} if j else set()
            spans |= {(cuts[h], cuts[i + 1])} if h is not None else set()
            spans |= {(cuts[i], cuts[i + 1])} if cuts[i + 1] - cuts[i] >= 50 else set()
        for a, z in sorted(spans):
            content = " ".join(words[a:z]).lower()
            if seen.setdefault(content, (k, a)) != (k, a):
                out[k].update(range(a, z))
    return dict(out)


def test_spans_equal_brute_force_over_batches(spark):
    rnd = random.Random(4)
    pool = [prose(rnd, 30) for _ in range(6)]
    texts = {k: " ".join(rnd.choice(pool) if rnd.random() < 0.3 else prose(rnd, 25) for _ in range(6)) for k in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.key: {w for s, e in zip(r.start, r.end) for w in range(s, e)} for r in substrings.repeated_spans(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_spans(texts)


def test_substring_odd_rows(spark):
    text = "One two three four five six seven eight nine ten. " * 3
    rows = [(None, text), (1, text), (1, text), (2, None), (3, ""), (4, "x" * 100_000), (5, "a b c.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text) for r in substrings.remove_repeats(df).collect()), key=str)
    first = "One two three four five six seven eight nine ten."
    assert [t for k, t in got if k is None][0].strip() == first  # sentences two and three repeat one and two
    assert [t for k, t in got if k == 1] == ["", ""]
    assert {(k, t) for k, t in got if k in (2, 3, 4, 5)} == {r for r in rows if r[0] in (2, 3, 4, 5)}
    assert substrings.remove_repeats(df.limit(0)).count() == 0


# -- decontamination --------------------------------------------------------

def plain_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


def test_alignment_equals_the_plain_matrix():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(3, 20)), rng.integers(0, 5, rng.integers(1, 40))
        score, low, high = decontaminate.align(a.astype(np.uint64), b.astype(np.uint64))
        assert score == pytest.approx(plain_alignment(a, b))
        assert score == pytest.approx(plain_alignment(a, b[low:high])) or score == 0


def test_exact_and_edited_copies_are_found(spark):
    rnd = random.Random(8)
    items = {i: prose(rnd, 35) for i in range(12)}
    docs, leaked = {}, set()
    for k in range(80):
        docs[k] = prose(rnd, 120)
    for k, (i, share) in enumerate([(0, 0), (1, 0.1), (2, 0.15), (3, 0), (3, 0), (3, 0.1)]):
        docs[k] = prose(rnd, 50) + "\n" + edited(rnd, items[i], share).upper() + " " + prose(rnd, 50)
        leaked.add((k, i))
    words = items[4].split(" ")
    docs[6] = prose(rnd, 40) + " " + " ".join(words[:10] + ["extra"] + words[10:20] + words[22:])  # added and dropped words
    leaked.add((6, 4))
    for k in range(20, 60):  # every item's rare grams stay seeds although one item is everywhere
        docs[k] += " " + items[5]
        leaked.add((k, 5))
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame([*items.items(), (90, "too short"), (91, None), (None, items[0])], "item_id bigint, text string")
    found = decontaminate.contamination(df, bench).collect()
    assert {(r.key, r.item) for r in found if r.item is not None} == leaked
    assert {r.key for r in found if r.item is None} == {0} and all(0.6 <= r.score <= 1 for r in found)
    one = next(r for r in found if r.key == 3)
    assert one.score == 1 and " ".join(docs[3].split()[one.start:one.end]).lower() == items[3].lower()
    clean = decontaminate.without_contaminated(df, bench)
    assert {r.doc_id for r in clean.collect()} == set(docs) - {k for k, _ in leaked} and clean.columns == df.columns


@pytest.mark.parametrize("copies", [3, 5, 1000])
def test_edited_copy_is_found_in_groups_of_any_size(spark, copies):
    rnd = random.Random(11)
    item = [f"item{i}" for i in range(40)]
    passage = " ".join("other" if i % 5 == 2 else w for i, w in enumerate(item))  # 16 of 38 grams are left
    docs = {k: prose(rnd, 20) + " " + passage + " " + (prose(rnd, 20) if k % 2 else "the end") for k in range(copies)}
    docs[copies] = " ".join(item)  # the grams that the edits took are rare
    docs[copies + 1] = prose(rnd, 80)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item))], "item_id bigint, text string")
    found = decontaminate.contamination(df, bench).collect()
    assert {(r.key, r.item) for r in found} == {(k, i) for k in range(copies + 1) for i in (1, 2)} and len(found) == 2 * copies + 2
    assert {r.score for r in found if r.key < copies} == {0.7}


def test_long_excerpts_of_an_item_are_found(spark):
    rnd = random.Random(13)
    items = {1: [f"short{i}" for i in range(59)], 2: [f"long{i}" for i in range(200)]}
    parts = {0: items[1][:35], 1: items[2][60:160], 2: items[2][10:40] + ["added"] + items[2][40:60], 3: items[1][20:40],
             4: [w if i % 3 else "other" for i, w in enumerate(items[2][:90])]}  # a short one, and one of scattered words
    docs = {k: prose(rnd, 30) + " " + " ".join(p) + " " + prose(rnd, 30) for k, p in parts.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    found = {(r.key, r.item): r for r in decontaminate.contamination(df, bench).collect()}
    assert set(found) == {(0, 1), (1, 2), (2, 2)}
    assert found[0, 1].score == pytest.approx(35 / 59) and found[1, 2].score == 0.5 and found[1, 2].end - found[1, 2].start == 100
    assert {r.doc_id for r in decontaminate.without_contaminated(df, bench).collect()} == {3, 4}


def test_decontamination_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "fox"), (5, "word " * 60_000 + text)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, text), (7, text)], "item_id bigint, text string")
    found = decontaminate.contamination(df, bench).collect()
    assert sorted((r.key or 0, r.item) for r in found) == sorted([(k, 7) for k in (0, 1, 1, 5) for _ in range(2)])
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).count() == 0


# -- neighbours -------------------------------------------------------------

def brute_neighbours(x, ids, own, k=5):
    norms = np.sqrt((x * x).sum(1))
    i = list(ids).index(own)
    c = (x * x[i]).sum(1) / (norms * norms[i])
    order = [j for j in np.lexsort((ids, -c)) if ids[j] != own][:k]
    return [(int(ids[j]), float(c[j])) for j in order]


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    t = df.toPandas()
    x = np.stack(t.embedding.values).astype(float)
    got = defaultdict(dict)
    for r in neighbours.search(df, df.filter("vec_id % 50 = 0")).collect():
        got[r.query_id][r.vec_id] = r.score
    hits = total = 0
    for q in t.vec_id[t.vec_id % 50 == 0]:
        for j, c in brute_neighbours(x, t.vec_id.values, q):
            total += 1
            if j in got[q]:
                hits += 1
                assert got[q][j] == pytest.approx(c, abs=1e-12)
    assert hits >= 0.9 * total


def test_copies_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(k, base.tolist()) for k in range(40)] + [(100 + k, rng.normal(size=8).tolist()) for k in range(60)]
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0] * 7 + [None]), (204, [float("inf")] + [1.0] * 7),
             (205, []), (206, [1.0, 2.0]), (None, base.tolist()), (0, base.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(df, df.filter("vec_id IN (0, 20, 200, 201, 206)")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 12)))
    assert set(got) == {0, 20}
    assert got[0] == [(i + 1, i + 1, 1.0) for i in range(5)] and got[20] == [(i + 1, i, 1.0) for i in range(5)]


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id) for r in neighbours.search(df, df.filter("vec_id = 1")).orderBy("rank").collect()]
    assert got == [(1, 1, 3), (1, 2, 2)]
    assert neighbours.search(df.filter("vec_id = 1"), df.filter("vec_id = 1")).count() == 0
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0
    assert neighbours.search(df, df.limit(0)).count() == 0


def test_split_buckets_give_the_same_result(spark, monkeypatch):
    rng = np.random.default_rng(6)
    near = rng.normal(size=16)
    rows = [(k, (near + 0.01 * rng.normal(size=16)).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = df.filter("vec_id % 50 = 0")
    whole = sorted(map(tuple, neighbours.search(df, queries).collect()))
    monkeypatch.setattr(neighbours, "SPLIT_ROWS", 20)
    monkeypatch.setattr(neighbours, "PART_BYTES", 4000)
    split = sorted(map(tuple, neighbours.search(df, queries).collect()))
    assert [x[:3] for x in split] == [x[:3] for x in whole] and len(whole) == 30
