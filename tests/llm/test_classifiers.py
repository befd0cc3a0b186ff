"""Quality and toxicity models: identities, held-out accuracy and odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import quality, toxicity
from tillroll.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_linear_time_score_equals_all_pairs():
    rng = np.random.default_rng(2)
    size = quality.BUCKETS + quality.BINS
    model = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, 3)), np.zeros((1, quality.BINS - 1)))
    f = quality.Features(np.array([0, 0, 0, 1]), np.array([3, 7, 9, 7]), np.array([0.5, 0.2, 0.8, 1.0]), np.array([[0.0], [1.0]]))
    row, index, x = model.with_bins(f)
    for r in (0, 1):
        at = np.flatnonzero(row == r)
        z = model.bias + sum(model.weight[index[i]] * x[i] for i in at)
        z += sum(model.factor[index[i]] @ model.factor[index[j]] * x[i] * x[j] for i, j in itertools.combinations(at, 2))
        assert model.score(f)[r] == pytest.approx(1 / (1 + np.exp(-z)))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    e, move = rng.normal(size=9), rng.normal(size=(2, 2))
    begin, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    p, moves = toxicity._both_ways(e, move, begin, length)
    want, pairs = np.zeros(9), np.zeros((2, 2))
    for b, n in zip(begin, length):
        weights = {}
        for tags in itertools.product((0, 1), repeat=int(n)):
            s = sum(e[b + i] * t for i, t in enumerate(tags)) + sum(move[tags[i], tags[i + 1]] for i in range(n - 1))
            weights[tags] = np.exp(s)
        total = sum(weights.values())
        for tags, w in weights.items():
            want[b:b + n] += w / total * np.array(tags)
            for i in range(n - 1):
                pairs[tags[i], tags[i + 1]] += w / total
    assert np.allclose(p, want) and np.allclose(moves, pairs)


@pytest.mark.parametrize("name,label,of,rest", [("op8_quality", "quality", 3, 1), ("op10_toxicity", "toxic", 5, 0)])
def test_held_out_accuracy(spark, name, label, of, rest):
    got = QUERIES[name](spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = got.join(labels, "doc_id").select("held_out", "score", "predicted", F.col(label).alias("y"), "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    one, zero = ([r.score for r in held if r.y == v] for v in (1, 0))
    better = np.mean([a > b for a in one for b in zero])
    assert better >= (0.97 if label == "quality" else 0.75)  # a few hundred labels only


def test_held_out_toxicity_on_a_larger_table(spark):
    """Some 800 held-out labels; measured 0.963 and 0.985."""
    large = "/root/testdata/sf0.1"
    rows = (QUERIES["op10_toxicity"](spark, large).where("held_out").join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id")
            .where("toxic IS NOT NULL").select("score", "predicted", "toxic").collect())
    one, zero = (np.array([r.score for r in rows if r.toxic == v]) for v in (1, 0))
    assert len(one) > 50 and (one[:, None] > zero[None, :]).mean() >= 0.94
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.97


def docs(spark):
    rows = [(1, "a plain text of words.", None, "s"), (1, "a plain text of words.", 22, "s"), (None, None, 5, "s"), (4, "", 0, "s"),
            (5, "word " * 60_000, 300_000, "s"), (6, "!!!", 3, "s")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, score string")


def test_sample_has_one_row_of_each_id(spark):
    rows = [(1, f"text {i}", i) for i in range(500)] + [(2, None, 1), (2, "long " * 30, 2), (3, "three", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 0)], "doc_id bigint, quality int")
    for most in (None, 100):
        got = quality.labelled_sample(df, labels, "quality", F.lit(True), extra=("n_chars",), most_bytes=most).collect()
        assert sorted((r[0], r[2]) for r in got) == [(1, 1), (2, 0), (3, 0)]
        assert {(r[0], r[1], r.n_chars) for r in got} <= set(rows) and (most is None or [r[1] for r in got if r[0] == 2] == [None])


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, None), (None, 1), (6, 0)], "doc_id bigint, quality int")
    model = quality.fit(docs(spark), labels)
    out = quality.score(docs(spark), model)
    assert out.columns == ["doc_id", "text", "n_chars", "score"] and out.count() == 6
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert quality.keep_good(docs(spark), model).columns == docs(spark).columns
    nothing = quality.fit(docs(spark), labels.limit(0))
    assert {r.score for r in quality.score(docs(spark), nothing).collect()} == {0.5}
    assert quality.score(docs(spark).limit(0), model).count() == 0


def test_toxicity_spans_and_odd_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(f"word{x}" for x in rnd.integers(0, 99, 20)) + (" you ugly brute now." if i % 2 else " you kind friend now."))
            for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    chain = toxicity.fit(train, labels)
    seen = toxicity.score(spark.createDataFrame([(1, "so é UGLY, brute!"), (2, "a kind friend")], "doc_id int, text string"), chain,
                          spans="spans")
    got = {r.doc_id: r for r in seen.collect()}
    raw = "so é UGLY, brute!".encode()
    assert got[1].score > 0.5 > got[2].score and not got[2].spans
    assert {raw[s.start:s.end].decode() for s in got[1].spans} <= {"UGLY", "brute"} and got[1].spans
    out = toxicity.score(docs(spark), chain, spans="n_chars")
    assert out.columns == ["doc_id", "text", "score", "n_chars"] and out.count() == 6
    none = toxicity.fit(train, labels.limit(0))
    assert {r.score for r in toxicity.score(docs(spark), none).collect()} == {0.5}
    assert toxicity.score(docs(spark).limit(0), chain).count() == 0


def test_long_and_empty_sequences():
    t = toxicity.Tokens(*toxicity.flat([b"", b"word " * 5000, b"a. b! c?\nd", b" "]))
    assert t.length.sum() == len(t.start) == 5004 and t.length.max() == 5000
    assert (t.doc[t.begin] == t.doc[t.begin + t.length - 1]).all()
