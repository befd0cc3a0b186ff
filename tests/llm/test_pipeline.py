"""The pipeline's stages on a small corpus with planted cases, and its registration."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm import byte_bpe
from tests.llm.test_similarity import brute_components, edited, prose

LETTERS = ["".join(p) for p in zip("abcdefghijklmnopqrst" * 20, "bcdfghjklmnpqrstvwxz" * 20)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(12)
    items = {i: prose(rnd, 30) for i in range(5)}
    passage = prose(rnd, 70)
    good = {k: prose(rnd, rnd.randrange(80, 200)) for k in range(120)}
    for k in range(3, 9):
        good[k] = edited(rnd, good[2], 0.01)
    good[10] = good[11] = good[12]
    good[20] += "\n" + passage
    good[21] += "\n" + passage + "\n" + prose(rnd, 60)
    good[30] += " " + items[1]
    good[31] += " " + edited(rnd, items[2], 0.1)
    rows = [(k, t, "en", "s", len(t)) for k, t in good.items()]
    rows += [(1000 + k, " ".join(w.upper() + "!!" for w in prose(rnd, 60).split()), "en", "s", 300) for k in range(60)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 1000), 0) for k, *_ in rows], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, good, passage


def test_planted_cases(spark, corpus):
    folder, good, passage = corpus
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    first = {c for _, c in brute_components(good).values()}
    assert set(out) == first - {30, 31}
    texts = {k: r.text for k, r in out.items()}
    assert texts[20] == good[20] and passage not in texts[21]
    assert all(texts[k] == good[k] and out[k].n_chars == len(good[k]) for k in texts if k != 21)
    path = byte_bpe._path(None)
    assert all(byte_bpe.encoder(path).decode(byte_bpe.np.array(r.ids)) == r.text.encode() for r in out.values())


def test_stages_keep_the_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus[0])
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x[:2] == "op" and x[2].isdigit()}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


CLASHING = ("__key", "__mark", "__start", "__end", "__cut", "__text", "__quality", "__times", "__meta0", "key", "mark", "set", "score")


def test_clashing_columns_null_and_repeated_ids_pass_all_stages(spark, corpus, tmp_path):
    from pyspark.sql import functions as F
    folder, good, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id BETWEEN 40 AND 70")
    odd = spark.createDataFrame([(None, good[75], "en", None, None), (40, good[76], None, "s", 5), (41, None, "en", "s", 0), (42, "", "en", "s", 0)], docs.schema)
    wide = docs.unionByName(docs.where("doc_id = 50")).unionByName(odd)     # a repeated row, an id with two texts, null and empty texts
    for c in CLASHING:
        wide = wide.withColumn(c, F.lit(f"own {c}"))
    at = wide
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, folder)
        assert set(wide.columns) <= set(out.columns)
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
    rows = at.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    texts = sorted((r.doc_id or -1, r.text) for r in rows if r.text)
    want = sorted([(k, good[k]) for k in range(40, 71)] + [(-1, good[75]), (40, good[76])])
    assert texts == want


def test_empty_table_passes_all_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0
