"""Token counts and byte-level BPE against the public tokenizer libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tillroll.llm import byte_bpe, token_counts
from tillroll.llm.pretoken import PreTokens
from tillroll.llm.textarrays import chunks


def odd_texts(n=400):
    rnd = random.Random(3)
    letters = "abz'stremvld  \n\t é1²٣中!?-   😀ͅá"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(n)] + [
        "", None, " ", "\n\n", "a" * 5000, "'s", "''s", "don't 've 'llx", "x<|endoftext|>y", "<|endoftext|><|endoftext|>",
        "word " * 3000, " x", "日本語のテキスト"]


@pytest.fixture(scope="module")
def reference():
    counter = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return counter, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_follow_the_pattern():
    texts = odd_texts(3000)
    pattern = regex.compile(P.PATTERN)
    for first, end, buf, offsets in chunks(pa.array(texts), 5000):
        pre, raw = PreTokens(buf, offsets), buf.tobytes()
        for d in range(end - first):
            spans = zip(pre.start[pre.first[d]:pre.first[d + 1]], pre.end[pre.first[d]:pre.first[d + 1]], strict=True)
            assert [raw[a:z].decode() for a, z in spans] == pattern.findall(texts[first + d] or "")


def test_counts_equal_the_library(spark, reference):
    texts = odd_texts()
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, row int")
    got = {r.row: r for r in token_counts.count_tokens(df, keys=("doc_id", "row")).collect()}
    want = [len(x.ids) for x in reference[0].encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert [got[i].over_limit for i in range(len(texts))] == [n > 1024 for n in want]


def test_counts_of_real_documents(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in token_counts.count_tokens(df).collect():
        assert r.n_tokens == len(reference[0].encode(texts[r.doc_id] or "", add_special_tokens=False).ids)


def test_encode_equals_the_library_and_decodes(spark, reference):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")
    encoded = byte_bpe.encode(df)
    for r in byte_bpe.decode(encoded, text="back").collect():
        assert r.ids == reference[1].encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.back) == (texts[r.doc_id] or "").encode() and r.n_tokens == "kept"
    for r in byte_bpe.round_trip(df).collect():
        ids = reference[1].encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_decode_of_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert {r.k: bytes(r.text) for r in byte_bpe.decode(df).collect()} == {1: b"", 2: b""}


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    assert sorted(byte_bpe.PerfectHash(keys).slots(keys).tolist()) == list(range(len(keys)))


def test_empty_tables_and_clashing_keys(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.count_tokens(empty).count() == 0
    assert byte_bpe.round_trip(empty).count() == 0 and byte_bpe.encode(empty).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(empty.withColumnRenamed("doc_id", "n_bytes"), keys=("n_bytes",))


def test_long_pretokens_equal_the_library_and_stay_fast():
    import random
    import time

    import public_tokenizers
    from tokenizers import Tokenizer

    from tillroll.llm import token_counts
    path = public_tokenizers.path(token_counts.VOCABULARY)
    library, rnd = Tokenizer.from_file(path), random.Random(4)
    mixed = "".join(rnd.choice("etaoinshrdlu") for _ in range(200_000))
    cases = ["a" * n for n in (255, 256, 257, 5000)] + ["aaaab" * 700, "ab" * 900, "中文字符" * 900, "=" * 3000, mixed]
    texts = [*cases, " ".join(cases[:-1])]      # alone, and several long sequences at once
    assert token_counts.merges(path).rising
    start = time.perf_counter()
    got = token_counts.text_counts(pa.array(texts), path).tolist()
    assert time.perf_counter() - start < 30
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
