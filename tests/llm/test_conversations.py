"""Conversation repair against a search over all edits, odd rows, and long conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) by cheapest-first search over edits, audits in ASCII order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    ini = [role[:1] or " " for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:], strict=False))
    n, queue, done = len(rows), [(0, "", 0, ())], set()
    while queue:
        cost, audit, i, out = heapq.heappop(queue)
        initials = "".join(r[:1] for r, _ in out)
        if i == n and GRAMMAR.fullmatch(initials):
            break
        key = (i, initials[-1:], len(out) == 0, initials == "s")
        if key in done:
            continue
        done.add(key)
        if len(out) > n + 4:
            continue

        def step(letter, more, j, row, cost=cost, audit=audit, out=out):
            new = (*out, row) if row else out
            text = "".join(r[:1] for r, _ in new)
            # only what can still become a whole conversation
            if re.fullmatch(r"(s?(ua)*u?)?", text):
                heapq.heappush(queue, (cost + more, audit + letter, j, new))

        for role in ("user", "assistant"):
            step("I", 3, i, (role, ""))
        if i < n:
            step("D", 4, i + 1, None)
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if ini[i] in "sua":
                    step("K", extra, i + 1, (rows[i][1], rows[i][2]))
                for role in ("user", "assistant"):
                    step("R", 3 + extra, i + 1, (role, rows[i][2]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def _random(seed, convs=150):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for _ in range(rnd.randrange(0, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", "ue"])
            text = rnd.choice(["Hello there.", "Well", "Why? ", " \t", "", "Yes!\n", "and so\n", f"n{rnd.randrange(4)}.", "é.", "a.b"])
            rows.append((c, rnd.choice([None, 0, 1, 1, 2, 3, 5, 8]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_a_search_over_all_edits(spark, seed):
    rows = _random(seed)
    got = {r.key: tuple(r)[1:] for r in C.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role, text))
    assert got == {c: brute(v) for c, v in by.items()}


def test_damage_follows_the_checksum(spark):
    rows = [(i % 7, i, "assistant", f"One. Two! {i}?") for i in range(200)] + [(None, None, None, None)]
    got = sorted(map(tuple, C.damage(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert got == sorted(want, key=repr)


def test_query_returns_every_conversation_also_without_rows(spark, tmp_path):
    rows = [(c, t, r, x) for c in (None, 1, 2) for t, r, x in ((0, "user", "Hi."), (1, "assistant", "Yo."))]
    gone = next(c for c in range(10, 500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi."), (5, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("symbols", F.lit("clash")).withColumn("key", F.lit(1))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in E.queries()["op13_conversations"](spark, str(tmp_path)).collect()}
    assert set(got) == {None, 1, 2, gone, 5}
    empty = hashlib.sha256().hexdigest()
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[5].audit == "D" and got[5].cost == 4 and got[5].blank == 1 and got[5].gaps == 0 and got[5].repaired_sha256 == empty


def test_query_equals_its_sql(spark):
    import duckdb

    from tests.helpers import same
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    ok, detail = same(E.queries()["op13_conversations"](spark, sf), con, E.oracle_sql()["op13_conversations"])
    assert ok, detail


def test_one_long_conversation_is_read_by_many_tasks_and_empty_tables(spark):
    n = 6000
    long = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(n)]
    other = [(2 + i % 50, i, "user", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(long + other, SCHEMA)
    marked = C.faults(df)
    parts = (marked.repartitionByRange(8, "key", "turn", "role", "mark", "nth").where("key = 1")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    row = C.repair(df).where("key = 1").first()
    want = hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in long).encode()).hexdigest()
    assert (row.cost, row.audit, row.illegal, row.gaps, row.sha256) == (0, "K" * n, 0, 0, want)
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_strings_that_share_an_ending_share_nodes():
    import pyarrow as pa
    made = []
    real = C.node_before
    try:
        C.node_before = lambda s, after: made.append(s) or real(s, after)
        strings = ["uaua", "suaua", "oaua", "xuaua", "ua"]
        batch = pa.RecordBatch.from_arrays([pa.array(sorted(strings, key=lambda s: s[::-1])), pa.array(sorted(s[::-1] for s in strings))], ["symbols", "ending"])
        out = [b.to_pydict() for b in C._cheapest(iter([batch]))][0]
    finally:
        C.node_before = real
    assert len(made) == len({s[-k:] for s in strings for k in range(1, len(s) + 1)})    # one node per distinct ending
    assert dict(zip(out["symbols"], zip(out["cost"], out["audit"], strict=True), strict=True))["oaua"] == (3, "RKKK")
