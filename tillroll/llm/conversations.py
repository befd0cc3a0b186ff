"""Repair of conversation structure with the fewest edits.

Every row of a conversation becomes one symbol: its role's initial (system,
user, assistant or other) and its fault. The cheapest edits of a conversation
depend on its symbols alone, and the cost of what is still to come on the
symbols that follow. So the distinct symbol strings of all conversations are
sorted from their ends: strings that share an ending share the nodes of one
automaton (a DAWG minimised from the end), and at each node the cost to go and
the best audit are found once per grammar state, whoever uses them. A task
holds the nodes of one path; audits are linked letters that share their ends.

Rows are ordered by turn (nulls first), then role, then the MD5 of the text, so
that ties have one order; rows equal in all of these are duplicates of the first.
Symbol strings are put together from pieces of a range sort, so a conversation
with very many rows is read by many tasks; only its string, one byte a row, is
ever in one place. Replaying the edits and hashing the repaired rows streams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.storage import written

SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Grammar states: start, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that an inserted or re-roled row gets in a state, and the state after it.
FORCED = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
#: The state after a kept row.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: A row that must be deleted.
GONE = "x"

_NEVER = (1 << 60, "~", None)


# -- the automaton ----------------------------------------------------------

def _with_inserts(base: list[tuple]) -> tuple:
    """Cells of a node (cost, letter, next cell) after the choice of inserting a row first."""
    def best(state: int, after: tuple) -> tuple:
        insert = (after[0] + INSERT, "I", after)
        return min(base[state], insert, key=lambda c: c[:2])

    user, assistant = best(USER, base[ASSISTANT]), best(ASSISTANT, base[USER])
    return best(START, user), best(SYSTEM, user), user, assistant


def end_node() -> tuple:
    """Cells where nothing follows: a conversation may end empty or after an assistant."""
    done = (0, "", None)
    return _with_inserts([done, _NEVER, _NEVER, done])


def node_before(symbol: str, after: tuple) -> tuple:
    """Cells of the node that reads ``symbol`` and goes on to ``after``.

    All edits possible in one state begin with different letters, so the least
    audit among equal costs is decided by the first letter."""
    initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    base = []
    for state in range(4):
        choice = [(after[state][0] + DELETE, "D", after[state])]
        if symbol != GONE:
            kept = KEEP.get((state, initial))
            if kept is not None:
                choice.append((after[kept][0] + extra, "K", after[kept]))
            forced = after[FORCED[state][1]]
            choice.append((forced[0] + REROLE + extra, "R", forced))
        base.append(min(choice, key=lambda c: c[:2]))
    return _with_inserts(base)


def audit_of(cell: tuple) -> str:
    letters = []
    while cell is not None:
        letters.append(cell[1])
        cell = cell[2]
    return "".join(letters)


def _cheapest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(symbols, cost, audit) of symbol strings sorted from their ends; the stack holds the nodes of the last one."""
    stack, before = [end_node()], ""
    for batch in batches:
        costs, audits = [], []
        for ending in batch.column(1).to_pylist():
            same = 0
            while same < len(before) and same < len(ending) and before[same] == ending[same]:
                same += 1
            del stack[same + 1:]
            for symbol in ending[same:]:
                stack.append(node_before(symbol, stack[-1]))
            before = ending
            first = stack[-1][START]
            costs.append(first[0])
            audits.append(audit_of(first))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                         ["symbols", "cost", "audit"])


def cheapest_edits(symbols: DataFrame) -> DataFrame:
    """(symbols, cost, audit) of every distinct string in column ``symbols``."""
    ends = (symbols.select("symbols").distinct().withColumn("ending", F.reverse("symbols"))
            .repartitionByRange("ending").sortWithinPartitions("ending"))
    return ends.mapInArrow(_cheapest, "symbols string, cost long, audit string")


# -- faults and symbol strings ----------------------------------------------

def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Known damage for trials: by crc32(``key:turn``) % 20 a row is dropped (0), emptied (1), loses its ``[.!?]`` (2),
    comes twice (3) or becomes the user's (4). Nulls count as one space; the columns are ``key`` and ``turn`` as given, role and text."""
    def spaced(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced(key), F.lit(":"), spaced(turn)).cast("binary")) % 20
    return (rows.select(F.col(key), F.col(turn).cast("long").alias(turn), kind.alias("_kind"), spaced(role).alias("_role"), spaced(text).alias("_text"))
            .withColumn("_times", F.explode(F.expr("array_repeat(0, CASE _kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)")))
            .select(key, turn, F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias(role),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text")).alias(text)))


def faults(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text, mark, nth, initial, fault, symbol) of every row, as a written table.

    The first fault counts: ``blank`` (nothing but white space), ``duplicate``
    (role and text seen earlier in the conversation), ``truncated`` (its last
    solid character is not ``[.!?]``); else null. Null roles and texts are one
    space; an empty role has a space as initial."""
    clean = rows.select(F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    earlier = Window.partitionBy("key", "role", "mark").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(~F.col("text").rlike(SOLID), "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.col("text").rlike(ENDED), "truncated"))
    initial = F.coalesce(F.nullif(F.substring("role", 1, 1), F.lit("")), F.lit(" "))
    symbol = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), GONE)
              .when(F.col("fault") == "truncated", F.upper(symbol)).otherwise(symbol))
    marked = (clean.withColumn("mark", F.md5(F.col("text").cast("binary"))).withColumn("nth", F.row_number().over(earlier))
              .withColumn("fault", fault).withColumn("initial", initial).withColumn("symbol", symbol))
    return written(marked.select("key", "turn", "role", "text", "mark", "nth", "initial", "fault", "symbol"), "conversation-rows")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the rows of a conversation that are next to each other in this partition."""
    number = TaskContext.get().partitionId()
    names = ["piece", "first_turn", "last_turn", "least", "most", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last", "symbols"]
    types = [pa.int32()] + [pa.int64()] * 9 + [pa.string()] * 3
    now, open_ = None, False
    out: list[tuple] = []

    def close() -> None:
        if open_:
            out.append((now, number, first_turn, turn, least, most, turns, found["blank"], found["duplicate"], found["truncated"],
                        illegal, first, last, "".join(symbols)))

    for batch in batches:
        for key, t, initial, fault, symbol in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if not open_ or key != now:
                close()
                now, open_ = key, True
                first_turn, turn, least, most, turns = t, t, t, t, int(t is not None)
                found = {"blank": 0, "duplicate": 0, "truncated": 0}
                illegal, first, symbols = 0, initial, []
            else:
                illegal += last + initial not in ("su", "ua", "au")
                if t != turn:
                    turns += 1
                    least = t if least is None else least
                most, turn = t, t
            last = initial
            symbols.append(symbol)
            if fault is not None:
                found[fault] += 1
        if out:
            yield _batch(out, batch.schema.field(0).type, names, types)
            out = []
    close()
    if out:
        yield _batch(out, batch.schema.field(0).type, names, types)


def _batch(out: list[tuple], key_type: pa.DataType, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type)] + [pa.array(c, t) for c, t in zip(columns[1:], types, strict=True)], ["key"] + names)


def audits(marked: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``faults`` rows, as a written table.

    ``gaps`` are the turns missing between the least and the greatest (0 where
    all are null), ``illegal`` the neighbouring rows whose initials are not su,
    ua or au. ``audit`` has the initials of the cheapest edits (Keep, Rerole,
    Delete, Insert) in order that give initials ``(s?(ua)+)?``, the ASCII-least
    of equally cheap ones."""
    kind = marked.schema["key"].dataType.simpleString()
    order = ["key", "turn", "role", "mark", "nth"]
    pieces = (marked.select(*order, "initial", "fault", "symbol").repartitionByRange(*order).sortWithinPartitions(*order)
              .select("key", "turn", "initial", "fault", "symbol")
              .mapInArrow(_pieces, f"key {kind}, piece int, first_turn long, last_turn long, least long, most long, turns long, "
                                   "blank long, duplicate long, truncated long, illegal long, first string, last string, symbols string"))
    joined = F.expr("""aggregate(p, named_struct('illegal', 0L, 'last', CAST(NULL AS string), 'again', 0L, 'turn', CAST(NULL AS long)),
        (a, x) -> named_struct(
            'illegal', a.illegal + x.illegal + IF(a.last IS NULL OR concat(a.last, x.first) IN ('su', 'ua', 'au'), 0L, 1L),
            'last', x.last, 'again', a.again + IF(a.turn = x.first_turn, 1L, 0L), 'turn', x.last_turn))""")
    whole = (pieces.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("piece", "first_turn", "last_turn", "illegal", "first", "last", "symbols"))).alias("p"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.sum("turns").alias("turns"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
        .withColumn("j", joined)
        .select("key", F.coalesce(F.col("most") - F.col("least") + 1 - (F.col("turns") - F.col("j.again")), F.lit(0)).alias("gaps"),
                "blank", "duplicate", "truncated", F.col("j.illegal").alias("illegal"),
                F.array_join(F.transform("p", lambda x: x["symbols"]), "").alias("symbols")))
    whole = written(whole, "conversation-symbols")
    cheapest = written(cheapest_edits(whole), "conversation-edits")
    return written(whole.join(cheapest, "symbols").select(
        "key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), "conversation-audits")


# -- the repaired rows ------------------------------------------------------

def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows after the edits; a conversation's audit comes before its rows."""
    now, letters, at, state, place = None, None, 0, START, 0
    out: list[tuple] = []

    def inserted() -> None:
        nonlocal at, state, place
        while at < len(letters) and letters[at] == "I":
            role, state = FORCED[state]
            out.append((now, place, "I", role, ""))
            at, place = at + 1, place + 1

    for batch in batches:
        kind = batch.column(0).type
        for key, audit, role, text, initial in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if audit is not None:
                if letters is not None:
                    inserted()
                now, letters, at, state, place = key, audit, 0, START, 0
                continue
            inserted()
            letter, at = letters[at], at + 1
            if letter == "D":
                continue
            if letter == "K":
                state = KEEP[state, initial]
            else:
                role, state = FORCED[state]
            out.append((now, place, letter, role, text))
            place += 1
        if out:
            yield _batch(out, kind, ["place", "edit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()])
            out = []
    if letters is not None:
        inserted()
    if out:
        yield _batch(out, kind, ["place", "edit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()])


def repaired(marked: DataFrame, edits: DataFrame) -> DataFrame:
    """(key, place, edit, role, text): the rows of every conversation after its edits, inserted ones with an empty text.

    ``marked`` comes from ``faults`` and ``edits`` from ``audits``. A conversation's
    rows are next to each other and in order in one partition."""
    kind = marked.schema["key"].dataType.simpleString()
    none = F.lit(None).cast("string")
    both = (edits.select("key", "audit", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("mark"), none.alias("text"),
                         F.lit(0).alias("nth"), none.alias("initial"), F.lit(0).alias("kind"))
            .unionByName(marked.select("key", none.alias("audit"), "turn", "role", "mark", "text", "nth", "initial", F.lit(1).alias("kind"))))
    return (both.repartition("key").sortWithinPartitions("key", "kind", "turn", "role", "mark", "nth")
            .select("key", "audit", "role", "text", "initial")
            .mapInArrow(_replayed, f"key {kind}, place long, edit string, role string, text string"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None
    for batch in batches:
        kind, out = batch.column(0).type, []
        for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if digest is None or key != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if out:
            yield _batch(out, kind, ["sha256"], [pa.string()])
    if digest is not None:
        yield _batch([(now, digest.hexdigest())], kind, ["sha256"], [pa.string()])


def digests(rows: DataFrame) -> DataFrame:
    """(key, sha256): lowercase SHA-256 of each conversation's ``role:text`` lines; ``rows`` as ``repaired`` leaves them."""
    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "role", "text").mapInArrow(_digested, f"key {kind}, sha256 string")


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of every conversation in ``rows``.

    Rows without a key are one conversation; other columns are not read; an
    empty table gives no rows. ``sha256`` is that of the repaired lines, of the
    empty string where no row is left."""
    marked = faults(rows, key, turn, role, text)
    edits = audits(marked)
    hashed = digests(repaired(marked, edits)).withColumnRenamed("key", "k")
    return (edits.join(hashed, F.col("key").eqNullSafe(F.col("k")), "left").drop("k")
            .withColumn("sha256", F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest()))))
