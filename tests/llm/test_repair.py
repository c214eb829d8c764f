import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from vitrine.llm import queries, repair as r

SPACE = " \t\n\x0b\f\r"


def slow_audit(messages):
    """The cheapest, then ASCII-least edits by trying every one: (cost, audit) from each state, from the end."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    turn = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(g):
        for _ in range(4):
            g = {s: min(g[s], (g[turn[s]][0] + 3, "I" + g[turn[s]][1])) for s in g}
        return g

    big = (10 ** 9, "")
    g = with_inserts({0: (0, ""), 1: big, 2: big, 3: (0, "")})
    for role, fault in reversed(messages):
        new = {}
        for s in range(4):
            options = [(4 + g[s][0], "D" + g[s][1])]
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                options.append((3 + late + g[turn[s]][0], "R" + g[turn[s]][1]))
                if role[:1] in after[s]:
                    to = after[s][role[:1]]
                    options.append((late + g[to][0], "K" + g[to][1]))
            new[s] = min(options)
        g = with_inserts(new)
    return g[0]


def slow_rows(conversations):
    """The contract, a conversation at a time."""
    every = defaultdict(list)
    for conv, turn, role, text in conversations:
        rows = every[conv]
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        how = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2], shown[3]
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            rows += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    out = {}
    for conv, rows in every.items():
        size = lambda x: hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).hexdigest()       # noqa: E731
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), size(x)))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = slow_audit([(x[1], f) for x, f in zip(rows, faults)])
        lines, at = [], iter(rows)
        for edit in audit:
            if edit == "I":
                last = lines[-1][0] if lines else ""
                lines.append("assistant:" if last == "u" else "user:")
                continue
            _, role, text = next(at)
            if edit == "K":
                lines.append(f"{role}:{text}")
            elif edit == "R":
                last = lines[-1][0] if lines else ""
                lines.append(("assistant:" if last == "u" else "user:") + text)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def as_map(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({x[0] for x in rows}) == len(rows)
    return {x[0]: tuple(x[1:]) for x in rows}


def letters(messages):
    kind = {"": 0, "truncated": 1, "blank": 2, "duplicate": 2}
    return r.symbols_of("".join(chr(65 + 3 * ("sua".find(role[:1]) if role[:1] in tuple("sua") else 3) + kind[f])
                                for role, f in messages))


@pytest.mark.parametrize("size", [1, 2, 4])
def test_tables_against_every_edit(size):
    rng, tables = random.Random(size), r.Tables(size)
    for _ in range(400):
        messages = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["", "", "truncated", "blank"]))
                    for _ in range(rng.randint(0, 11))]
        cost, audit = slow_audit(messages)
        symbols = letters(messages)
        to, add = tables.through(symbols)
        assert add[0] + tables.vectors[to[0]][r.START] == cost
        assert tables.trace(symbols, 0, r.START, True) == (audit, 3 if set(audit) - {"D"} else 0)


def test_vectors_are_closed_and_normal():
    tables = r.tables()
    assert min(map(min, tables.vectors)) == 0 and len(set(tables.vectors)) == len(tables.vectors)
    assert all(min(v) == 0 for v in tables.vectors) and tables.to.max() < len(tables.vectors)


def test_given_table(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = slow_rows(conversations.select("conv_id", "turn", "role", "text").collect())
    assert as_map(queries.op12_repair(spark, "/root/testdata/sf0.01")) == want


def odd_rows():
    rng = random.Random(5)
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi there!"), (1, 2, "assistant", "Hello."), (None, None, None, None),
            (None, 3, "user", "No id."), (2, None, "user", "One?"), (2, None, "user", "One?"), (2, 5, "", "No role."),
            (3, 0, "user", ""), (3, 1, "user", " \t\n"), (4, 7, "tool", "x" * 300_000), (4, 9, "usher", "ends. \n"),
            (5, -(1 << 40), "user", "far."), (5, 1 << 40, "assistant", "near　"), (6, 0, "assistant", "é\U0001f642.")]
    words = ["Yes.", "No.", "and so", "", "Why?", "Good!"]
    rows += [(10 + i % 40, rng.choice([None, *range(9)]), rng.choice(["system", "user", "assistant", "tool"]), rng.choice(words))
             for i in range(400)]
    return rows


def test_odd_rows_and_clashing_names(spark):
    rows = odd_rows()
    names = ["pos", "chunk", "letters", "edits", "state", "same", "salt", "has_id", "f", "value"]
    df = spark.createDataFrame([(*x, *["z"] * len(names)) for x in rows],
                               "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in names))
    assert as_map(r.repair(queries.damaged(df), df)) == slow_rows(rows)


def test_long_conversations_are_cut(spark, monkeypatch):
    """Chunks of 5 messages, 3 of them to a composition, pieces of 40 bytes: the same rows."""
    monkeypatch.setattr(r, "CHUNK", 5)
    monkeypatch.setattr(r, "FAN", 3)
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), f"Message {i if i % 5 else 1}{rng.choice(['.', '', '?'])}") for i in range(230)]
    rows += [(8, 0, "user", "Short."), (8, 1, "assistant", "Yes."), (9, 0, "tool", "Alone.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert as_map(r.repair(queries.damaged(df), df)) == slow_rows(rows)


def test_repaired_messages(spark):
    rows = odd_rows()
    df = queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = defaultdict(list)
    for x in sorted(r.repaired_messages(df).collect(), key=lambda x: (x.chunk, x.place)):
        found[x.conv_id].append(f"{x.role}:{x.text}")
    want = {c: v[-1] for c, v in slow_rows(rows).items()}
    for conv, sha in want.items():
        assert hashlib.sha256("\n".join(found[conv]).encode()).hexdigest() == sha


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert r.repair(queries.damaged(df), df).collect() == []
    one = spark.createDataFrame([(3,)], "conv_id long")
    assert as_map(r.repair(df, one)) == {3: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_hot_conversation_spreads(spark):
    """A third of the rows in one conversation, half of these alike with a null turn: no task gets the lot."""
    from pyspark.sql import functions as F

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("conv_id"),
        F.when(F.col("id") % 6 != 0, F.col("id")).alias("turn"), F.lit("user").alias("role"),
        F.when(F.col("id") % 6 == 0, "Same.").otherwise(F.concat(F.lit("Text "), F.col("id").cast("string"), F.lit("."))).alias("text"))
    placed = r.numbered(df)
    sizes = [x["count"] for x in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    row = r.repair(df).filter("conv_id = 0").first()
    assert row["duplicate"] == 4_999 and len(row["audit"].replace("I", "")) == 10_000
