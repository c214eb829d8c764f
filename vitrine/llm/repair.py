"""Conversation structure repair: the cheapest edits that give a conversation the role order ``(s?(ua)+)?``.

Edits of a message: Keep costs 0, Rerole (to user or assistant) 3, Delete 4 (a blank or repeated message
must go); Insert an empty user or assistant message anywhere, 3. A truncated message that stays adds 3.
What has been put out so far is one of four states, and each edit leads to one state:

    start --s--> s --u--> u <--> a        done at start or at a

so an audit, the edits' initials in order, names one repair, and of the cheapest the ASCII-least is taken.

The costs to go from the four states, less their smallest, form one of a few vectors (an insertion bounds
how far they can lie apart). By the method of the Four Russians, what every block of ``BLOCK`` messages
makes of every such vector is worked out once (``Tables``), and a conversation is read from its end,
a block at a lookup. A block is expanded, again from its end, only when its edits are wanted: they are
then chosen forward, the least initial that still leads to the least cost, so ties are safe.

Long conversations are cut into chunks of ``CHUNK`` messages. A chunk is a function of the vector behind
it, and of the state before it; functions are composed up and down a tree of chunks, so that no task
holds more than ``FAN`` chunks of a conversation.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import index_within_group
from ..session import ship_package
from .common import slices, stored

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SPACE = " \t\n\x0b\f\r"
BLOCK = 4                                    # messages of a table's block
CHUNK = 4096                                 # messages of a chunk
FAN = 4096                                   # chunks that one task composes
PIECE_BYTES = 8 << 20                        # of repaired text handed on at once

# A message's symbol: three times its role's initial (system, user, assistant, other) plus 0, or 1 if
# truncated, or 2 if it must go. One symbol more stands for no message.
ROLES = "sua"
SYMBOLS = 13
NOTHING = 12
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}     # by a turn put in or reroled
KEEPS = {(START, 0): AFTER_S, **{(s, 1): AFTER_U for s in (START, AFTER_S, AFTER_A)}, (AFTER_U, 2): AFTER_A}
PUT_IN = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}                # neighbouring roles
ENDS = (0, 2 * INSERT, INSERT, 0)            # costs to go behind the last message


def costs_before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go from each state in front of a message, from those behind it."""
    if symbol == NOTHING:
        return tuple(behind)
    role, kind = divmod(symbol, 3)
    cost = []
    for state in range(4):
        options = [DELETE + behind[state]]
        if kind != 2:
            late = TRUNCATED if kind == 1 else 0
            options.append(REROLE + late + behind[NEXT[state]])
            if (state, role) in KEEPS:
                options.append(late + behind[KEEPS[state, role]])
        cost.append(min(options))
    for _ in range(3):                       # insertions in front of it
        cost = [min(cost[s], INSERT + cost[NEXT[s]]) for s in range(4)]
    return tuple(cost)


class Tables:
    """The normalised vectors, and for every block of symbols (by its number to the base ``SYMBOLS``, the
    first message highest) the vector in front of it and the cost added, for each vector behind it."""

    def __init__(self, size: int = BLOCK):
        low = min(ENDS)
        self.vectors = [tuple(c - low for c in ENDS)]
        place, step, cost = {self.vectors[0]: 0}, [], []
        for vector in self.vectors:          # grows until closed
            to, add = [], []
            for symbol in range(SYMBOLS):
                before = costs_before(symbol, vector)
                low = min(before)
                shape = tuple(c - low for c in before)
                if shape not in place:
                    place[shape] = len(self.vectors)
                    self.vectors.append(shape)
                to.append(place[shape])
                add.append(low)
            step.append(to)
            cost.append(add)
        one_to, one_add = np.array(step, np.int16).T, np.array(cost, np.int64).T       # symbol x vector
        self.size, self.to, self.add = 1, one_to, one_add
        while self.size < size:              # one message more in front of each block
            ahead_to, ahead_add = one_to[:, self.to], one_add[:, self.to]              # symbol x block x vector
            n = len(self.vectors)
            self.add = (ahead_add + self.add[None]).reshape(-1, n)
            self.to = ahead_to.reshape(-1, n)
            self.size += 1

    def blocks_of(self, symbols: np.ndarray) -> np.ndarray:
        """The numbers of a run's blocks, filled up at its end with symbols of no message."""
        padded = np.full(-(-max(1, len(symbols)) // self.size) * self.size, NOTHING, np.int64)
        padded[:len(symbols)] = symbols
        return padded.reshape(-1, self.size) @ (SYMBOLS ** np.arange(self.size - 1, -1, -1))

    def through(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector in front, cost added) of a whole run, for each vector behind it."""
        at = np.arange(len(self.vectors))
        total = np.zeros(len(at), np.int64)
        for block in self.blocks_of(symbols)[::-1]:
            total += self.add[block, at]
            at = self.to[block, at]
        return at, total

    def trace(self, symbols: np.ndarray, behind: int, state: int, last: bool) -> tuple[str, int]:
        """(edits, state behind the run) from a state in front of it, the least of the cheapest. ``last``:
        the conversation ends with the run, and what must be put in there is part of it."""
        numbers = self.blocks_of(symbols)
        at, entering = behind, []
        for block in numbers[::-1]:          # the vector behind each block, by lookup
            entering.append(at)
            at = int(self.to[block, at])
        edits: list[str] = []
        for i, vector in enumerate(entering[::-1]):
            part = symbols[i * self.size:(i + 1) * self.size].tolist()
            costs = [self.vectors[vector]]
            for symbol in part[::-1]:        # the block expanded from its end
                costs.append(costs_before(symbol, costs[-1]))
            costs.reverse()
            for k, symbol in enumerate(part):
                state = self._edit(symbol, state, costs[k], costs[k + 1], edits)
        if last:
            while state in (AFTER_S, AFTER_U):
                edits.append("I")
                state = NEXT[state]
        return "".join(edits), state

    @staticmethod
    def _edit(symbol: int, state: int, here: tuple[int, ...], behind: tuple[int, ...], edits: list[str]) -> int:
        """Add the edits at one message, insertions in front of it included; the state behind it."""
        role, kind = divmod(symbol, 3)
        late = TRUNCATED if kind == 1 else 0
        while True:
            if here[state] == DELETE + behind[state]:
                edits.append("D")
                return state
            if here[state] == INSERT + here[NEXT[state]]:
                edits.append("I")
                state = NEXT[state]
                continue
            kept = KEEPS.get((state, role)) if kind != 2 else None
            if kept is not None and here[state] == late + behind[kept]:
                edits.append("K")
                return kept
            edits.append("R")
            return NEXT[state]


@lru_cache(maxsize=1)
def tables() -> Tables:
    """Worked out once in each Python worker: a few vectors, ``SYMBOLS ** BLOCK`` blocks."""
    return Tables()


# ---- faults and symbols, as columns

def stripped(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def numbered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, same, pos): pos counts from 0 within the conversation, by turn (nulls
    first), then role, then a hash of the text; equal messages are neighbours. A conversation that holds
    a large share of the rows spreads over tasks, equal messages too (the last key tells them apart)."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = (rows.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
            .withColumn("salt", F.monotonically_increasing_id())
            .withColumn("has_id", F.col("conv_id").isNotNull()).withColumn("conv_id", F.coalesce("conv_id", F.lit(0)))
            .withColumn("has_turn", F.col("turn").isNotNull()).withColumn("turn", F.coalesce("turn", F.lit(0))))
    ids = ["has_id", "conv_id"]
    placed = index_within_group(rows, ids, ["has_turn", "turn", "role", "same", "salt"], "pos")
    return placed.withColumn("turn", F.when(F.col("has_turn"), F.col("turn"))).drop("salt", "has_turn")


def with_symbols(placed: DataFrame) -> DataFrame:
    """The numbered messages' (has_id, conv_id, pos, turn, fault, symbol letter): the first that holds of
    blank, duplicate (an earlier message has its role and text), truncated."""
    ids = ["has_id", "conv_id"]
    rows = placed.select(*ids, "pos", "turn", "same", F.substring("role", 1, 1).alias("initial"),
                         F.substring(stripped(F.col("text")), -1, 1).alias("end"))
    # one row for each different message; joined by place, of which no two are alike
    firsts = rows.groupBy(*ids, "same").agg(F.min("pos").alias("pos")).select(*ids, "pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("end") == "", "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.col("end").isin(".", "!", "?"), "truncated"))
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    role = F.coalesce(*[F.when(F.col("initial") == r, i) for i, r in enumerate(ROLES)], F.lit(len(ROLES)))
    return (rows.join(firsts, [*ids, "pos"], "left").withColumn("fault", fault)
            .select(*ids, "pos", "turn", "fault", F.char(F.lit(ord("A")) + 3 * role + kind).alias("letter")))


def symbols_of(letters: str) -> np.ndarray:
    return np.frombuffer(letters.encode("ascii"), np.uint8).astype(np.int64) - ord("A")


def chunked(rows: DataFrame) -> DataFrame:
    """(has_id, conv_id, chunk, letters): the symbols of ``CHUNK`` messages in order."""
    run = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    return (rows.groupBy("has_id", "conv_id", F.floor(F.col("pos") / CHUNK).alias("chunk"))
            .agg(F.concat_ws("", F.transform(run, lambda x: x["letter"])).alias("letters")))


# ---- chunks of a conversation as functions, composed along a tree

def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _map_rows(df: DataFrame, make, schema: str) -> DataFrame:
    """``make`` from a dict of a row to dicts, in Arrow batches."""
    ship_package(df.sparkSession)
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [x for row in batch.slice(at, 256).to_pylist() for x in make(row)]
                if found:
                    yield pa.RecordBatch.from_pylist(found, out)

    return df.mapInArrow(run, schema)


def arriving(nodes: DataFrame, start: int, backward: bool) -> DataFrame:
    """(has_id, conv_id, chunk, value): what reaches each node of ``nodes(has_id, conv_id, chunk, f)``, where
    ``f[v]`` is what leaves it if ``v`` reaches it, and ``start`` enters each conversation (at its last chunk
    if ``backward``). Functions of ``FAN`` neighbours are composed to one until one is left, and values are
    handed down again: two shuffles a level, of rows with a short array."""
    ids = ["has_id", "conv_id"]
    top = nodes.agg(F.max("chunk")).first()[0]
    if not top:
        return nodes.select(*ids, "chunk", F.lit(start).alias("value"))
    rows = F.array_sort(F.collect_list(F.struct("chunk", "f")))
    runs = nodes.groupBy(*ids, F.floor(F.col("chunk") / FAN).alias("above")).agg(rows.alias("run"))

    def compose(row: dict):
        run = row["run"][::-1] if backward else row["run"]
        value = list(range(len(run[0]["f"])))
        for node in run:
            value = [node["f"][v] for v in value]
        yield {"has_id": row["has_id"], "conv_id": row["conv_id"], "chunk": row["above"], "f": value}

    def hand_down(row: dict):
        value = row["value"]
        for node in row["run"][::-1] if backward else row["run"]:
            yield {"has_id": row["has_id"], "conv_id": row["conv_id"], "chunk": node["chunk"], "value": value}
            value = node["f"][value]

    above = stored(_map_rows(runs, compose, "has_id boolean, conv_id long, chunk long, f array<int>"), "composed")
    reached = arriving(above, start, backward).withColumnRenamed("chunk", "above")
    return _map_rows(runs.join(reached, [*ids, "above"]), hand_down,
                     "has_id boolean, conv_id long, chunk long, value int")


def traced(chunks: DataFrame) -> DataFrame:
    """(has_id, conv_id, chunk, end, edits, state, cost, illegal): each chunk's edits and the state in front of
    them, the number of the conversation's last chunk, and the chunk's share of the cost of the
    conversation's repair and of its neighbours whose roles don't alternate."""
    ids, base = ["has_id", "conv_id"], "has_id boolean, conv_id long, chunk long"

    def functions(row: dict):
        symbols = symbols_of(row["letters"])
        to, add = tables().through(symbols)
        roles = (symbols // 3).tolist()
        illegal = sum((a, b) not in LEGAL for a, b in zip(roles, roles[1:]))
        yield {**row, "f": to.tolist(), "added": add.tolist(), "illegal": illegal, "first": roles[0], "final": roles[-1]}

    made = stored(_map_rows(chunks, functions, f"{base}, letters string, f array<int>, added array<long>, illegal long, "
                                               "first int, final int"), "chunks")
    ends = made.groupBy(*ids).agg(F.max("chunk").alias("end"))
    ahead = made.select(*ids, (F.col("chunk") + 1).alias("chunk"), F.col("final").alias("before"))
    known = (made.join(arriving(made.select(*ids, "chunk", "f"), 0, backward=True), [*ids, "chunk"])
             .join(ahead, [*ids, "chunk"], "left").join(ends, ids))

    def variants(row: dict):
        symbols, last = symbols_of(row["letters"]), row["chunk"] == row["end"]
        # in front of a first chunk there is one state
        found = [tables().trace(symbols, row["value"], s, last) if s == START or row["chunk"] else ("", s) for s in range(4)]
        in_front = tables().vectors[row["f"][row["value"]]][START]
        apart = row["before"] is not None and (row["before"], row["first"]) not in LEGAL
        yield {**{c: row[c] for c in (*ids, "chunk", "end")}, "edits": [e for e, _ in found], "f": [s for _, s in found],
               "cost": row["added"][row["value"]] + (0 if row["chunk"] else in_front), "illegal": row["illegal"] + apart}

    each = stored(_map_rows(known, variants, f"{base}, end long, edits array<string>, f array<int>, cost long, illegal long"),
                  "variants")
    states = arriving(each.select(*ids, "chunk", "f"), START, backward=False)
    return stored(each.join(states, [*ids, "chunk"])
                  .select(*ids, "chunk", "end", F.get("edits", F.col("value")).alias("edits"),
                          F.col("value").alias("state"), "cost", "illegal"), "edits")


# ---- texts

def _edited(rows: Iterator[dict]) -> Iterator[tuple[dict, list[tuple[str, str, str]]]]:
    """(row, the messages that it leaves) in order, for rows that begin with a chunk's edits (pos -1) and go on
    with its messages. A message is (edit, role, text). Insertions behind the last message come with the
    next chunk's edits or at the end, with the row of their own chunk."""
    plan, edits, state = None, iter(()), START

    def put_in(edits: Iterator[str], state: int) -> Iterator[tuple[str, str, str]]:
        for _ in edits:
            state = NEXT[state]
            yield "I", PUT_IN[state], ""

    for row in rows:
        if row["pos"] < 0:
            if plan is not None:
                yield plan, list(put_in(edits, state))
            plan, edits, state = row, iter(row["edits"]), row["state"]
            yield row, []
            continue
        left, edit = [], next(edits)
        while edit == "I":
            state = NEXT[state]
            left.append(("I", PUT_IN[state], ""))
            edit = next(edits)
        if edit == "K":
            state = KEEPS[state, ROLES.index(row["role"][0])]
            left.append(("K", row["role"], row["text"]))
        elif edit == "R":
            state = NEXT[state]
            left.append(("R", PUT_IN[state], row["text"]))
        yield row, left
    if plan is not None:
        yield plan, list(put_in(edits, state))


def _by_chunk(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """Messages, behind a row with their chunk's edits, chunk by chunk in order."""
    ids = ["has_id", "conv_id"]
    plan = edits.select(*ids, "chunk", F.lit(-1).cast("long").alias("pos"), "end", "edits", "state",
                        *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))])
    rows = placed.select(*ids, F.floor(F.col("pos") / CHUNK).alias("chunk"), "pos",
                         *[F.lit(None).cast(t).alias(c) for c, t in (("end", "long"), ("edits", "string"), ("state", "int"))],
                         "turn", "role", "text")
    ship_package(placed.sparkSession)
    return plan.union(rows).repartition(*ids, "chunk").sortWithinPartitions(*ids, "chunk", "pos")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in slices(batch):
            for at in range(0, part.num_rows, 256):
                yield from part.slice(at, 256).to_pylist()


def _hashes(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """(has_id, conv_id, repaired_sha256). A conversation of one chunk is hashed where its chunk is. Of a longer
    one the chunks are made into pieces of repaired text side by side; only the digest itself, which can't
    be split, runs over all of them in one task, a piece at a time."""
    ids = ["has_id", "conv_id"]
    schema = "has_id boolean, conv_id long, chunk long, part int, piece binary, repaired_sha256 string"
    names = [*ids, "chunk", "part", "piece", "repaired_sha256"]

    def record(*values) -> pa.RecordBatch:
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, part, held, size, whole = None, 0, [], 0, True

        def done() -> pa.RecordBatch:
            text = b"".join(held)
            return record(plan["has_id"], plan["conv_id"], plan["chunk"], part, None if whole else text,
                          hashlib.sha256(text[:-1]).hexdigest() if whole else None)

        for row, left in _edited(_rows(batches)):
            if row["pos"] < 0 and row is not plan:
                if held:
                    yield done()
                plan, part, held, size, whole = row, 0, [], 0, not row["end"]
            for _, role, text in left:
                if size >= PIECE_BYTES:
                    whole = False
                    yield done()
                    part, held, size = part + 1, [], 0
                held.append(f"{role}:{text}\n".encode())
                size += len(held[-1])
        if held:
            yield done()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, run = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                has_id, conv_id, piece = (batch.column(c)[at].as_py() for c in range(3))
                if (has_id, conv_id) != here:
                    if here is not None:
                        yield record(*here, 0, 0, None, run.hexdigest())
                    here, run = (has_id, conv_id), hashlib.sha256()
                    run.update(piece[:-1])
                else:
                    run.update(b"\n" + piece[:-1])
        if here is not None:
            yield record(*here, 0, 0, None, run.hexdigest())

    made = stored(_by_chunk(placed, edits).mapInArrow(pieces, schema), "pieces")
    long = (made.filter("piece is not null").repartition(*ids).sortWithinPartitions(*ids, "chunk", "part")
            .select(*ids, "piece").mapInArrow(digests, schema))
    return made.filter("piece is null").union(long).select(*ids, "repaired_sha256")


def repaired_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, chunk, place, edit, turn, role, text): the repaired conversations; chunk and place give the order,
    edit is K, R or I, and turn is null where the message is put in. For empty and odd input see ``repair``."""
    placed = numbered(messages)
    edits = traced(chunked(with_symbols(placed)))

    schema = "conv_id long, chunk long, place long, edit string, turn long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = 0, []
        for row, left in _edited(_rows(batches)):
            if row["pos"] < 0 and not left:
                place = 0
            for edit, role, text in left:
                held.append({"conv_id": row["conv_id"] if row["has_id"] else None, "chunk": row["chunk"], "place": place, "edit": edit,
                             "turn": None if edit == "I" else row["turn"], "role": role, "text": text})
                place += 1
            if len(held) >= 256:
                yield pa.RecordBatch.from_pylist(held, out)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, out)

    out = _arrow_schema(schema)
    return _by_chunk(placed, edits).mapInArrow(run, schema)


def repair(messages: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each
    conversation of ``messages(conv_id, turn, role, text)``, and of ``conversations(conv_id)`` if given.

    Messages are taken by turn, nulls first; those of one turn by role, then by a hash of their text. A null
    role or text is one space, so the text is blank and the role fits no place; an empty role fits none
    either. Null ids are one conversation. gaps is null where the turns lie further apart than a long
    holds. Repeated rows are duplicates. A conversation without messages has zeros, an empty audit and the
    digest of the empty text; an empty table gives no rows. Very long texts are read whole and held one
    slice at a time. Other columns are not looked at.

    The audit, and the digest, of a conversation are single values, so one task puts each together from its
    chunks; nothing else of a conversation meets in one task.
    """
    ids = ["has_id", "conv_id"]
    placed = numbered(messages)
    rows = with_symbols(placed)
    counted = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    faults = rows.groupBy(*ids).agg(*counted)
    turns = rows.groupBy(*ids, "turn").agg(F.count(F.lit(1)).alias("n")).groupBy(*ids).agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns"))
    edits = traced(chunked(rows))
    audit = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("chunk", "edits"))), lambda x: x["edits"]))
    sums = edits.groupBy(*ids).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("high", "low", "turns")]
    gaps = F.when(F.col("turns") > 0, (wide[0] - wide[1] + 1 - wide[2]).try_cast("long")).otherwise(F.lit(0).cast("long"))
    known = (faults.join(turns, ids).join(sums, ids).join(_hashes(placed, edits), ids, "left")
             .withColumn("gaps", gaps).withColumn("met", F.lit(True)))
    if conversations is None:
        conversations = messages
    every = (conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
             .select(F.col("conv_id").isNotNull().alias("has_id"), F.coalesce("conv_id", F.lit(0)).alias("conv_id")))
    none = F.lit(0).cast("long")
    out = every.join(known, ids, "left")
    return out.select(
        F.when(F.col("has_id"), F.col("conv_id")).alias("conv_id"),
        F.when(F.col("met"), F.col("gaps")).otherwise(none).alias("gaps"),
        *[F.coalesce(F.col(c), none).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
