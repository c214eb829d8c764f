"""Chat formatting: a transcript's roles by a hidden Markov model over its lines, then canonical turns.

A transcript is a text; where one message ends and the next begins it doesn't say, but for speaker markers
(``User:``, ``### Response:``, ``A:`` and the like), which may be missing. The states are a role, and whether a
line is the first of a message or a later one. A line is observed through its marker, or none, and its
shape: a question, code or a list, and its length. From a line the message goes on, or another begins;
how often, who answers whom, and what first and later lines look like is counted on labelled messages over
fixed prior counts, by which lines without a marker mostly go on. Viterbi's best path gives roles and first
lines, and lines up to the next first one are a turn.

A transcript can be of any length. It is cut into blocks of ``BLOCK`` lines by position, and a block, a byte for
each line, is summed up by the best score from each state before it to each state at its end, a max-plus
matrix. These are multiplied up a tree with ``FAN`` blocks to a node, the best path's states at the block
ends are fixed from the top down, and each block is then decoded by itself. The result is a best path of
the whole transcript (of equal paths the one with the smaller states at block ends, then within). No task
holds more than a block's lines or ``FAN`` matrices, so a turn that goes on from block to block comes in parts.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import groupby
from itertools import product as product_of

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import index_within_group
from .common import slices, stored

ROLES = ("system", "user", "assistant", "tool")
STATES = 2 * len(ROLES)                      # a role's first line of a message; len(ROLES) on, a later one
START = STATES                               # the state before a transcript
MARKERS = {"system": ("system", "system prompt", "instructions", "context"),
           "user": ("user", "human", "question", "q", "instruction", "customer", "me", "prompter"),
           "assistant": ("assistant", "ai", "bot", "answer", "a", "response", "model", "agent", "gpt"),
           "tool": ("tool", "function", "observation", "tool result")}
NAMED = {word: role for role, words in MARKERS.items() for word in words}
MARKER = re.compile(r"^\s*(?:[>*#\-\[(<|]+\s*)?(?:\*\*)?(" + "|".join(sorted(map(re.escape, NAMED), key=lambda w: (-len(w), w)))
                    + r")(?:\*\*)?\s*(?:[\])>|]+\s*:?|:)(?:\*\*)?[ \t]*", re.I)
SHAPES = ("plain", "question", "block")
LENGTHS = (0, 4, 12, 40)                     # words: none, under 4, under 12, under 40, more
CODES = list(product_of(range(1 + len(ROLES)), range(len(SHAPES)), range(len(LENGTHS) + 1)))
CODE = {seen: at for at, seen in enumerate(CODES)}
BLOCK, FAN = 256, 256
PART_BYTES = 8 << 20                         # of a turn's text handed on at once
TURN = (T.StructType().add("conv_id", "long").add("line", "long").add("role", "string").add("continues", "boolean")
        .add("content", "string").add("rendered", "string"))


def observe(line: str) -> tuple[int, int, int, str]:
    """(marker, shape, length, the line without its marker); marker 0 is none, else 1 + role."""
    found = MARKER.match(line)
    marker = 1 + ROLES.index(NAMED[found[1].lower()]) if found else 0
    rest = line[found.end():] if found else line
    text = rest.strip()
    shape = 1 if text.endswith("?") else 2 if text[:1] in ("`", "-", "*", "|", "{") or line[:4] == "    " else 0
    words = len(text.split())
    return marker, shape, sum(words >= n for n in LENGTHS), rest


class Model:
    """Log probabilities of ``move`` (from state, to state), and of marker, shape and length by state. A last state
    stands before the first line: it is left but never entered. Made from counts: of the first message's
    role, of the next message's by role, of lines that go on by role, of messages by role, and of what
    lines show by state."""

    def __init__(self, start: np.ndarray, move: np.ndarray, later: np.ndarray, messages: np.ndarray, seen: list[np.ndarray]):
        n = len(ROLES)
        first = np.array([4.0, 4, 1, 0.1])
        turns = np.array([[1, 9, 1, 0.1], [0.1, 1, 9, 0.5], [0.1, 9, 1, 0.5], [0.1, 1, 9, 1]])
        marks = np.full((STATES, 1 + n), 0.2)                        # prior counts
        marks[:n, 0], marks[n:, 0] = 10, 200                         # a later line hardly has a marker
        marks[np.arange(n), 1 + np.arange(n)] = 40
        priors = [marks, np.ones((STATES, len(SHAPES))), np.ones((STATES, len(LENGTHS) + 1))]
        go_on = ((3 + later) / (4 + later + messages))[:, None]      # mostly, if nothing is known
        answer = (turns + move) / (turns + move).sum(axis=1, keepdims=True)
        row = np.concatenate([(1 - go_on) * answer, go_on * np.eye(n)], axis=1)
        self.move = np.full((START + 1, START + 1), -np.inf)
        with np.errstate(divide="ignore"):
            self.move[:STATES, :STATES] = np.log(np.concatenate([row, row]))
        self.move[START, :n] = self._log(first + start)
        self.seen = [self._log(p + s) for p, s in zip(priors, seen)]

    @staticmethod
    def _log(counts: np.ndarray) -> np.ndarray:
        return np.log(counts / counts.sum(axis=-1, keepdims=True))

    @staticmethod
    def nothing_seen() -> list[np.ndarray]:
        return [np.zeros((STATES, n)) for n in (1 + len(ROLES), len(SHAPES), len(LENGTHS) + 1)]

    @classmethod
    def prior(cls) -> Model:
        n = len(ROLES)
        return cls(np.zeros(n), np.zeros((n, n)), np.zeros(n), np.zeros(n), cls.nothing_seen())

    @cached_property
    def by_code(self) -> list[np.ndarray]:
        """By code of a line, the score of going from one state to the next and seeing it."""
        return [self.move + np.append(self.seen[0][:, m] + self.seen[1][:, s] + self.seen[2][:, n], 0.0) for m, s, n in CODES]

    def steps(self, codes: Iterable[int]) -> Iterator[np.ndarray]:
        return (self.by_code[code] for code in codes)


def code_of(line: str) -> int:
    """What the model sees of a line: a byte."""
    return CODE[observe(line)[:3]]


def product(steps: Iterator[np.ndarray]) -> np.ndarray:
    """Best score from each state before the steps to each state after them."""
    out = None
    for m in steps:
        out = m if out is None else (out[:, :, None] + m[None]).max(axis=1)
    return out


def best_path(first: np.ndarray, steps: list[np.ndarray], last: int | None = None) -> list[int]:
    """State after each step of the best path from scores ``first``, to ``last`` if given; of equal paths
    the one with the smaller states, from the end."""
    score, back = first, []
    for m in steps:
        ways = score[:, None] + m
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    state = int(score.argmax()) if last is None else last
    path = []
    for b in reversed(back):
        path.append(state)
        state = int(b[state])
    return path[::-1]


def only(state: int) -> np.ndarray:
    """Scores of a path that must come from ``state``."""
    return np.where(np.arange(START + 1) == state, 0.0, -np.inf)


def in_runs(df: DataFrame, keys: list[str], order: list[str], each: Callable[[tuple, Iterator[tuple]], Iterator[tuple]],
            schema: T.StructType) -> DataFrame:
    """``each`` over the rows of each key, streamed in order within a task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out, n = to_arrow_schema(schema), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))))
        held: list[tuple] = []
        for key, group in groupby(rows, key=lambda r: r[:n]):
            for row in each(key, group):
                held.append(row)
                if len(held) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)

    return (df.select(*keys, *[c for c in df.columns if c not in keys]).repartition(*keys)
            .sortWithinPartitions(*keys, *order).mapInArrow(run, schema))


def lines_of(messages: DataFrame, conv_col: str, turn_col: str | None, text_col: str) -> DataFrame:
    """(conv_id, block, line, text, code): the transcripts' lines, numbered from 0, ``BLOCK`` to a block. A transcript
    is its messages by turn, nulls first, those of one turn by a hash of their text, equal ones as often;
    what message or turn a line is from is not passed on. A null text is an empty line."""
    turn = F.lit(None).cast("long") if turn_col is None else F.col(turn_col).cast("long")
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("turn"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
                       F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), F.xxhash64("text").alias("hash"),
                       F.monotonically_increasing_id().alias("salt"), F.posexplode(F.split("text", "\n")).alias("nth", "text"))
    # numbered by columns without nulls, as the numbers are joined by them; the salt parts rows that are alike
    placed = index_within_group(rows, ["none", "conv"], ["has_turn", "turn", "hash", "salt", "nth"], "line")
    placed = placed.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), F.expr(f"line div {BLOCK}").alias("block"), "line", "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                codes = pa.array([code_of(t) for t in part.column(3).to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, codes], names=[*part.schema.names, "code"])

    return placed.mapInArrow(code, T.StructType([*placed.schema.fields, T.StructField("code", T.IntegerType())]))


def blocks_of(lines: DataFrame) -> DataFrame:
    """(conv_id, block, codes): the codes of a block's lines in order."""
    run = F.array_sort(F.collect_list(F.struct("line", "code")))          # at most BLOCK
    return lines.groupBy("conv_id", "block").agg(F.transform(run, lambda x: x["code"]).alias("codes"))


def fit(labelled: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
        text_col: str = "text") -> Model:
    """Counts over messages with a known role; repeated rows count as often. Only counts come to the
    driver: one row for each pair of roles and each observation."""
    rows = (labelled.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                            F.lower(role_col).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .filter(F.col("role").isin(*ROLES)))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(role, int(nth > 0), *observe(line)[:3]) for role, text in zip(*(c.to_pylist() for c in batch.columns))
                   for nth, line in enumerate(text.split("\n"))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string() if not i else pa.int32())
                                              for i in range(5)], names=["role", "later", "marker", "shape", "length"])

    names = ["role", "later", "marker", "shape", "length"]
    counted = (rows.select("role", "text").mapInArrow(seen, "role string, later int, marker int, shape int, length int")
               .groupBy(*names).count().collect())
    model, count = Model.nothing_seen(), np.zeros((2, len(ROLES)))
    for role, later, *found, n in counted:
        at = ROLES.index(role)
        count[later, at] += n
        for table, value in zip(model, found):
            table[at + later * len(ROLES), value] += n
    turns = rows.select("conv_id", "turn", "role").distinct()
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    move, start = np.zeros((len(ROLES),) * 2), np.zeros(len(ROLES))
    for role, following, n in turns.join(after, ["conv_id", "turn"]).groupBy("role", "next").count().collect():
        move[ROLES.index(role), ROLES.index(following)] = n
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role")).alias("f")).groupBy("f.role").count()
    for role, n in first.collect():
        start[ROLES.index(role)] = n
    return Model(start, move, count[1], count[0], model)


def block_ends(blocks: DataFrame, model: Model, fan: int = FAN) -> DataFrame:
    """(conv_id, block, came, left): the best path's state before each block of ``blocks`` (null at the start
    of a transcript) and at its end."""
    n = START + 1
    level = T.StructType().add("conv_id", "long").add("block", "long").add("m", T.ArrayType(T.DoubleType()))
    ends = T.StructType().add("conv_id", "long").add("block", "long").add("came", "integer").add("left", "integer")

    def block_matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [product(model.steps(codes)).ravel() for codes in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(m, pa.list_(pa.float64()))], names=level.names)

    def node_matrix(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        yield (*key, product(np.array(r[3]).reshape(n, n) for r in rows).ravel().tolist())

    def down(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        rows = list(rows)                    # at most fan children, after their parent's ends
        came, left = None, None
        if rows[0][2] is None:
            came, left = rows.pop(0)[4:6]
        path = best_path(only(START if came is None else came), [np.array(r[3]).reshape(n, n) for r in rows], left)
        for r, a, b in zip(rows, [came, *path], path):
            yield key[0], r[2], a, b

    levels = [stored(blocks.select("conv_id", "block", "codes").mapInArrow(block_matrix, level), "chat-matrices")]
    while not levels[-1].groupBy("conv_id").count().filter(F.col("count") > fan).isEmpty():
        up = levels[-1].select("conv_id", F.expr(f"cast(floor(block / {fan}) as bigint)").alias("up"), "block", "m")
        levels.append(stored(in_runs(up, ["conv_id", "up"], ["block"], node_matrix, level), "chat-nodes"))
    none = F.lit(None)
    top = levels.pop().select("conv_id", F.lit(0).cast("long").alias("up"), "block", "m",
                              none.cast("int").alias("came"), none.cast("int").alias("left"))
    fixed = in_runs(top, ["conv_id", "up"], ["block"], down, ends)
    while levels:
        parents = stored(fixed, "chat-ends").select("conv_id", F.col("block").alias("up"), none.cast("long").alias("block"),
                                                    none.cast("array<double>").alias("m"), "came", "left")
        below = levels.pop().select("conv_id", F.expr(f"cast(floor(block / {fan}) as bigint)").alias("up"), "block", "m",
                                    none.cast("int").alias("came"), none.cast("int").alias("left"))
        fixed = in_runs(below.union(parents), ["conv_id", "up"], ["block"], down, ends)
    return fixed


def render(role: str, content: str, begins: bool, ends: bool) -> str:
    """A turn, or a part of one, in canonical form: parts follow one another without a sign between them. The
    marks of the form are broken where a text has them itself."""
    content = content.replace("<|im_", "<| im_")
    return (f"<|im_start|>{role}\n" if begins else "\n") + content + ("<|im_end|>\n" if ends else "")


def decoded(blocks: DataFrame, model: Model) -> DataFrame:
    """(conv_id, block, states binary, ends): the best path's state of each line, and whether the block's
    last turn ends with it."""
    out = T.StructType().add("conv_id", "long").add("block", "long").add("states", "binary")
    known = stored(blocks, "chat-blocks")
    # a transcript of one block needs no matrices
    many = known.filter("block > 0").select(F.col("conv_id").alias("_conv")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    short = known.join(many, same, "left_anti").select("*", *[F.lit(None).cast("int").alias(c) for c in ("came", "left")])
    long = stored(known.join(many, same, "left_semi"), "chat-long")
    if not long.isEmpty():
        ends = block_ends(long, model).select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "came", "left")
        short = short.union(long.join(ends, same & (F.col("block") == F.col("_block"))).select("conv_id", "block", "codes", "came", "left"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [bytes(best_path(only(START if came is None else came), list(model.steps(codes)), left))
                     for codes, came, left in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(paths, pa.binary())], names=out.names)

    found = stored(short.mapInArrow(decode, out), "chat-states")
    # a block whose first line is a later one goes on with the turn before
    on = (found.filter(F.conv(F.hex(F.substring("states", 1, 1)), 16, 10).cast("int") >= len(ROLES))
          .select(F.col("conv_id").alias("_conv"), (F.col("block") - 1).alias("_block"), F.lit(False).alias("_ends")))
    return (found.join(on, same & (F.col("block") == F.col("_block")), "left")
            .select("conv_id", "block", "states", F.coalesce("_ends", F.lit(True)).alias("ends")))


def canonical_turns(conversations: DataFrame, model: Model | None = None, conv_col: str = "conv_id", turn_col: str | None = "turn",
                    text_col: str = "text") -> DataFrame:
    """(conv_id, line, role, continues, content, rendered) of each canonical turn, ``line`` the number of its first
    line in the transcript.

    The messages of a conversation are one transcript, in order of turn, ties by a hash of the text; it is
    parsed by its lines alone. A turn of more than a block, or of ``PART_BYTES``, comes in parts, of which all but the
    first have ``continues``; put together by line the rendered parts are the canonical transcript. A null
    turn comes first; a null or empty text is an empty line, which has a role; rows with a null
    conversation are one; repeated rows are repeated lines. A very long line is held whole, other lines a block
    at a time. An empty table gives none; other columns, a role among them, are not looked at.
    """
    model = model or Model.prior()
    lines = stored(lines_of(conversations, conv_col, turn_col, text_col), "chat-lines")
    none = F.lit(None)
    plan = decoded(blocks_of(lines), model).select("conv_id", "block", F.lit(-1).cast("long").alias("line"),
                                                   none.cast("string").alias("text"), "states", "ends")
    both = plan.union(lines.select("conv_id", "block", "line", "text", none.cast("binary"), none.cast("boolean")))

    def write(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        *_, states, ends = next(rows)        # a block's states stand before its lines
        held, size, role, first, begins = [], 0, None, None, False

        def turn(last: bool) -> tuple:
            text = "\n".join(held)
            text = text.lstrip() if begins else text
            text = text.rstrip() if last else text
            return key[0], first, ROLES[role], not begins, text, render(ROLES[role], text, begins, last)

        for state, (_, _, line, text, *_) in zip(states, rows, strict=True):
            opens = state < len(ROLES)
            if held and (opens or size >= PART_BYTES):
                yield turn(opens)
                held, size = [], 0
            if not held:
                role, first, begins = state % len(ROLES), line, opens
            held.append(observe(text)[3] if opens else text)
            size += len(text)
        if held:
            yield turn(ends)

    return in_runs(both, ["conv_id", "block"], ["line"], write, TURN)


def parse_transcripts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """Canonical turns of transcripts that are one text each (several of one id: one after the other)."""
    return canonical_turns(docs, model, id_col, None, text_col)
