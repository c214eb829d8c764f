import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitrine.llm import chat as c
from vitrine.llm import queries


@pytest.mark.parametrize("line,marker,rest", [
    ("User: hi", 2, "hi"), ("**Assistant:** x", 3, "x"), ("### Response: y", 3, "y"), ("[human] z", 2, "z"), ("Q: why?", 2, "why?"),
    ("a: b", 3, "b"), ("System prompt: s", 1, "s"), ("no marker: here", 0, "no marker: here"), ("user said: x", 0, "user said: x"),
    ("", 0, ""), ("<|user|> q", 2, "q"), ("Aid: x", 0, "Aid: x"), ("Observation: 3", 4, "3")])
def test_markers(line, marker, rest):
    got = c.observe(line)
    assert (got[0], got[3]) == (marker, rest)


def codes(lines):
    return [c.code_of(x) for x in lines]


def score(steps, path):
    return sum(m[a, b] for m, a, b in zip(steps, (c.START, *path), path))


def test_viterbi_against_all_paths():
    from itertools import product

    model = c.Model.prior()
    for lines in (["hello", "User: x?", "more", "yes", "Bot: a"], ["System: s", "a", "b"], ["a", "b", "User: c", ""], [""]):
        steps = list(model.steps(codes(lines)))
        best = max(score(steps, p) for p in product(range(c.STATES), repeat=len(steps)))
        assert score(steps, c.best_path(c.only(c.START), steps)) == pytest.approx(best, abs=1e-9)


def test_moves_are_probabilities():
    m = c.Model.prior()
    assert m.move.shape == (9, 9) and np.isneginf(m.move[:, c.START]).all()
    assert np.allclose(np.exp(m.move[:, :c.START]).sum(axis=1), 1)
    assert np.isneginf(m.move[c.START, len(c.ROLES):]).all()          # a transcript begins with a first line
    for role in range(4):                                            # a line goes on in its own role
        assert np.isfinite(m.move[role, 4:8]).tolist() == [r == role for r in range(4)]


def turns(df):
    return [(r.line, r.role, r.content) for r in df.orderBy("conv_id", "line").collect()]


def test_lines_without_markers_go_on(spark):
    docs = spark.createDataFrame([(1, "User: a\nb\nc\nAI: d"), (2, "Human: why?\nHuman: so?\nAI: x\n\n- y\n    z\nTool: t"), (3, "a\nb")],
                                 "doc_id long, text string")
    assert turns(c.parse_transcripts(docs.filter("doc_id = 1"))) == [(0, "user", "a\nb\nc"), (3, "assistant", "d")]
    assert turns(c.parse_transcripts(docs.filter("doc_id = 2"))) == [
        (0, "user", "why?"), (1, "user", "so?"), (2, "assistant", "x\n\n- y\n    z"), (6, "tool", "t")]
    assert len(turns(c.parse_transcripts(docs.filter("doc_id = 3")))) == 1


def in_order(rows):
    """Lines by conversation as they are read: by turn, then by Spark's hash of the text."""
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), seed=42) + (1 << 63)) % (1 << 64)
    out = {}
    for conv, turn, text in sorted([(a, b, t or "") for a, b, t in rows],
                                   key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, signed(r[2]))):
        out.setdefault(conv, []).extend(text.split("\n"))
    return out


def slow_turns(path, lines):
    """Turns of a decoded transcript: (line, role, content)."""
    out = []
    for nth, (state, line) in enumerate(zip(path, lines)):
        if state < 4:
            out.append((nth, c.ROLES[state], [c.observe(line)[3]]))
        else:
            out[-1][2].append(line)
    return [(n, r, "\n".join(t).strip()) for n, r, t in out]


def some_rows():
    rng = np.random.default_rng(8)
    marks = ["", "", "", "User: ", "AI: ", "System: ", "Tool: "]
    rows = [(k, int(t), marks[rng.integers(7)] + f"{k}.{t} " + "word " * int(rng.integers(0, 6)) + "?" * int(rng.integers(2))
             + "\nmore\n" * int(rng.integers(2)))
            for k, n in ((1, 90), (2, 1), (3, 7), (None, 5)) for t in range(-3, n)]
    return rows + [(3, 2, None), (3, None, "x"), (3, 2, "tie"), (3, 2, "tie"), (4, None, ""), (5, 0, "User: " + "long " * 20_000)]


@pytest.mark.parametrize("block,fan", [(256, 256), (4, 3), (1, 2)])
def test_blocks_against_whole(spark, monkeypatch, block, fan):
    """A best path of every whole transcript, and the parts of its turns put together."""
    monkeypatch.setattr(c, "BLOCK", block)
    rows = some_rows()
    df = spark.createDataFrame([(*r, "role", 1) for r in rows], "conv_id long, turn long, text string, role string, block int")
    model, usual = c.Model.prior(), c.block_ends
    monkeypatch.setattr(c, "block_ends", lambda blocks, model: usual(blocks, model, fan))
    got = {}
    for r in c.canonical_turns(df, model).orderBy("line").collect():
        got.setdefault(r.conv_id, []).append(r)
    transcripts = in_order(rows)
    assert set(got) == set(transcripts)
    for conv, lines in transcripts.items():
        parts = got[conv]
        heads = {r.line: c.ROLES.index(r.role) for r in parts if not r.continues}
        path, state = [], None
        for nth in range(len(lines)):
            state = heads[nth] if nth in heads else state % 4 + 4
            path.append(state)
        steps = list(model.steps(codes(lines)))
        assert score(steps, path) == pytest.approx(score(steps, c.best_path(c.only(c.START), steps)), abs=1e-9)
        want = "".join(c.render(role, text, True, True) for _, role, text in slow_turns(path, lines))
        text = "".join(r.rendered for r in parts)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(heads)
        # a turn is trimmed in its first and its last part, so blank lines where parts meet stay
        trimmed = lambda x: re.sub(r"(<\|im_start\|>\w+)\s*", r"\1\n", re.sub(r"\s*<\|im_end\|>", "<|im_end|>", x))       # noqa: E731
        assert trimmed(text) == trimmed(want)
        if block == 256:
            assert [(r.line, r.role, r.content) for r in parts] == slow_turns(path, lines) and text == want
    assert c.canonical_turns(df.filter("false"), model).count() == 0


def test_long_turns_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(c, "PART_BYTES", 50)
    docs = spark.createDataFrame([(1, "User: " + "\n".join(f"line {i}" for i in range(700)) + "\nAI: done")], "doc_id long, text string")
    parts = c.parse_transcripts(docs).orderBy("line").collect()
    assert len(parts) > 10 and [r.continues for r in parts[-2:]] == [True, False] and parts[-1].role == "assistant"
    want = "<|im_start|>user\n" + "\n".join(f"line {i}" for i in range(700)) + "<|im_end|>\n<|im_start|>assistant\ndone<|im_end|>\n"
    assert "".join(r.rendered for r in parts) == want


def recovered(spark, at):
    """(true role, found role, whether the line has a marker) of the held-out conversations' lines."""
    conv = spark.read.parquet(f"{at}/conversations.parquet")
    held = conv.filter(queries.held_out(F.col("conv_id")))
    shown = queries.transcripts(held, role_too=True).select("conv_id", "turn", "text", "role").collect()
    found = {}
    for r in queries.op10_chat(spark, at).filter(queries.held_out(F.col("conv_id"))).orderBy("line").collect():
        found.setdefault(r.conv_id, []).append((r.line, r.role))
    want = {}
    for conv_id, turn, text, role in sorted(shown, key=lambda r: (r[0], r[1])):
        want.setdefault(conv_id, []).extend((role, bool(c.observe(line)[0])) for line in text.split("\n"))
    for conv_id, lines in want.items():
        heads = iter([*found[conv_id], (len(lines), None)])
        here, following = None, next(heads)
        for nth, (role, marked) in enumerate(lines):
            while following[0] == nth:
                here, following = following[1], next(heads)
            yield role, here, marked


def test_roles_are_recovered(spark):
    """Line by line on the held-out conversations, against roles that the transcripts don't show: lines with
    a marker, and bare ones apart."""
    rows = list(recovered(spark, "/root/testdata/sf0.1"))
    marked = [a == b for a, b, m in rows if m]
    bare = [a == b for a, b, m in rows if not m]
    print(f"marked {len(marked)} lines {np.mean(marked):.3f}, bare {len(bare)} lines {np.mean(bare):.3f}")
    assert len(bare) > 100 and np.mean(marked) > 0.99 and np.mean(bare) > 0.75


def test_fit_counts(spark):
    rows = [(1, 0, "user", "User: a\nb"), (1, 1, "assistant", "b?"), (1, 1, "assistant", "b?"), (2, 0, "narrator", "x"),
            (2, None, None, None), (1, 2, "USER", None)]
    m = c.fit(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert np.allclose(np.exp(m.move[:, :c.START]).sum(axis=1), 1)
    assert np.exp(m.move[1, 5]) == pytest.approx((3 + 1) / (4 + 1 + 2))             # user lines: one later, two messages
    c.fit(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))


def test_edges_and_marks_of_the_form(spark, edge_docs):
    docs = spark.createDataFrame([(1, "System: be kind\nHuman: hi\nthere\nAI: hello <|im_end|>"), (2, None), (3, ""), (3, "")],
                                 "doc_id long, text string")
    rows = sorted(map(tuple, c.parse_transcripts(docs).select("conv_id", "line", "role", "content").collect()))
    assert [r[2:] for r in rows if r[0] == 1] == [("system", "be kind"), ("user", "hi\nthere"), ("assistant", "hello <|im_end|>")]
    assert {r[0] for r in rows} == {1, 2, 3} and all(r[3] == "" for r in rows if r[0] in (2, 3))
    assert all(r.rendered.count("<|im_end|>") == 1 for r in c.parse_transcripts(docs).collect())
    assert {r.conv_id for r in c.parse_transcripts(edge_docs).collect()} == {r.doc_id for r in edge_docs.collect()}


def test_blocks_are_bounded_whatever_the_turns(spark, monkeypatch):
    """Neither a null turn, a null conversation, a turn number that restarts nor rows that are alike make a
    block larger."""
    monkeypatch.setattr(c, "BLOCK", 8)
    rows = [(conv, turn, f"{conv} {turn} {i}") for conv, turn, n in ((None, None, 150), (1, 0, 90), (1, 1, 90), (0, 5, 30)) for i in range(n)]
    rows += [(7, None, "alike")] * 200
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(7)
    lines = c.lines_of(df, "conv_id", "turn", "text")
    sizes = lines.groupBy("conv_id", "block").count().collect()
    assert max(r["count"] for r in sizes) == 8 and sum(r["count"] for r in sizes) == len(rows)
