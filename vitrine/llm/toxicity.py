"""Toxicity by a small bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of two inputs: an embedding of the word itself (none for words of few sampled
texts), and the mean of the embeddings of its character sequences (three and four bytes, with marks at the word's ends), so that
a word never seen is known by its parts. One gated recurrent layer reads a window of ``WINDOW`` words
forwards and one backwards; attention weighs the states, and their weighted sum gives the logit. A
text's score is that of its highest window, over all windows at a distance of ``STRIDE`` words.

Labels hold for whole texts, while most windows of a toxic text are not. So a first network learns from
windows spread evenly over the sampled texts, and after each of its ``WEAK`` passes keeps as positive only
the windows of toxic texts that score above nearly all windows of other texts, or highest in their own. It then
scores all overlapping windows of the sampled texts, however long, in Spark, and a new network learns from
the highest of each text and some others: of toxic texts what makes them so, of others what is nearest
to it. At the end the sampled texts are scored whole, as any text is, and the bias is moved so that a half
parts these scores best.

One column of the embeddings starts as the contrast between the two kinds of texts: how far the shares
that have the word, or the sequence, lie apart beyond chance. With that a few hundred labels do.

The sample is at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` other labelled ids, those of the smallest
hashes outside the held-out fifth, each with one text; a gradient sees ``WINDOWS`` windows of a text at most.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, best_cut, free_name, slices, stored, strings

WINDOW, STRIDE = 32, 16
TOXIC_ROWS, CLEAN_ROWS, WINDOWS = 1200, 1800, 24
WIDTH, HIDDEN, ATTEND = 16, 8, 8
WORD_ROWS, WORD_TEXTS, CHAR_ROWS = 1 << 15, 3, 1 << 16
WEAK, EPOCHS, BATCH, RATE = 2, 4, 256, 0.02
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def window_starts(n_words: int, stride: int = STRIDE) -> range:
    """First words of the overlapping windows that cover n words; one window for a short or empty text."""
    return range(0, max(1, n_words - WINDOW + stride), stride)


def character_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all character sequences of the words, and where each word's begin."""
    marked = [b"^" + w.encode() + b"$$" for w in words]         # at least three bytes
    size = np.array([len(m) for m in marked])
    data = np.frombuffer(b"".join(marked) + b"\0\0\0", np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), size)
    n = len(owner)
    three = data[:n] | data[1:n + 1] << np.uint32(8) | data[2:n + 2] << np.uint32(16)
    four = three | data[3:n + 3] << np.uint32(24)
    left = np.repeat(np.cumsum(size), size) - np.arange(n)           # bytes of the word from here on
    ok3, ok4 = left >= 3, left >= 4
    shift = np.uint32(32 - (CHAR_ROWS.bit_length() - 1))
    rows = np.concatenate([((three[ok3] * np.uint32(2654435761)) >> shift),
                           ((four[ok4] * np.uint32(2246822519) + np.uint32(1)) >> shift)]).astype(np.int64)
    order = np.argsort(np.concatenate([owner[ok3], owner[ok4]]), kind="stable")
    count = np.bincount(np.concatenate([owner[ok3], owner[ok4]]), minlength=len(words))
    return rows[order], np.cumsum(count) - count                     # every word has a sequence


def contrast(rows: list[np.ndarray], labels: list[int], size: int) -> np.ndarray:
    """For each embedding row how much more texts of label 1 have it than others: the z-score of the two
    shares, less three (chance, over so many rows), in steps of three and at most three of them."""
    label = np.array(labels)
    n1, n0 = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    have = np.zeros((2, size))
    for own, y in zip(rows, labels):
        have[y, np.unique(own)] += 1
    both = (have[0] + have[1] + 1) / (n0 + n1 + 2)
    z = (have[1] / n1 - have[0] / n0) / np.sqrt(both * (1 - both) * (1 / n0 + 1 / n1))
    return (np.sign(z) * np.clip(np.abs(z) - 3, 0, 9) / 3).astype(np.float32)


def vocabulary_of(texts: list[tuple[int, int, list[list[str]]]]) -> dict[str, int]:
    """Row of each word that at least ``WORD_TEXTS`` texts have, the most common first; row 0 is for the others."""
    count = Counter(w for _, _, ws in texts for w in {x for window in ws for x in window})
    common = sorted((w for w, n in count.items() if n >= WORD_TEXTS), key=lambda w: (-count[w], w))
    return {w: 1 + i for i, w in enumerate(common[:WORD_ROWS - 1])}


@dataclass
class Network:
    """Weights by name, and the row of each known word."""

    weights: dict[str, np.ndarray]
    vocabulary: dict[str, int]

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        w = {"word": np.zeros((1 + len(vocabulary), WIDTH), np.float32), "char": normal(CHAR_ROWS, WIDTH, scale=0.3),
             "att": normal(2 * HIDDEN, ATTEND, scale=0.3), "att_v": normal(ATTEND, scale=0.3),
             "out": normal(2 * HIDDEN, scale=0.3), "bias": np.full(1, -1.0, np.float32)}
        for side in "fb":
            w |= {side + "in": normal(WIDTH, 3 * HIDDEN, scale=0.3), side + "b": np.zeros(3 * HIDDEN, np.float32),
                  side + "gate": normal(HIDDEN, 2 * HIDDEN, scale=0.3), side + "new": normal(HIDDEN, HIDDEN, scale=0.3)}
        return cls(w, vocabulary)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """The input vector of each word, and what made it."""
        chars, starts = character_rows(words)
        own = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        count = np.diff(np.r_[starts, len(chars)])
        mean = np.add.reduceat(self.weights["char"][chars], starts, axis=0) / count[:, None].astype(np.float32)
        return self.weights["word"][own] + mean, (own, chars, count)

    def table(self, words: list[str], most: int = 1 << 14) -> np.ndarray:
        """The input vectors of many words, ``most`` at a time: their sequences are many times as many."""
        return np.concatenate([self.inputs(words[at:at + most])[0] for at in range(0, len(words), most)])

    def read(self, side: str, gates: np.ndarray, news: np.ndarray, index: np.ndarray, real: np.ndarray,
             keep: list | None = None) -> np.ndarray:
        """States (steps, windows, HIDDEN) of one direction. ``index`` has the row of each step and window
        in the projected inputs; where ``real`` is 0 the state stays 0."""
        gate, new = self.weights[side + "gate"], self.weights[side + "new"]
        steps, n = index.shape
        out = np.empty((steps, n, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            zr = h @ gate
            zr += gates[index[t]]
            np.tanh(np.multiply(zr, 0.5, out=zr), out=zr)
            zr += 1
            zr *= 0.5
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            inner = h @ new
            c = r * inner
            c += news[index[t]]
            np.tanh(c, out=c)
            now = h - c
            now *= z
            now += c
            now *= real[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, inner, c))
            out[t] = h = now
        return out

    def forward(self, table: np.ndarray, index: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of the windows whose words are rows of ``table``; index, real: (steps, windows)."""
        w, states = self.weights, []
        for side in "fb":
            own = table @ w[side + "in"] + w[side + "b"]
            kept = [] if keep is not None else None
            states.append(self.read(side, np.ascontiguousarray(own[:, :2 * HIDDEN]),
                                    np.ascontiguousarray(own[:, 2 * HIDDEN:]), index, real, kept))
            if keep is not None:
                keep[side] = kept
        h = np.concatenate(states, axis=2)
        tanh = np.tanh(h @ w["att"])
        energy = np.where(real > 0, tanh @ w["att_v"], np.float32(-1e9))
        a = np.exp(energy - energy.max(axis=0))
        a *= real
        a /= np.maximum(a.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tb,tbh->bh", a, h)
        if keep is not None:
            keep |= {"h": h, "tanh": tanh, "a": a, "pooled": pooled}
        return pooled @ w["out"] + w["bias"][0]


def batch_of(windows: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, index, real) of some windows."""
    ids: dict[str, int] = {"": 0}
    index = np.zeros((WINDOW, len(windows)), np.int64)
    real = np.zeros((WINDOW, len(windows)), np.float32)
    for b, words in enumerate(windows):
        index[:len(words), b] = [ids.setdefault(x, len(ids)) for x in words]
        real[:len(words), b] = 1
    return list(ids), index, real


def gradients(net: Network, words: list[str], index: np.ndarray, real: np.ndarray, label: np.ndarray
              ) -> tuple[dict[str, np.ndarray], dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Of the mean cross-entropy: dense ones by name, and (rows, gradients) of the embeddings."""
    w, keep = net.weights, {}
    table, (own, chars, count) = net.inputs(words)
    logit = net.forward(table, index, real, keep)
    n = len(label)
    d_logit = ((0.5 * (1 + np.tanh(0.5 * logit)) - label) / n).astype(np.float32)
    g: dict[str, np.ndarray] = {"out": keep["pooled"].T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * w["out"]
    h, a = keep["h"], keep["a"]
    d_a = np.einsum("bh,tbh->tb", d_pooled, h)
    d_energy = a * (d_a - (a * d_a).sum(axis=0))
    d_tanh = d_energy[:, :, None] * w["att_v"] * (1 - keep["tanh"] ** 2)
    g["att_v"] = np.einsum("tb,tbk->k", d_energy, keep["tanh"])
    g["att"] = np.einsum("tbh,tbk->hk", h, d_tanh)
    d_h = a[:, :, None] * d_pooled + d_tanh @ w["att"].T
    d_table = np.zeros_like(table)
    for at, side in enumerate("fb"):
        gate, new = w[side + "gate"], w[side + "new"]
        d_own = np.zeros((len(table), 3 * HIDDEN), np.float32)
        d_gate, d_new = np.zeros_like(gate), np.zeros_like(new)
        back = np.zeros((n, HIDDEN), np.float32)
        for t, before, z, r, inner, c in reversed(keep[side]):
            d = (back + d_h[t][:, at * HIDDEN:(at + 1) * HIDDEN]) * real[t][:, None]
            d_c = d * (1 - z) * (1 - c * c)
            d_zr = np.concatenate([d * (before - c) * z * (1 - z), d_c * inner * r * (1 - r)], axis=1)
            d_inner = d_c * r
            d_gate += before.T @ d_zr
            d_new += before.T @ d_inner
            back = d * z + d_zr @ gate.T + d_inner @ new.T
            np.add.at(d_own, index[t], np.concatenate([d_zr, d_c], axis=1))
        g |= {side + "gate": d_gate, side + "new": d_new, side + "in": table.T @ d_own, side + "b": d_own.sum(axis=0)}
        d_table += d_own @ w[side + "in"].T
    spread = np.repeat(d_table / count[:, None].astype(np.float32), count, axis=0)
    return g, {"word": _summed(own, d_table), "char": _summed(chars, spread)}


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    found, starts = np.unique(rows[order], return_index=True)
    return found, np.add.reduceat(values[order], starts, axis=0)


def train(texts: list[tuple[int, int, list[list[str]]]], epochs: int = EPOCHS, seed: int = 11, judge: Network | None = None) -> Network:
    """Fit a network to (text, label, windows of words); adaptive steps, deterministic for a seed. Which windows of
    toxic texts count as such is for ``judge`` to say before the first pass, and for the network after each."""
    vocabulary = vocabulary_of(texts)
    rng = np.random.default_rng(seed)
    windows = [(t, y, w) for t, (_, y, ws) in enumerate(texts) for w in ws]
    windows += [(-1, 0, [])] * max(1, len(windows) // 200)           # no words: not toxic
    text = np.array([t for t, _, _ in windows])
    label = np.array([y for _, y, _ in windows], np.float32)
    toxic, clean = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    used = np.ones(len(windows), bool)
    batch = min(BATCH, max(16, len(windows) // 100))                 # a small sample needs as many steps
    own = [sorted({w for window in ws for w in window}) or [""] for _, _, ws in texts]
    first = {"word": contrast([np.array([vocabulary.get(w, 0) for w in ws]) for ws in own], [y for _, y, _ in texts], 1 + len(vocabulary)),
             "char": contrast([character_rows(ws)[0] for ws in own], [y for _, y, _ in texts], CHAR_ROWS)}
    first["word"][0] = 0
    net = Network.fresh(vocabulary, seed)
    for name, by_row in first.items():
        net.weights[name][:, 0] = by_row
    past = {k: np.full_like(v, 1e-6) for k, v in net.weights.items()}

    def keep_positive(judge: Network) -> None:
        logit = np.concatenate([window_logits(judge, [w for _, _, w in windows[at:at + 4096]])
                                for at in range(0, len(windows), 4096)])
        best: dict[int, float] = {}
        for t, x in zip(text.tolist(), logit.tolist()):
            best[t] = max(best.get(t, -np.inf), x)
        # like few windows of other texts, or the likeliest of its own
        high = np.quantile(logit[clean], 0.995) if len(clean) else -np.inf
        used[toxic] = [logit[i] > high or logit[i] == best[text[i]] for i in toxic]

    if judge is not None:
        keep_positive(judge)
    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(used))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            words, index, real = batch_of([windows[i][2] for i in some])
            dense, rows = gradients(net, words, index, real, label[some])
            rows["word"][1][rows["word"][0] == 0] = 0                # unknown words stay 0
            for name, grad in dense.items():
                past[name] += grad * grad
                net.weights[name] -= RATE * grad / np.sqrt(past[name])
            for name, (which, grad) in rows.items():
                past[name][which] += grad * grad
                net.weights[name][which] -= RATE * grad / np.sqrt(past[name][which])
        keep_positive(net)
    return net


def window_logits(net: Network, windows: list[list[str]]) -> np.ndarray:
    words, index, real = batch_of(windows)
    return net.forward(net.table(words), index, real)


def text_scores(net: Network, texts: list[str], block: int = 4096, most_words: int = 1 << 20) -> np.ndarray:
    """The score of each text: the highest of its windows, 0 to 1."""
    out = np.full(len(texts), -np.inf, np.float32)
    ids: dict[str, int] = {"": 0}
    pending, owner, total = [], [], 0

    def flush() -> None:
        """Score the windows gathered so far; a long text may come in several pieces."""
        nonlocal ids, pending, owner, total
        if not owner:
            return
        table = net.table(list(ids))
        data = np.concatenate([*pending, np.zeros(WINDOW, np.int64)])
        starts = np.concatenate([s for s, _, _ in owner])
        length = np.concatenate([n for _, n, _ in owner])
        text = np.concatenate([np.full(len(s), t) for s, _, t in owner])
        step = np.arange(WINDOW)[:, None]
        for at in range(0, len(starts), block):
            s, n = starts[at:at + block], length[at:at + block]
            real = (step < n).astype(np.float32)
            index = np.where(real > 0, data[np.minimum(s + step, len(data) - 1)], 0)
            np.maximum.at(out, text[at:at + block], net.forward(table, index, real))
        ids, pending, owner, total = {"": 0}, [], [], 0

    for t, body in enumerate(texts):
        words = words_of(body)
        first = np.array(window_starts(len(words)))
        per = max(1, most_words // STRIDE)
        for at in range(0, len(first), per):                         # pieces of a very long text
            part = first[at:at + per]
            low, high = int(part[0]), min(len(words), int(part[-1]) + WINDOW)
            own = [ids.setdefault(w, len(ids)) for w in words[low:high]]
            pending.append(np.array(own, np.int64))
            owner.append((part - low + total, np.minimum(WINDOW, len(words) - part), t))
            total += len(own)
            if total >= most_words:
                flush()
    flush()
    return 0.5 * (1 + np.tanh(0.5 * out.astype(np.float64)))


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """(doc_id, label, text) of the bounded sample of labelled ids, stored: of an id's texts the one of the
    smallest hash. A document with more than one label counts as toxic if one of them says so."""
    known = (labels.select(F.col("doc_id").cast("long").alias("known_id"), F.col("toxic").cast("int").alias("label"))
             .filter("known_id is not null and label is not null and crc32(cast(known_id as string)) % 5 <> 0")
             .groupBy("known_id").agg(F.max("label").alias("label")))
    sample = None
    for label, rows in ((1, toxic_rows), (0, clean_rows)):
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64("known_id"), "known_id").limit(rows)
        sample = part if sample is None else sample.union(part)
    marked = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
              .join(F.broadcast(sample), F.col("doc_id") == F.col("known_id")))        # at most toxic_rows + clean_rows
    one = marked.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return stored(one.repartition(docs.sparkSession.sparkContext.defaultParallelism), "toxicity-sample")


def logits_at(net: Network, words: list[str], starts: np.ndarray, block: int = 4096) -> np.ndarray:
    """The logit of the window at each start, ``block`` at a time."""
    return np.concatenate([window_logits(net, [words[s:s + WINDOW] for s in starts[at:at + block]]) for at in range(0, len(starts), block)])


def chosen_starts(words: list[str], windows: int, net: Network | None) -> list[int]:
    """All windows side by side of a text that has no more than ``windows`` of them. Of a longer one, without a
    network as many spread evenly; else the half of them that score highest among all overlapping ones, and
    the other half spread evenly."""
    starts = range(0, max(1, len(words)), WINDOW)
    if len(starts) <= windows:
        return list(starts)
    spread = [starts[i * len(starts) // windows] for i in range(windows)]
    if net is None:
        return spread
    every = np.array(window_starts(len(words)))
    logit = logits_at(net, words, every)
    best = every[np.argsort(-logit, kind="stable")[:windows // 2]].tolist()
    return sorted({*best, *spread[::2]})


def training_windows(rows: DataFrame, net: Network | None = None, windows: int = WINDOWS) -> list[tuple[int, int, list[list[str]]]]:
    """(doc_id, label, windows) of the sampled rows; see ``chosen_starts``."""
    shared = rows.sparkSession.sparkContext.broadcast((net.weights, net.vocabulary) if net else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*shared.value) if shared.value else None
        for batch in batches:
            for part in slices(batch):
                cut = []
                for text in strings(part.column(2)):
                    words = words_of(text)
                    cut.append([" ".join(words[s:s + WINDOW]) for s in chosen_starts(words, windows, own)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cut, pa.list_(pa.string()))],
                                                 names=["doc_id", "label", "windows"])

    found = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, windows array<string>").collect()
    # a word is one string, however often it occurs
    return [(d, y, [[intern(x) for x in w.split(" ")] if w else [] for w in ws])
            for d, y, ws in sorted(found, key=lambda r: (r[0], r[2]))]


def place_half(net: Network, rows: DataFrame) -> Network:
    """The network with its bias where a half parts the whole texts of the sample best."""
    found = [(min(max(s, 1e-9), 1 - 1e-9), y) for s, y in add_scores(rows, net, "score", keep=["label"]).select("score", "label").collect()]
    cut = best_cut([(float(np.log(s / (1 - s))), int(y)) for s, y in found])
    if cut is not None:
        nothing = float(window_logits(net, [[]])[0])                  # no words: under a half
        net.weights["bias"] = net.weights["bias"] - np.float32(max(cut, nothing + 0.5))
    return net


def fit(docs: DataFrame, labels: DataFrame, windows: int = WINDOWS, **how) -> Network:
    """A network for ``docs``, trained on the driver on windows of the bounded sample; which, and where a half
    lies, is found on whole texts by tasks."""
    rows = sample_rows(docs, labels, **how)
    first = train(training_windows(rows, None, windows), WEAK)
    return place_half(train(training_windows(rows, first, windows), judge=first), rows)


def add_scores(docs: DataFrame, net: Network, column: str = "score", text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """``docs`` with each whole text's score from 0 to 1.

    A null text is empty; an empty text, or one without words, has the score of the empty window.
    Repeated rows score alike; an empty table stays empty; other columns pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast((net.weights, net.vocabulary))   # a few MB, whatever the corpus

    def setup():
        own = Network(*shared.value)
        return lambda part: [pa.array(text_scores(own, strings(part.column(text_col))), pa.float64())]

    return add_columns(docs, setup, [T.StructField(column, T.DoubleType())], text_col, keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.5, **how) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, unchanged."""
    column = free_name(docs, "toxic_score")
    net = fit(docs, labels, text_col=text_col, **how)
    return add_scores(docs, net, column, text_col).filter(F.col(column) < threshold).select(docs.columns)
