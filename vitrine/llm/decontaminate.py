"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as lower-cased words. Seeds, runs of ``MIN_MATCH`` words
that a document shares with an item, are found by a join on their rolling hashes; a document is
compared with the items it shares a seed with. Running Karp-Rabin then tiles the item: among the
unmarked words of both, matches of at least s words are found by hashing all windows of s words,
extended, and marked from the longest down where they don't overlap; s goes down to ``MIN_MATCH``.
Tiles may stand in any order, so a reordered passage is caught. An item is leaked by a document that
covers at least ``COVERAGE`` of the item's words.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_BYTES`` of text, by a hash of
the item, and each block is joined to all documents inside their scan. So documents are not shuffled,
nothing is held of them, and a benchmark of any size costs more scans, not more memory.
"""
from __future__ import annotations

import re
from collections import defaultdict
from heapq import heapify, heappop, heappush
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, free_name, id_and_text, stored, strings

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
BASE = np.uint64(1_000_003)
WORD = re.compile(r"\w+")

LEAKS = T.ArrayType(T.StructType().add("item_id", "long").add("coverage", "double").add("n_tiles", "integer")
                    .add("longest", "integer"))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k ids."""
    n = len(ids) - k + 1
    out = np.zeros(max(0, n), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * BASE + ids[j:j + n].astype(np.uint64)
    return out


def tiles(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in doc, words), no word of either in two tiles.

    An id of 0 matches nothing. Equal lengths are marked in order of their starts.
    """
    free_i, free_d = [x != 0 for x in item], [x != 0 for x in doc]
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(doc)) // 2)

    def windows(free: list[bool], s: int):
        run = 0
        for at, ok in enumerate(free):
            run = run + 1 if ok else 0
            if run >= s:
                yield at - s + 1

    while True:
        table = defaultdict(list)
        item_hash, doc_hash = (rolling(np.array(x, np.int64), size).tolist() for x in (item, doc))
        for p in windows(free_i, size):
            table[item_hash[p]].append(p)
        found, longest = [], 0
        for t in windows(free_d, size):
            for p in table.get(doc_hash[t], ()):
                # a match that also fits one word earlier has been found there
                if p and t and free_i[p - 1] and free_d[t - 1] and item[p - 1] == doc[t - 1]:
                    continue
                n = 0
                while p + n < len(item) and t + n < len(doc) and free_i[p + n] and free_d[t + n] and item[p + n] == doc[t + n]:
                    n += 1
                if n >= size:
                    found.append((p, t, n))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        queue = [(-n, p, t) for p, t, n in found]
        heapify(queue)
        while queue:                          # the longest first, then by start
            n, p, t = heappop(queue)
            n = -n
            free = [free_i[p + x] and free_d[t + x] for x in range(n)]
            if all(free):
                free_i[p:p + n] = free_d[t:t + n] = [False] * n
                out.append((p, t, n))
                continue
            for at, run in runs(free):        # what other tiles leave of it
                if run >= size:
                    heappush(queue, (-run, p + at, t + at))
        if size == least:
            return out
        size = max(least, size // 2)


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    """(start, length) of each run of true flags."""
    out, at = [], 0
    for on, group in groupby(flags):
        n = len(list(group))
        if on:
            out.append((at, n))
        at += n
    return out


class Matcher:
    """The items of one block, and the leaks of a text."""

    def __init__(self, items: list[tuple[int, str]], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)       # words in a seed: (hash, item)
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not ids:
                continue
            k = min(least, len(ids))                                      # a shorter item is one seed
            seeds[k] += [(h, len(self.items)) for h in set(rolling(np.array(ids, np.int64), k).tolist())]
            self.items.append((item_id, ids))
        self.seeds = {}
        for k, pairs in seeds.items():
            pairs.sort()
            self.seeds[k] = np.array([h for h, _ in pairs], np.uint64), np.array([i for _, i in pairs])

    def candidates(self, ids: np.ndarray) -> dict[int, np.ndarray]:
        """By item, which words of the text are in a seed that they share."""
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, (hashes, owner) in self.seeds.items():
            if len(ids) < k:
                continue
            known = np.concatenate([[0], np.cumsum(ids != 0)])
            whole = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(whole):
                continue
            own = np.zeros(len(whole), np.uint64)
            for j in range(k):
                own = own * BASE + ids[whole + j].astype(np.uint64)
            low = np.searchsorted(hashes, own, "left")
            high = np.searchsorted(hashes, own, "right")
            for t, a, b in zip(whole[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                for i in owner[a:b].tolist():
                    hits[i].append((t, k))
        out = {}
        for i, starts in hits.items():
            near = np.zeros(len(ids), bool)
            for t, k in starts:
                near[t:t + k] = True
            out[i] = near
        return out

    def leaks(self, text: str) -> list[dict]:
        find = self.vocabulary.get
        words = words_of(text)
        ids = np.fromiter((find(w, 0) for w in words), np.int64, len(words))
        out = []
        for i, near in self.candidates(ids).items():
            item_id, item = self.items[i]
            # words outside every seed can't be in a tile; a 0 keeps apart what they part
            keep = near | np.r_[False, near[:-1]]
            piece = np.where(near, ids, 0)[keep].tolist()
            if near.sum() < self.coverage * len(item):
                continue
            found = tiles(item, piece, min(self.least, len(item)))
            covered = sum(n for _, _, n in found) / len(item)
            if covered >= self.coverage:
                out.append({"item_id": item_id, "coverage": covered, "n_tiles": len(found),
                            "longest": max(n for _, _, n in found)})
        return sorted(out, key=lambda x: (x["item_id"] is None, x["item_id"] or 0))


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int = BLOCK_BYTES):
    """The distinct items in lists of about ``most`` bytes of text, one after the other."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                             F.col(text_col).cast("string").alias("text")).filter("text is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = max(1, -(-total // max(1, most // 2)))       # half: hashing deals unevenly
    for block in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        rows = [tuple(r) for r in part.collect()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def add_leaks(docs: DataFrame, benchmark: DataFrame, column: str, text_col: str = "text", id_col: str = "item_id",
              item_text_col: str = "text", least: int = MIN_MATCH, coverage: float = COVERAGE,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with an array column of its leaks: item_id, coverage, n_tiles and longest tile.

    Null and empty texts leak nothing, nor do items without words; items with fewer words than a seed
    must occur whole. A repeated item counts once, and two items with one id come as two leaks. An
    empty benchmark finds no leaks; an empty table stays empty. Other columns pass unchanged.
    """
    sc = docs.sparkSession.sparkContext
    out, parts = docs, []
    for rows in benchmark_blocks(benchmark, id_col, item_text_col, block_bytes):
        if parts:                             # else one task would hold the blocks of all scans
            out = stored(out, "leaks")
        block = sc.broadcast(rows)            # at most block_bytes of text

        def setup(block=block):
            matcher = Matcher(block.value, least, coverage)

            def compute(part: pa.RecordBatch) -> list[pa.Array]:
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()),
                                           ("n_tiles", pa.int32()), ("longest", pa.int32())]))
                return [pa.array([matcher.leaks(t) for t in strings(part.column(text_col))], kind)]
            return compute

        name = free_name(out, f"{column}_{len(parts)}")
        out = add_columns(out, setup, [T.StructField(name, LEAKS)], text_col)
        parts.append(name)
    found = F.concat(*parts) if parts else F.array().cast(LEAKS)
    return out.select(*docs.columns, found.alias(column))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) of each leak. See ``add_leaks``."""
    found = add_leaks(id_and_text(docs), benchmark, "leaks", **how)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a leak, unchanged."""
    column = free_name(docs, "leaks")
    return (add_leaks(docs, benchmark, column, text_col, **how).filter(F.size(column) == 0).select(docs.columns))
