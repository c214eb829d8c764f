"""Near-duplicate documents by SimHash fingerprints, looked up through Golay codeword indices.

Fingerprints of 64 bits link when at most three bits differ. To find the links without comparing
all pairs, a fingerprint is cut into segments of 22, 21 and 21 bits, and each segment is decoded with
the perfect binary Golay code (23, 12, 7): its codeword indices are those of the codewords within
four bits, one index, or six for the words three bits from their centre. Two words one bit apart
always share an index, as the centre of the one is within three bits of it and four of the other.

Pigeonhole: with three errors in three segments, either some segment has none, and then one of the
others has at most one: the key is that exact segment and an index of the other (six ordered pairs).
Or each has one: the key is an index of the first and an exact half of each of the others (four
keys). That makes about 53 keys of 32 to 34 bits a fingerprint, and no link is lost.

Equal fingerprints are one node, so exact copies never meet in a bucket. Fingerprints that share a
key are compared in the task that holds the key's run, and only a spanning forest of the links leaves
it. A run of more than ``RUN_MAX`` distinct fingerprints is not compared pairwise; its members go to
``dense_links``, which is exact and needs a fixed number of rows per member. Connected components
over the forests give the groups.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, free_name, id_and_text, stored, utf8
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
RUN_MAX = 4096
GOLAY = 0b101011100011                       # fixed value: generator x^11+x^9+x^7+x^6+x^5+x+1
SEGMENTS = ((0, 22), (22, 21), (43, 21))     # first bit, bits


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a UTF-8 text, A-Z lowered; no words: 0."""
    import xxhash

    words = text.lower().split()             # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(line)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]
                      or [digest(line, SEED)])
    count = len(hashes) // 8
    ones = np.zeros(64, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(count, 8)
    for at in range(0, count, 65_536):       # bounds the unpacked bits of a very long text
        ones += np.unpackbits(rows[at:at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) for each row."""

    def setup():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            known = np.array([fingerprint(t, shingle) for t in utf8(part.column("text"))], np.uint64)
            return [pa.array(known.view(np.int64))]
        return compute

    return add_columns(id_and_text(docs), setup, [T.StructField("fp", T.LongType())], keep=["doc_id"])


def syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of a 23-bit word by the generator."""
    word = word.copy()
    for bit in range(22, 10, -1):
        word ^= ((word >> bit) & 1) * (GOLAY << (bit - 11))
    return word


def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: how many error patterns of up to four bits lead to a codeword, and which."""
    table, count = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        flips = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for pattern, s in zip(flips.tolist(), syndrome(flips).tolist()):
            table[s, count[s]] = pattern
            count[s] += 1
    return count, table


def lookup_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) pairs of an array of fingerprints; fingerprints at three bits or fewer share a key."""
    count, table = error_patterns()
    parts = [(fps >> np.uint64(at)).astype(np.int64) & ((1 << bits) - 1) for at, bits in SEGMENTS]
    keys, rows = [], []
    indices = []
    for part in parts:
        s = syndrome(part)
        row = np.repeat(np.arange(len(part)), count[s])
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count[s]) - count[s], count[s])
        indices.append(((part[row] ^ table[s[row], nth]) >> 11, row))

    def add(kind: int, exact: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> None:
        keys.append((kind << 36) | (exact[index[1]] << 12) | index[0])
        rows.append(index[1])

    pairs = [(i, j) for i in range(3) for j in range(3) if i != j]
    for kind, (i, j) in enumerate(pairs):
        add(kind, parts[i], indices[j])
    low = (1 << 10) - 1
    halves = [(parts[1] & low, parts[1] >> 10), (parts[2] & low, parts[2] >> 10)]
    for kind in range(4):
        add(len(pairs) + kind, (halves[0][kind & 1] << 11) | halves[1][kind >> 1], indices[0])
    return np.concatenate(keys), np.concatenate(rows)


def forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (member, root) that connect what links of at most ``max_bits`` bits connect."""
    left, links = members, []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= max_bits
            found = left[near]
            frontier.extend(found)
            links.extend((x, root) for x in found.tolist())
            left = left[~near]
    return [(int(a), int(b)) for a, b in links]


def bucket_links(keyed: DataFrame, max_bits: int, run_max: int) -> DataFrame:
    """(a, b) of each key's forest; of longer runs each member with b null."""

    def links(members: np.ndarray) -> list[tuple[int, int | None]]:
        return forest(np.unique(members).view(np.uint64), max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, dense = None, np.zeros(0, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, fps = (batch.column(i).to_numpy() for i in range(2))
            if key is not None and keys[0] == key:           # the run goes on from the last batch
                keys, fps = np.concatenate([np.full(len(held), key), keys]), np.concatenate([held, fps])
            else:
                pairs, key, dense = ([] if dense or len(held) < 2 else links(held)), None, False
                yield from out(pairs, [])
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, len(keys)])
            pairs, many = [], []
            last = starts[-1]
            starts, sizes = starts[:-1], sizes[:-1]          # the last run may go on
            if dense and len(starts):                        # the end of a long run
                many.append(fps[:sizes[0]])
                starts, sizes, dense = starts[1:], sizes[1:], False
            two = starts[sizes == 2]                         # most runs: all at once
            a, b = fps[two], fps[two + 1]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits) & (a != b)
            for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if size > run_max:
                    many.append(fps[at:at + size])
                else:
                    pairs.extend(links(fps[at:at + size]))
            key, held = keys[last], fps[last:]
            if dense or len(held) > run_max:                 # the rest of a long run: nothing is held
                dense = True
                many.append(held)
                held = held[:1]
            yield from out(pairs, many, a[near], b[near])
        if not dense and len(held) > 1:
            yield from out(links(held), [])

    def out(pairs, many, a=np.zeros(0, np.int64), b=np.zeros(0, np.int64)):
        wide = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
        left = np.concatenate([a, wide[:, 0], *many])
        right = pa.chunked_array([pa.array(np.concatenate([b, wide[:, 1]])),
                                  pa.nulls(len(left) - len(b) - len(wide), pa.int64())]).combine_chunks()
        if len(left):
            yield pa.RecordBatch.from_arrays([pa.array(left), right], names=["a", "b"])

    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long")


def dense_links(members: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links among ``members(fp)`` that connect what all their links connect, with at most 2081 rows
    per member.

    Every pair at three bits or fewer has a word z one bit or less from the one and two or less from
    the other (in general: half of ``max_bits`` rounded down, and up). At each z the members on the
    near side link to the smallest of them, and so do those on the far side: all these are real links,
    at most 2081 members meet at a z, and both of the pair are among them.
    """
    flips = [sum(1 << i for i in bits) for n in range(max_bits - max_bits // 2 + 1)
             for bits in combinations(range(64), n)]
    inner = sum(1 for x in flips if x.bit_count() <= max_bits // 2)
    signed = [x - (1 << 64) if x >> 63 else x for x in flips]
    near = F.transform(F.array(*[F.lit(x).cast("long") for x in signed]),
                       lambda x, i: F.struct(F.col("fp").bitwiseXOR(x).alias("z"), (i < inner).alias("inner")))
    rows = members.select("fp", F.explode(near).alias("n")).select("fp", "n.z", "n.inner")
    roots = rows.filter("inner").groupBy("z").agg(F.min("fp").alias("root"))
    return rows.join(roots, "z").filter("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   run_max: int = RUN_MAX) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links reach.

    ``max_bits`` is 3 or less. A null text is empty; a text without words has fingerprint zero and
    links like any other. Repeated rows come back as often; a null doc_id gets its component too but
    never names one (null if the component has no other). An empty table gives none. Other columns
    of ``docs`` are not looked at.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    own = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                keys, rows = lookup_keys(fps)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows].view(np.int64))],
                                                 names=["key", "fp"])

    keys = nodes.select("fp").mapInArrow(keyed, "key long, fp long")
    found = stored(bucket_links(keys, max_bits, run_max).distinct(), "simhash-links")
    edges = found.filter("b is not null")
    dense = found.filter("b is null").select(F.col("a").alias("fp"))
    if not dense.isEmpty():
        edges = edges.union(dense_links(dense, max_bits))
    labels = connected_components(edges)
    named = (nodes.join(labels, nodes.fp == labels.node, "left")
             .select("fp", "first_id", F.coalesce("label", "fp").alias("label")))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    component = named.join(smallest, "label").select("fp", "component_id")
    return own.join(component, "fp").select("doc_id", "fp", "component_id")


def hex16(fp):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, and of repeated rows of
    that id the first by text. Rows without an id are kept. All columns stay as they are."""
    named = docs.withColumnsRenamed({id_col: "doc_id", text_col: "text"}) if (id_col, text_col) != ("doc_id", "text") else docs
    groups = simhash_groups(named, **how)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    mark, nth, key = (free_name(docs, x) for x in ("first_id", "nth", "join_id"))
    first = first.select(F.col("doc_id").alias(mark))
    keyed = docs.withColumn(key, F.col(id_col).cast("long"))
    one = (keyed.filter(F.col(key).isNotNull()).join(first, F.col(key) == F.col(mark), "left_semi")
           .withColumn(nth, F.expr(f"row_number() over (partition by `{key}` order by `{text_col}`)"))
           .filter(F.col(nth) == 1))
    return one.select(docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
