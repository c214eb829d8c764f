"""Token ids in binary files, coded by a length-limited canonical Huffman code.

``write_ids`` encodes texts, appends an end id to each, counts all ids, and fits one code to the global
counts: package-merge gives the best lengths of at most ``MOST_BITS`` bits, and codes are canonical, so
the lengths alone rebuild them. Documents in ascending order of id are dealt to shards; a shard's
documents fill blocks of about ``BLOCK_IDS`` ids, which are written as raw bytes, ``BLOCKS_A_FILE`` to a
file. Below the given folder:

``ids/``       the files. A block is ``HEAD`` (magic, shard, number in the shard, its first id's place
               among all ids, documents, ids, checkpoints, bytes of codes), then little-endian arrays:
               the documents' ids (int64), whether null (uint8), and lengths (uint32), the bit offset of
               each ``STRIDE``-th id (uint64); the codes, first bit highest; the CRC-32 of all that; and
               a line feed, which the sink puts behind each block.
``code/``      Parquet rows (id, count, bits) of the ids that occur.

A block needs nothing but the code. Decoding starts at any checkpoint, and all checkpoints of a block
are decoded side by side: each step takes the next bits of every one, looks up id and length in one
table, and moves on.
"""
from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, id_and_text, slices, stored, strings

MAGIC = b"HID1"
HEAD = struct.Struct("<4sIIQIIIQ")
MOST_BITS = 16                               # more where there are more ids than such codes
BLOCK_IDS = 1 << 16
BLOCKS_A_FILE = 512
SHARD_IDS = 1 << 27                          # more shards than shuffle partitions beyond this many
STRIDE = 256                                 # ids from one checkpoint to the next
SAMPLED_KEYS = 1_000_000                     # most keys sampled to balance the shards
PIECES_HELD = 1 << 19                        # pieces whose ids a Python worker remembers
MARK = "<|"                                  # how added tokens begin
NULL_ID = -(1 << 63)                         # where a null id sorts


# ---- the code

def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Bits of each symbol's code, none above ``most``, of the least total size (package-merge).
    A symbol that doesn't occur has none, an only symbol one."""
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        bits[used] = 1
        return bits
    if n > 1 << most:
        raise ValueError(f"{n} symbols don't fit codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64) if counts.sum() < 1 << 52 else counts[order].astype(object)
    levels, row = [], leaves
    is_leaf = np.ones(n, bool)
    for _ in range(most):
        levels.append(is_leaf)
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        row, is_leaf = both[at], at < n
    take = 2 * n - 2                         # the cheapest of the last level; packages open one level down
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        bits[order[:own]] += 1
        take = 2 * (take - own)
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Codes of the given lengths: shorter before longer, then by symbol."""
    used = np.flatnonzero(bits)
    order = used[np.lexsort((used, bits[used]))]
    size = bits[order].astype(np.int64)
    top = int(size.max()) if len(size) else 0
    room = np.left_shift(np.int64(1), top - size)        # codes of length top below each
    codes = np.zeros(len(bits), np.uint64)
    codes[order] = (np.cumsum(room) - room) >> (top - size)
    return codes


def decoding_table(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, length) by the next ``top`` bits, and ``top``, the longest length."""
    used = np.flatnonzero(bits)
    top = int(bits.max()) if len(used) else 1
    order = used[np.lexsort((used, bits[used]))]
    room = np.left_shift(np.int64(1), top - bits[order].astype(np.int64))
    fill = (1 << top) - int(room.sum())                  # only an only symbol leaves codes unused
    ids = np.concatenate([np.repeat(order, room), np.zeros(fill, np.int64)]).astype(np.uint32)
    return ids, np.concatenate([np.repeat(bits[order], room), np.ones(fill, np.uint8)]).astype(np.int64), top


def pack(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes one behind the other, and the bit offset of each ``STRIDE``-th."""
    size = bits[ids].astype(np.int64)
    if len(ids) and not size.all():
        raise ValueError("an id without a code")
    end = np.cumsum(size)
    at = end - size
    total = int(end[-1]) if len(ids) else 0
    word, off = at >> 5, at & 31
    wide = codes[ids] << (64 - off - size).astype(np.uint64)      # at most 25 bits, from one of 32 places
    out = np.zeros(total // 32 + 2, np.uint64)
    if len(ids):
        # codes don't overlap, so a word is the sum of its codes' parts; runs of one word are neighbours
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[:(total + 7) // 8], at[::STRIDE].astype("<u8")


def unpack(payload: np.ndarray, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """``n`` ids from the first of ``checkpoints`` on, all checkpoints in step."""
    ids, sizes, top = table
    out = np.empty((len(checkpoints), STRIDE), np.uint32)
    for some in range(0, len(checkpoints), 4096):        # a bounded share of a very long block
        lanes = checkpoints[some:some + 4096].astype(np.int64)
        base = int(lanes[0]) >> 3
        last = int(checkpoints[some + 4096]) // 8 + 1 if some + 4096 < len(checkpoints) else len(payload)
        b = np.concatenate([payload[base:last], np.zeros(4, np.uint8)]).astype(np.uint32)
        window = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
        at, end, mask = lanes - base * 8, len(window) - 1, (1 << top) - 1
        for k in range(STRIDE):
            code = (window[np.minimum(at >> 3, end)] >> (32 - top - (at & 7)).astype(np.uint32)) & mask
            out[some:some + len(lanes), k] = ids[code]
            at += sizes[code]
    return out.reshape(-1)[:n]


# ---- blocks

def build_block(shard: int, number: int, start: int, docs: list[tuple[int | None, np.ndarray]], codes: np.ndarray,
                bits: np.ndarray) -> bytes:
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, np.uint32)
    payload, checkpoints = pack(ids, codes, bits)
    body = b"".join([
        HEAD.pack(MAGIC, shard, number, start, len(docs), len(ids), len(checkpoints), len(payload)),
        np.array([0 if i is None else i for i, _ in docs], "<i8").tobytes(),
        np.array([i is None for i, _ in docs], np.uint8).tobytes(),
        np.array([len(x) for _, x in docs], "<u4").tobytes(), checkpoints.tobytes(), payload])
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block of a file's bytes, read from its offset; ``end`` is where the next begins."""

    def __init__(self, data: bytes, offset: int = 0):
        magic, self.shard, self.number, self.start, n_docs, self.n_ids, n_marks, n_bytes = HEAD.unpack_from(data, offset)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = offset + HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.null_ids = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
        self.lengths = np.frombuffer(data, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
        self.checkpoints = np.frombuffer(data, "<u8", n_marks, at + 13 * n_docs)
        at += 13 * n_docs + 8 * n_marks
        self.payload = np.frombuffer(data, np.uint8, n_bytes, at)
        self.end = at + n_bytes + 5
        if zlib.crc32(memoryview(data)[offset:at + n_bytes]) != struct.unpack_from("<I", data, at + n_bytes)[0]:
            raise ValueError(f"block {self.number} of shard {self.shard} is damaged")

    def ids(self, table, low: int = 0, high: int | None = None) -> np.ndarray:
        """Ids ``low`` to ``high`` of the block, decoded from the checkpoint before ``low``."""
        high = self.n_ids if high is None else min(high, self.n_ids)
        first = low // STRIDE
        if high <= low:
            return np.zeros(0, np.uint32)
        marks = self.checkpoints[first:(high + STRIDE - 1) // STRIDE]
        return unpack(self.payload, marks, high - first * STRIDE, table)[low - first * STRIDE:]


def blocks(data: bytes) -> Iterator[Block]:
    at = 0
    while at < len(data):
        block = Block(data, at)
        at = block.end
        yield block


# ---- encoding

def encodes_by_piece(tokenizer) -> bool:
    """Whether a text's ids are those of its pieces, one after the other, where pieces are parted at ASCII white
    space, and a word of ASCII alone is lower-cased and parted between its letters or digits and other signs
    (but for apostrophes). Known of byte-level tokenizers that normalise by character, lower-case, drop
    white space, and have no added token with a space."""
    import json
    import string

    import regex

    parts = json.loads(tokenizer.to_str())

    def flat(part, inner):
        return [x for p in part[inner] for x in flat(p, inner)] if part and inner in part else [part] if part else []

    before = flat(parts["normalizer"], "normalizers")
    split, *rest = flat(parts["pre_tokenizer"], "pretokenizers") or [None]
    plain = [p["type"] for p in before].count("Lowercase") == 1 and all(
        p["type"] in ("NFC", "Lowercase") or (p["type"] == "Replace" and p["pattern"] == {"Regex": r"\s+"} and p["content"] == " ")
        for p in before)
    pattern = split["pattern"].get("Regex", "(?") if split and split["type"] == "Split" else "(?"
    later = [p["type"] for p in rest] == ["ByteLevel"] and not (rest[0]["add_prefix_space"] or rest[0]["use_regex"])
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) and t["content"].startswith(MARK)
                for t in parts["added_tokens"])
    if not (plain and later and added and parts["model"]["type"] == "BPE" and "(?" not in pattern
            and split["behavior"] == "Removed" and split["invert"]):
        return False
    # no match reaches over a space or from one kind of sign to the other
    kinds = string.ascii_lowercase + string.digits, "".join(c for c in string.punctuation if c != "'")
    pairs = [x + y for x in kinds[0] for y in kinds[1]] + [y + x for x in kinds[0] for y in kinds[1]]
    probe = " ".join(string.printable) + "  a\t\tb\n1 \r.\u00e9 \u0301"
    return (not any(re.search(r"\s", m) for m in regex.findall(pattern, probe))
            and all(regex.findall(pattern, x) == [x[0], x[1]] for x in pairs))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of every i, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Encoder:
    """The library's ids of texts, without added special tokens. Where ids may be taken piece by piece, each
    different piece goes to the library once, and the last ``PIECES_HELD`` or so are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one thread per task
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.by_piece = encodes_by_piece(self.model)
        self.size = {i: len(t.removesuffix(self.model.model.end_of_word_suffix or ""))
                     for t, i in self.model.get_vocab(with_added_tokens=False).items()} if self.by_piece else {}
        self.bytes_of = np.array([self.size.get(i, 0) for i in range(max(self.size, default=0) + 1)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}                  # piece to its number
        self.starts, self.sizes, self.pool = [], [], []
        self.filled = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), 32):              # encodings are many times their text
            out += [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts[at:at + 32], add_special_tokens=False)]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """ASCII pieces are encoded many at a time; the bytes that their ids stand for part them again."""
        plain = [p for p in pieces if p.isascii() and MARK not in p]
        rest = [p for p in pieces if not (p.isascii() and MARK not in p)]
        for at in range(0, len(plain), 1024):
            some = plain[at:at + 1024]
            ids = self._whole([" ".join(some)])[0]
            seen, ends = np.cumsum(self.bytes_of[ids]), np.cumsum([len(p) for p in some])
            cuts = np.searchsorted(seen, ends)
            if not len(ids) or cuts[-1] >= len(ids) or (seen[cuts] != ends).any():
                rest += some
                continue
            sizes = np.diff(cuts + 1, prepend=0)
            self._add(some, ids, sizes)
        for at in range(0, len(rest), 1024):
            found = self._whole(rest[at:at + 1024])
            self._add(rest[at:at + 1024], np.concatenate(found), np.array([len(x) for x in found]))

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        self.starts.append(self.filled + np.cumsum(sizes) - sizes)
        self.sizes.append(sizes)
        self.pool.append(ids)
        self.filled += len(ids)

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in pieces if p not in self.known]
        if new and len(self.known) + len(new) > PIECES_HELD:
            self.forget()
            new = pieces
        self._learn(new)
        self.starts, self.sizes, self.pool = ([np.concatenate(x)] if x else [np.zeros(0, np.int64)]
                                              for x in (self.starts, self.sizes, self.pool))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many of each text) of an Arrow array without nulls."""
        if not self.by_piece:
            found = self._whole(texts.to_pylist())
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        words = pc.ascii_split_whitespace(texts)
        different = words.flatten().dictionary_encode()
        own = different.dictionary                       # each different word, and its pieces
        simple = pc.and_(pc.string_is_ascii(own), pc.invert(pc.match_substring(own, MARK)))
        low = pc.ascii_lower(own)
        for pattern in ("([a-z0-9])([^a-z0-9'])", "([^a-z0-9' ])([a-z0-9])"):
            low = pc.replace_substring_regex(low, pattern, r"\1 \2")
        cut = pc.split_pattern(pc.if_else(simple, low, own), " ")
        pieces = cut.flatten().dictionary_encode()
        numbers = self._numbers(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        starts, sizes, pool = self.starts[0], self.sizes[0], self.pool[0]
        of_words = pool[ragged(starts[numbers], sizes[numbers])]
        ends = np.concatenate([[0], np.cumsum(sizes[numbers])])[cut.offsets.to_numpy()]
        word_starts, word_sizes = ends[:-1], np.diff(ends)
        at = different.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(word_sizes[at])])[words.offsets.to_numpy()]
        return of_words[ragged(word_starts[at], word_sizes[at])], np.diff(ends)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and file, so that tasks share what was encoded."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int, width: str) -> DataFrame:
    """(doc_id, at, tie, salt, n, ids): each text's ids and the end id as little-endian ``width``, with its
    place in the order: by id, nulls first; rows of one id by a hash of their text; equal rows by salt."""
    docs.sparkSession.sparkContext.addFile(tokenizer_path)
    name = os.path.basename(tokenizer_path)
    rows = id_and_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("at"),
                                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
                                    F.monotonically_increasing_id().alias("salt"), "text")

    def setup():
        model = encoder(SparkFiles.get(name))

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            ids, sizes = model.ids(pc.fill_null(part.column("text"), ""))
            ends = np.cumsum(sizes + 1)
            out = np.full(len(ids) + len(sizes), end_id, width)
            inner = np.ones(len(out), bool)
            inner[ends - 1] = False
            out[inner] = ids
            offsets = np.concatenate([[0], ends]).astype(np.int64) * out.itemsize
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
            return [pa.array(sizes + 1, pa.int64()), binary.cast(pa.binary())]
        return compute

    return add_columns(rows, setup, [T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())],
                       keep=["doc_id", "at", "tie", "salt"])


def id_counts(tokens: DataFrame, vocabulary: int, width: str) -> np.ndarray:
    """How often each id occurs: one row per task and id meets in the aggregation, one per id here."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for part in slices(batch, "ids"):
                total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), width), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    found = (tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))).collect()
    out = np.zeros(vocabulary, np.int64)
    for i, n in found:
        out[i] = n
    return out


# ---- shards

def _key(at: np.ndarray, tie: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Bytes that sort as (at, tie, salt) does."""
    three = np.stack([at, tie, salt], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.frombuffer(three.astype(">u8").tobytes(), "S24")


def shard_bounds(tokens: DataFrame, shards: int) -> np.ndarray:
    """Keys that part the rows into about equal shards, from a sample of at most about ``SAMPLED_KEYS``
    keys. They set the shards' sizes, not what is in the files or its order."""
    rows = tokens.count()
    wanted = min(50 * shards, SAMPLED_KEYS)
    keys = tokens.select("at", "tie", "salt")
    if rows > 2 * wanted:
        keys = keys.sample(wanted / rows, seed=1)
    sample = keys.toArrow()
    if shards < 2 or not sample.num_rows:
        return np.zeros(0, "S24")
    found = np.sort(_key(*(sample.column(c).to_numpy() for c in ("at", "tie", "salt"))))
    return np.unique(found[[len(found) * i // shards for i in range(1, shards)]])


def _dealt(tokens: DataFrame, bounds: np.ndarray, columns: list[str]) -> DataFrame:
    """The columns and the row's shard."""
    picked = tokens.select("at", "tie", "salt", *columns)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = _key(*(batch.column(c).to_numpy() for c in range(3)))
                shard = np.searchsorted(bounds, key, side="right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])

    return picked.mapInArrow(deal, T.StructType([*picked.schema.fields, T.StructField("shard", T.IntegerType())]))


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the documents' ids below ``path``, which must not exist; see the module for the files.

    Texts are encoded once, whole, however long. One shuffle brings the ids to their shard; the shards cut
    the order by id, hash of the text and a number, so rows that share an id, or are equal, spread over
    several. Null texts are empty and have the end id alone; null ids come first; repeated rows are written
    as often; an empty table gives an empty ``ids``. Other columns are not looked at. What reaches the
    driver is the code's table (one row per id of the vocabulary), the sampled keys, and one sum a shard.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokens = stored(token_rows(docs, tokenizer_path, end_id, width), "token-rows")
    counts = id_counts(tokens, vocabulary, width)
    bits = code_lengths(counts, max(MOST_BITS, int(np.ceil(np.log2(max(2, (counts > 0).sum()))))))
    codes = canonical_codes(bits)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // SHARD_IDS))
    bounds = shard_bounds(tokens, shards)
    sums = dict(_dealt(tokens, bounds, ["n"]).groupBy("shard").agg(F.sum("n")).collect())
    firsts = np.concatenate([[0], np.cumsum([sums.get(s, 0) for s in range(len(bounds) + 1)])])
    code = [(int(i), int(counts[i]), int(bits[i])) for i in np.flatnonzero(counts)]
    spark.createDataFrame(code, "id long, count long, bits int").coalesce(1).write.parquet(f"{path}/code")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, start, held, size = None, 0, 0, [], 0

        def done() -> pa.RecordBatch:
            block = build_block(shard, number, start, held, codes, bits)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for batch in batches:
            for doc_id, ids, own in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                if own != shard:                         # rows of a task are those of one shard, or of some in turn
                    if held:
                        yield done()
                    shard, number, start, held, size = own, 0, int(firsts[own]), [], 0
                held.append((doc_id.as_py(), np.frombuffer(ids.as_buffer().to_pybytes(), width)))
                size += len(held[-1][1])
                if size >= BLOCK_IDS:
                    yield done()
                    number, start, held, size = number + 1, start + size, [], 0
        if held:
            yield done()

    ordered = (_dealt(tokens, bounds, ["doc_id", "ids"]).repartitionById(len(bounds) + 1, F.col("shard"))
               .sortWithinPartitions("shard", "at", "tie", "salt").select("doc_id", "ids", "shard"))
    # the text sink writes a string's bytes as they are, so the files hold the blocks' own bytes
    (ordered.mapInArrow(build, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", BLOCKS_A_FILE).option("lineSep", "\n").text(f"{path}/ids"))


# ---- reading

def read_code(spark: SparkSession, path: str) -> np.ndarray:
    """The lengths by id."""
    rows = spark.read.schema("id long, count long, bits int").parquet(f"{path}/code").select("id", "bits").collect()
    bits = np.zeros(max((r[0] for r in rows), default=0) + 1, np.uint8)
    for i, b in rows:
        bits[i] = b
    return bits


def _from_blocks(spark: SparkSession, path: str, rows_of, schema: str) -> DataFrame:
    bits = read_code(spark, path)
    files = spark.read.format("binaryFile").load(f"{path}/ids").filter("length > 0").select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(bits)
        for batch in batches:
            for content in batch.column(0):
                for block in blocks(content.as_buffer().to_pybytes()):
                    found = rows_of(block, table)
                    if found is not None and found.num_rows:
                        yield found

    return files.mapInArrow(run, schema)


def _places(block: Block) -> tuple[pa.Array, np.ndarray]:
    """The documents' ids, and where each begins in the block."""
    return pa.array(block.doc_ids, pa.int64(), mask=block.null_ids.astype(bool)), np.cumsum(block.lengths) - block.lengths


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<long>) of every document of the files; start counts the ids before it."""
    def rows_of(block: Block, table) -> pa.RecordBatch:
        doc_ids, at = _places(block)
        ids = pa.ListArray.from_arrays(pa.array(np.append(at, block.n_ids).astype(np.int32)),
                                       pa.array(block.ids(table).astype(np.int64)))
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(at + block.start), ids], names=["doc_id", "start", "ids"])

    return _from_blocks(spark, path, rows_of, "doc_id long, start long, ids array<long>")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, ids): the ids of places ``first`` to ``last`` (exclusive) among all, in parts. Of a block only
    what lies between the checkpoint before ``first`` and ``last`` is decoded."""
    def rows_of(block: Block, table) -> pa.RecordBatch | None:
        low, high = max(0, first - block.start), min(block.n_ids, last - block.start)
        if low >= high:
            return None
        ids = pa.array([block.ids(table, low, high).astype(np.int64)], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([block.start + low]), ids], names=["start", "ids"])

    return _from_blocks(spark, path, rows_of, "start long, ids array<long>")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decoded ids."""
    def rows_of(block: Block, table) -> pa.RecordBatch:
        doc_ids, at = _places(block)
        ids = block.ids(table).astype("<u4")
        sums = [zlib.crc32(ids[a:a + n]) for a, n in zip(at.tolist(), block.lengths.tolist())]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(at + block.start), pa.array(block.lengths),
                                           pa.array(sums, pa.int64())],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _from_blocks(spark, path, rows_of, "doc_id long, start long, n_tokens long, ids_crc32 long")
