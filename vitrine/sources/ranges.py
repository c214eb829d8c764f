"""Large text files read by several tasks: JSON arrays, and records of two lines.

A file is cut into byte ranges, and each range is a row that some task reads. What begins in a range is the
range's, and is read on past its end if need be, so nothing is met twice or lost, wherever the cuts are.

A range of a JSON array can't tell by itself whether it begins inside a string, or how deep. So every range is
scanned first for what it does to both (quotes, and brackets under either assumption); the sums of the
ranges before it then give its state, and a second scan finds the elements.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import ship_package, stored
from . import listing as LS

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20                        # scanned at once
BATCH_BYTES = 8 << 20                        # handed on at once


def file_ranges(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(path, source, length, start, *partition columns): the ranges of the files below the paths, dealt to as
    many tasks as there are bytes for. Files without bytes have none."""
    step = range_bytes or RANGE_BYTES
    files = spark.read.format("binaryFile").load(paths)
    own = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    files = files.select("path", F.col("_metadata.file_path").alias("source"), "length", *own)
    n = files.agg(F.sum(F.ceil(F.col("length") / step))).first()[0] or 1
    ranges = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))))
    return ranges.repartition(_tasks(spark, int(n)), "path", "start")


def _tasks(spark: SparkSession, ranges: int) -> int:
    """A task a range while they are few, some ranges a task beyond."""
    return max(1, min(ranges, 4 * spark.sparkContext.defaultParallelism + ranges // 4))


class Reader:
    """A file's bytes from a place on, chunk by chunk."""

    _SYSTEMS: dict = {}

    def __init__(self, path: str):
        scheme, authority, at = LS.parts_of(path)
        if (scheme, authority) not in self._SYSTEMS:
            self._SYSTEMS[scheme, authority] = LS.open_filesystem(path)
        fs, prefix, _ = self._SYSTEMS[scheme, authority]
        self.file = fs.open_input_file(prefix + at)

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.file.close()

    def chunks(self, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        """(offset, bytes) up to ``end``."""
        while start < end:
            data = self.file.read_at(min(CHUNK_BYTES, end - start), start)
            if not data:
                return
            yield start, data
            start += len(data)

    def byte_before(self, at: int) -> bytes:
        return self.file.read_at(1, at - 1) if at else b""


# ---- JSON arrays

QUOTE, SLASH, COMMA = b'"\\,'
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARK = _STEP != 0
_MARK[COMMA] = True


class Scan:
    """Reads chunks in order, knowing whether it is inside a string, how deep, and whether the last byte was
    an escape. ``feed`` gives the places of the marks that part the elements of the outermost array: its
    opening bracket, the commas at depth one, its closing bracket."""

    def __init__(self, inside: int = 0, depth: int = 0):
        self.inside, self.depth, self.escape = inside, depth, False
        self.quotes, self.outer, self.inner = 0, 0, 0    # brackets where quotes so far are even, and odd

    def feed(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(places in the chunk, whether one closes the array)."""
        b = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(b == QUOTE)
        if self.escape or SLASH in data:
            slash = b == SLASH
            last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(b))))       # the last other byte so far
            if self.escape:                              # an escape before the chunk
                last[last < 0] = -2
            runs = np.where(quotes > 0, quotes - 1 - last[np.maximum(quotes - 1, 0)], int(self.escape))
            quotes = quotes[runs % 2 == 0]
            tail = len(b) - 1 - int(last[-1])
            self.escape = tail % 2 == 1
        marks = np.flatnonzero(_MARK[b])
        odd = (np.searchsorted(quotes, marks) + self.quotes) % 2
        step = _STEP[b[marks]].astype(np.int64)
        self.outer += int(step[odd == 0].sum())
        self.inner += int(step[odd == 1].sum())
        out = odd == self.inside
        marks, step = marks[out], step[out]
        depth = self.depth + np.cumsum(step)
        self.quotes += len(quotes)
        if len(depth):
            self.depth = int(depth[-1])
        opens, commas, closes = (step > 0) & (depth == 1), (step == 0) & (depth == 1), (step < 0) & (depth == 0)
        parts = opens | commas | closes
        return marks[parts], closes[parts]


def _aligned(reader: Reader, at: int, length: int) -> int:
    """The first place from ``at`` on that no backslash stands before, where ranges meet."""
    while 0 < at < length and reader.byte_before(at) == b"\\":
        at += 1
    return at


def _emit(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)


def _mapped(df: DataFrame, make, fields: list[T.StructField], keep: list[str]) -> DataFrame:
    """``make`` from a row's dict to tuples of ``fields``, behind the row's ``keep`` columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*[df.schema[c] for c in keep], *fields])
    out, names = to_arrow_schema(schema), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[c] for c in keep)
                for found, n in make(row):
                    held.append((*own, *found))
                    size += n
                    if size >= BATCH_BYTES:
                        yield _emit(held, names, out)
                        held, size = [], 0
        if held:
            yield _emit(held, names, out)

    return df.mapInArrow(run, schema)


def json_elements(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(path, source, *partition columns, offset, element): the text of each element of the files' outermost
    arrays, in UTF-8, and where it begins. A file that is one object instead is its only element. White space
    alone, or an empty array, has none. An element is held whole by the task that reads its first byte."""
    ship_package(spark)
    step = range_bytes or RANGE_BYTES
    ranges = file_ranges(spark, paths, step)
    own = [c for c in ranges.columns if c not in ("length", "start")]

    def effect(row: dict):
        with Reader(row["path"]) as reader:
            start = _aligned(reader, row["start"], row["length"])
            scan = Scan()
            for _, data in reader.chunks(start, _aligned(reader, min(row["start"] + step, row["length"]), row["length"])):
                scan.feed(data)
            yield (scan.quotes % 2, scan.outer, scan.inner), 0

    def elements(row: dict):
        with Reader(row["path"]) as reader:
            if row["start"] == 0:
                lead = b"".join(d for _, d in zip(range(1), (d for _, d in reader.chunks(0, row["length"]))))
                if not lead.lstrip().startswith(b"["):
                    whole = b"".join(d for _, d in reader.chunks(0, row["length"])).strip()
                    if whole:
                        yield (0, whole.decode()), len(whole)
                    return
            elif not row["array"]:
                return
            start = _aligned(reader, row["start"], row["length"])
            stop = _aligned(reader, min(row["start"] + step, row["length"]), row["length"])
            scan, begun, held = Scan(row["inside"], row["depth"]), None, []
            for at, data in reader.chunks(start, row["length"]):
                if begun is None and at >= stop:
                    return
                places, closes = scan.feed(data)
                before = 0
                for place, close in zip(places.tolist(), closes.tolist()):
                    if begun is not None:
                        text = b"".join([*held, data[before:place]])
                        if text.strip():
                            yield (begun, text.strip().decode()), len(text)
                    begun, held, before = None if close or at + place >= stop else at + place + 1, [], place + 1
                    if begun is None and at + place >= stop:
                        return
                if begun is not None:
                    held.append(data[before:])

    keep = [*own, "length", "start"]
    single = ranges.filter(F.col("length") <= step)
    known = single.select(*keep, F.lit(0).alias("inside"), F.lit(0).cast("long").alias("depth"), F.lit(True).alias("array"))
    many = stored(_mapped(ranges.filter(F.col("length") > step), effect,
                          [T.StructField("odd", T.IntegerType()), T.StructField("outer", T.LongType()), T.StructField("inner", T.LongType())],
                          keep), "json-ranges")
    ahead = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = many.withColumn("inside", F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2)
    here = F.when(F.col("inside") == 0, F.col("outer")).otherwise(F.col("inner"))
    states = states.withColumn("depth", F.coalesce(F.sum(here).over(ahead), F.lit(0)))
    states = states.select(*keep, F.col("inside").cast("int").alias("inside"), "depth", F.lit(True).alias("array"))
    # few rows of numbers; dealt anew, as the window brought a file's together
    n = many.count()
    rows = known.union(states.repartition(_tasks(spark, n), "path", "start")) if n else known
    return _mapped(rows, elements, [T.StructField("offset", T.LongType()), T.StructField("element", T.StringType())], own)


# ---- records of two lines

PAIR_LINE = re.compile(rb'(?m)^  target_class(?:: (\d+)|_string: "([^"\n]*)")')


def class_pairs(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(path, offset, class_id, uid): each ``target_class`` line whose next line of either kind is a
    ``target_class_string``. An id is read by the range its line begins in, and so is what follows it up to
    the next such line, however far behind the range's end."""
    ship_package(spark)
    step = range_bytes or RANGE_BYTES
    ranges = file_ranges(spark, paths, step)

    def pairs(row: dict):
        stop, length = min(row["start"] + step, row["length"]), row["length"]
        with Reader(row["path"]) as reader:
            at, data, waiting = row["start"], b"", None
            skip = at > 0 and reader.byte_before(at) != b"\n"            # the rest of a line that another range has
            for offset, more in reader.chunks(at, length):
                data += more
                cut = len(data) if offset + len(more) >= length else data.rfind(b"\n") + 1
                lines = data[:cut]
                for found in PAIR_LINE.finditer(lines, lines.find(b"\n") + 1 if skip else 0):
                    place = at + found.start()
                    if found[2] is not None and waiting is not None:
                        yield (*waiting, found[2].decode()), 64 + len(found[2])
                    waiting = None
                    if place >= stop:
                        return
                    if found[1] is not None:
                        waiting = place, int(found[1])
                skip = skip and not cut
                at, data = at + cut, data[cut:]
                if at >= stop and waiting is None:
                    return

    fields = [T.StructField("offset", T.LongType()), T.StructField("class_id", T.IntegerType()), T.StructField("uid", T.StringType())]
    return _mapped(ranges, pairs, fields, ["path"])

