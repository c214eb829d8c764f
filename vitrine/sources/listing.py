"""Image folders, listed and read by tasks.

``image_folders`` is a Python data source: the driver learns the names of the folders below the root, and
each task lists the files of its share of them, so that no file's status passes through the driver. Bytes
are read where they are wanted: ``read_files`` deals rows to tasks by the bytes they will hold, before
any is read, and a task reads each file of its rows once, in ranges.

Paths are read through ``pyarrow.fs``, which knows local paths, ``s3``, ``gs``, ``abfs`` and, where its
library is installed, ``hdfs``.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.joins import MAX_HOT_KEYS
from ..session import ship_package

FOLDERS_A_TASK = 16
PACK_BYTES = 128 << 20                       # of file bytes that one task hands on
RANGE_BYTES = 8 << 20                        # read at once
BATCH_BYTES = 16 << 20                       # handed on at once

_URI = re.compile("^([a-zA-Z][a-zA-Z0-9+.-]*):(//[^/]*)?(.*)$", re.S)
_OTHER_NAMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def parts_of(path: str) -> tuple[str, str, str]:
    """(scheme, //authority, path); a path without a scheme is a local one."""
    found = _URI.match(path)
    if not found:
        return "file", "", os.path.abspath(path)
    return found[1], found[2] or "", found[3]


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, prefix of its paths there, what Spark puts in front of them)."""
    scheme, authority, _ = parts_of(path)
    if scheme == "file":
        return pafs.LocalFileSystem(), "", "file:"
    fs, at = pafs.FileSystem.from_uri(f"{_OTHER_NAMES.get(scheme, scheme)}:{authority}/")
    return fs, at.rstrip("/"), f"{scheme}:{authority}"


def readable(path: str) -> bool:
    """Whether ``pyarrow.fs`` has the path's file system."""
    try:
        open_filesystem(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _hidden(name: str) -> bool:
    """File names that Spark's own readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


class Folders(InputPartition):
    def __init__(self, folders: list[str]):
        self.folders = folders


class ImageFolders(DataSource):
    """``spark.read.format("image_folders").option("path", root).option("extensions", "jpg,png")``: (path, length)
    of the files with one of the extensions exactly one folder below the root, whatever their names hold. A
    file without bytes is listed too (Spark's file readers pass over it)."""

    @classmethod
    def name(cls) -> str:
        return "image_folders"

    def schema(self) -> str:
        return "path string, length long"

    def reader(self, schema: T.StructType) -> "ImageFoldersReader":
        return ImageFoldersReader(self.options["path"], self.options.get("extensions", "").split(","))


class ImageFoldersReader(DataSourceReader):
    def __init__(self, root: str, extensions: list[str]):
        self.root, self.extensions = root.rstrip("/") or "/", tuple(f".{e}" for e in extensions if e)

    def _list(self, folder: str) -> list[pafs.FileInfo]:
        fs, prefix, _ = open_filesystem(self.root)
        return fs.get_file_info(pafs.FileSelector(prefix + folder, allow_not_found=False))

    def partitions(self) -> list[Folders]:
        top = parts_of(self.root)[2]
        names = sorted(f.base_name for f in self._list(top) if f.type == pafs.FileType.Directory and not f.base_name.startswith("."))
        below = [f"{top.rstrip('/')}/{n}" for n in names]
        return [Folders(below[i:i + FOLDERS_A_TASK]) for i in range(0, len(below), FOLDERS_A_TASK)] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        front = open_filesystem(self.root)[2]
        for folder in partition.folders:
            files = [f for f in self._list(folder) if f.type == pafs.FileType.File
                     and f.base_name.endswith(self.extensions) and not _hidden(f.base_name)]
            yield pa.RecordBatch.from_arrays([pa.array([f"{front}{folder}/{f.base_name}" for f in files], pa.string()),
                                              pa.array([f.size for f in files], pa.int64())], names=["path", "length"])


def list_folders(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """(path, length) of ``image_folders``."""
    ship_package(spark)
    spark.dataSource.register(ImageFolders)
    return spark.read.format("image_folders").option("path", root).option("extensions", ",".join(extensions)).load()


def read_whole(fs: pafs.FileSystem, path: str, length: int) -> bytes:
    """A file, range by range; shorter or longer than listed is an error."""
    held = []
    with fs.open_input_file(path) as f:
        if f.size() != length:
            raise OSError(f"{path} has {f.size()} bytes, {length} when listed")
        for at in range(0, length, RANGE_BYTES):
            held.append(f.read_at(min(RANGE_BYTES, length - at), at))
    return b"".join(held)


def read_files(rows: DataFrame, file_col: str, length_col: str, content_col: str = "content") -> DataFrame:
    """``rows`` with the bytes of their file; NULL where ``file_col`` is.

    Rows are dealt by a hash of their file to as many tasks as their bytes fill ``PACK_BYTES``; a file whose rows
    hold more than that together is dealt to several, by a hash of the row. What is shuffled is the rows as
    they come; the bytes are read behind the shuffle. Rows without a file don't take part in it."""
    spark = rows.sparkSession
    ship_package(spark)
    names, schema = rows.columns, T.StructType([*rows.schema.fields, T.StructField(content_col, T.BinaryType())])
    have = rows.filter(F.col(file_col).isNotNull())
    sums = have.groupBy(F.col(file_col).alias("_hot_file")).agg((F.count(F.lit(1)) * F.max(length_col)).alias("_bytes"))
    total = sums.agg(F.sum("_bytes")).first()[0] or 0
    tasks = max(1, -(-total // PACK_BYTES))
    hot = (sums.filter(F.col("_bytes") > PACK_BYTES).orderBy(F.desc("_bytes"), "_hot_file").limit(MAX_HOT_KEYS)
           .select("_hot_file", F.ceil(F.col("_bytes") / PACK_BYTES).alias("_shares")))
    spread = F.xxhash64(*[F.col(c) for c, t in rows.dtypes if "map" not in t])
    dealt = (have.join(F.broadcast(hot), F.col(file_col) == F.col("_hot_file"), "left")
             .withColumn("_share", F.coalesce(F.pmod(spread, F.col("_shares")), F.lit(0)))
             .repartition(int(tasks), file_col, "_share").sortWithinPartitions(file_col).select(*names))
    at_file, at_length = names.index(file_col), names.index(length_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems, last, content = {}, None, b""
        for batch in batches:
            start, held, size = 0, [], 0
            for i, (file, length) in enumerate(zip(batch.column(at_file).to_pylist(), batch.column(at_length).to_pylist())):
                if file != last:
                    scheme, authority, path = parts_of(file)
                    if (scheme, authority) not in systems:
                        systems[scheme, authority] = open_filesystem(file)
                    fs, prefix, _ = systems[scheme, authority]
                    last, content = file, read_whole(fs, prefix + path, length)
                held.append(content)
                size += length
                if size >= BATCH_BYTES:
                    yield _with(batch.slice(start, i + 1 - start), held)
                    start, held, size = i + 1, [], 0
            if held:
                yield _with(batch.slice(start), held)

    def _with(part: pa.RecordBatch, held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=[*names, content_col])

    none = rows.filter(F.col(file_col).isNull()).withColumn(content_col, F.lit(None).cast("binary"))
    return dealt.mapInArrow(run, schema).union(none)
