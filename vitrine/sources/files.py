"""File sources: JSON-array manifests, label lists, lookup text, image folders, CSV vectors."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as FV
from ..functions.text import base_name, label_from_path, normalize_label
from ..operators import joins as JN
from . import listing as LS
from . import ranges as RG

MANIFEST_SCHEMA = ("productId bigint, imageUrl string, imagePath string, colorNormalId int, "
                   "productType string, dressLengthValue string")


def read_json_arrays(spark: SparkSession, paths: str | list[str], schema: str = MANIFEST_SCHEMA,
                     source_col: str = "source_file", array_files: bool = True,
                     other_keys: bool = True) -> DataFrame:
    """Files holding one JSON array each (``array_files``) or JSON lines. An absent key
    reads as NULL; the file each row came from is kept (e.g. the label a per-label file
    stands for). Keys that ``schema`` doesn't list come along with the types the files show,
    unless ``other_keys`` is off; finding those reads the files once more, an array file by one task.
    With it off, an array is read by as many tasks as it has ranges (``ranges.json_elements``); what is not
    an object is a row of NULLs."""
    known = T._parse_datatype_string(schema)
    if array_files and not other_keys and all(map(LS.readable, [paths] if isinstance(paths, str) else paths)):
        found = RG.json_elements(spark, paths)
        parts = [c for c in found.columns if c not in ("path", "source", "offset", "element")]
        names = {f.name.lower() for f in known}
        return found.select(F.from_json("element", known).alias("_row"), *[c for c in parts if c.lower() not in names],
                            F.col("source").alias(source_col)).select(
            *[F.col("_row")[f.name].alias(f.name) for f in known], *[c for c in parts if c.lower() not in names], source_col)
    reader = spark.read.option("multiLine", array_files)
    if other_keys:
        names = {f.name for f in known}
        found = [f for f in reader.json(paths).schema if f.name not in names and f.name != "_corrupt_record"]
        known = T.StructType([*known, *found])
    return reader.schema(known).json(paths).withColumn(source_col, F.col("_metadata.file_path"))


def read_label_list(spark: SparkSession, path: str) -> DataFrame:
    """(label_id, label): line index -> label. Only the final line break is dropped (a
    label's own last character is never cut)."""
    whole = spark.read.text(path, wholetext=True)
    body = F.regexp_replace(F.col("value"), r"\r?\n$", "")
    return (whole.select(F.posexplode(F.split(body, "\r?\n")).alias("label_id", "label"))
            .withColumn("label_id", F.col("label_id").cast("int")))


def read_synset_names(spark: SparkSession, path: str) -> DataFrame:
    """``uid<TAB>human name`` lines -> (uid, name)."""
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), "\t", 2)
    return (lines.filter(F.col("value") != "")
            .select(parts[0].alias("uid"), F.element_at(parts, 2).alias("name")))


def read_class_uids(spark: SparkSession, path: str) -> DataFrame:
    """``target_class: N`` / ``target_class_string: "uid"`` line pairs -> (class_id, uid).

    A uid belongs to the last id above it; an id without a uid, and a uid without an id, make
    no row. Of several uids of an id the last in its file holds (of several files, the one of
    the largest path). A file is read by as many tasks as it has ranges."""
    pairs = RG.class_pairs(spark, path)
    return pairs.groupBy("class_id").agg(F.max_by("uid", F.struct("path", "offset")).alias("uid"))


def list_images(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """(label, dir, path, base_name, length) of image files exactly one folder below ``root``
    (files in the root itself and in nested folders are not images of a label); the file
    bytes are not read. label = the normalised folder name."""
    df = _one_folder_below(spark, root, extensions)
    return (df.withColumn("dir", label_from_path("path"))
            .withColumn("label", normalize_label("dir"))
            .withColumn("base_name", base_name("path"))
            .select("label", "dir", "path", "base_name", "length"))


def _one_folder_below(spark: SparkSession, root: str, extensions: list[str] | None) -> DataFrame:
    """(path, length): through tasks where ``listing`` can read the root's file system, else through Spark's own
    file listing, whose file statuses pass through the driver."""
    exts = extensions or FV.IMAGE_EXTENSIONS
    if LS.readable(root):
        return LS.list_folders(spark, root, exts)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(exts) + "}")
             .load(root.rstrip("/") + "/*/*").select("path", "length"))
    # the pattern also reaches into folders below that: keep paths of two more segments than the root
    depth = len(LS.parts_of(root.rstrip("/"))[2].split("/")) + 2
    return files.filter(F.size(F.split(bare_path(F.col("path")), "/")) == depth)


def label_collisions(listing: DataFrame) -> DataFrame:
    """Labels that several folders normalise to (e.g. ``Long_Maxi`` and ``long-maxi``):
    (label, dirs). Their images are merged under the one label; this is the report."""
    return (listing.groupBy("label").agg(F.sort_array(F.collect_set("dir")).alias("dirs"))
            .filter(F.size("dirs") > 1))


def read_image_bytes(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """(path, length, content) of the images below ``root``, packed into tasks by size."""
    return _with_bytes(spark, _one_folder_below(spark, root, extensions), root)


def _with_bytes(spark: SparkSession, rows: DataFrame, root: str, file_col: str = "path", length_col: str = "length") -> DataFrame:
    """Rows with their file's ``content``."""
    if LS.readable(root):
        return LS.read_files(rows, file_col, length_col)
    # a file system that only Spark's readers know: the bytes are joined, and shuffled
    files = spark.read.format("binaryFile").load(root.rstrip("/") + "/*/*").select(F.col("path").alias("_path"), "content")
    return rows.join(files, F.col(file_col) == F.col("_path"), "left").drop("_path")


def bare_path(path: Column) -> Column:
    """A path without scheme and authority: ``s3a://bucket/a/b``, ``file:/a/b`` and ``/a/b`` compare
    below the same root."""
    return F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def attach_image_bytes(manifest: DataFrame, spark: SparkSession, root: str, path_col: str = "image_path",
                       extensions: list[str] | None = None) -> DataFrame:
    """Manifest rows with the bytes of their image file (``content``; NULL when the file
    is absent). The paths are joined with the folder's listing, without scheme and authority, and only then
    are the files read: once for all rows of a file in a task, and behind every shuffle, so that no exchange
    carries bytes. Rows without a path go around the join."""
    names = manifest.columns
    known = manifest.filter(F.col(path_col).isNotNull())
    files = _one_folder_below(spark, root, extensions).select(
        bare_path(F.col("path")).alias("_p"), F.col("path").alias("_file"), F.col("length").alias("_length"))
    matched = JN.skew_split_join(known.withColumn("_p", bare_path(F.col(path_col))), files, "_p", how="left")
    rows = matched.select(*names, "_file", "_length").union(
        manifest.filter(F.col(path_col).isNull()).select("*", F.lit(None).cast("string"), F.lit(None).cast("bigint")))
    return _with_bytes(spark, rows, root, "_file", "_length").select(*names, "content")


def read_vector_text(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``key<sep>v1,v2,...`` lines -> (key, features array<float>)."""
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), sep, 2)
    return lines.select(parts[0].alias("key"),
                        F.split(F.element_at(parts, 2), ",").cast("array<float>").alias("features"))
