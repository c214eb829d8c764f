"""Image folders listed and read by tasks."""
import os

import pytest
from pyspark.sql import functions as F

from vitrine.sources import files as SRC
from vitrine.sources import listing as LS

NAMES = ["a.jpg", "b b.jpg", "per%20cent.jpg", "hash#tag.jpg", "q?mark.jpg", "ünïcode 日本.jpeg", "plus+&=.JPG", "_hidden.jpg", "_k=v.jpg",
         ".dot.jpg", "no_extension", "upper.JPEG", "other.png", "jpg", ".jpg", "quote'\"s.jpg", "br[a]{c}*.jpg", "x.jpg._COPYING_"]
FOLDERS = ["Mini", "Long Maxi", "empty", "%2F", "é=ü", "_under", "100%", "a#b", "deep"]


@pytest.fixture
def tree(tmp_dir):
    root = os.path.join(tmp_dir, "ro ot")
    for folder in FOLDERS:
        os.makedirs(os.path.join(root, folder))
        for i, name in enumerate(NAMES if folder != "empty" else []):
            with open(os.path.join(root, folder, name), "wb") as f:
                f.write(bytes([i]) * (i * 7))
    os.makedirs(os.path.join(root, "deep", "er.jpg"))
    for stray in ("top.jpg", "deep/er.jpg/nested.jpg"):
        with open(os.path.join(root, stray), "wb") as f:
            f.write(b"stray")
    return root


def expected(root):
    out = {}
    for folder in FOLDERS:
        for name in os.listdir(os.path.join(root, folder)):
            at = os.path.join(root, folder, name)
            if os.path.isfile(at) and name.endswith((".jpg", ".jpeg", ".JPG", ".JPEG")) and not LS._hidden(name):
                with open(at, "rb") as f:
                    out[f"file:{at}"] = f.read()
    return out


def test_names_and_nesting(spark, tree):
    """As the folders hold them, and as Spark's own listing has them, which passes over files without bytes."""
    want = expected(tree)
    rows = SRC.list_images(spark, tree).collect()
    assert {r.path: r.length for r in rows} == {p: len(b) for p, b in want.items()} and len(rows) == len(want)
    own = (spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,JPG,JPEG}").load(tree + "/*/*").select("path", "length")
           .filter(F.size(F.split(SRC.bare_path(F.col("path")), "/")) == len(tree.split("/")) + 2))
    assert {(r.path, r.length) for r in own.collect()} == {(r.path, r.length) for r in rows if r.length}
    assert {r.dir for r in rows} == set(FOLDERS) - {"empty"}


def test_file_systems_without_arrow_are_listed_by_spark(spark, tree, monkeypatch):
    usual = {(r.path, r.length) for r in SRC.list_images(spark, tree).collect() if r.length}
    some = spark.createDataFrame([(p,) for p, _ in usual] + [("/none",), (None,)], "image_path string")
    monkeypatch.setattr(LS, "readable", lambda path: False)
    assert {(r.path, r.length) for r in SRC.list_images(spark, tree).collect()} == usual
    got = {r.image_path: None if r.content is None else bytes(r.content) for r in SRC.attach_image_bytes(some, spark, tree).collect()}
    assert got == {**{p: b for p, b in expected(tree).items() if b}, "/none": None, None: None}


def test_driver_sees_folders_alone(spark, tree, monkeypatch):
    """The partitions are folder names; files are listed where they are read, no more than some folders a task."""
    monkeypatch.setattr(LS, "FOLDERS_A_TASK", 4)
    reader = LS.ImageFoldersReader(tree, ["jpg"])
    parts = reader.partitions()
    assert [len(p.folders) for p in parts] == [4, 4, 1]
    assert sorted(os.path.basename(f) for p in parts for f in p.folders) == sorted(FOLDERS)
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == sum(p.endswith(".jpg") for p in expected(tree))
    with pytest.raises(Exception, match="nowhere"):
        SRC.list_images(spark, tree + "/nowhere").count()


def test_empty_root(spark, tmp_dir):
    assert SRC.list_images(spark, tmp_dir).collect() == [] and SRC.read_image_bytes(spark, tmp_dir).collect() == []


def test_bytes_come_back(spark, tree):
    want = expected(tree)
    got = {r.path: bytes(r.content) for r in SRC.read_image_bytes(spark, tree).collect()}
    assert got == want
    rows = [(i, p) for i, p in enumerate(want)] + [(90, "/none.jpg"), (91, None), (92, next(iter(want))), (92, next(iter(want)))]
    rows += [(93, "s3a://bucket" + list(want)[1].removeprefix("file:")), (94, list(want)[2].removeprefix("file:"))]
    man = spark.createDataFrame(rows, "image_id int, image_path string")
    back = sorted((r.image_id, None if r.content is None else bytes(r.content)) for r in
                  SRC.attach_image_bytes(man, spark, tree).collect() if r.content is not None or r.image_id in (90, 91))
    bare = {k.removeprefix("file:"): v for k, v in want.items()}
    assert back == sorted((i, bare.get(SRC_bare(p))) for i, p in rows)


def SRC_bare(path):
    return None if path is None else LS.parts_of(path)[2]


def test_no_exchange_carries_bytes(spark, tree):
    """Above a shuffle there is no content: it is read behind the last one."""
    man = spark.createDataFrame([(1, "x")], "image_id int, image_path string")
    plan = SRC.attach_image_bytes(man, spark, tree)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Exchange" in physical and "binaryFile" not in physical
    lines = physical.split("\n")
    at = [i for i, line in enumerate(lines) if "MapInArrow" in line]
    assert at and not any("content" in line for line in lines[at[0] + 1:] if "Exchange" in line)
    assert not any("content" in line and "Exchange" in line for line in lines)


def test_large_files_and_hot_files(spark, tmp_dir, monkeypatch):
    """A file of many ranges comes back whole; one that a third of the rows share is read by several tasks."""
    os.makedirs(os.path.join(tmp_dir, "big"))
    body = os.urandom(3_000_001)
    for name, data in (("large.jpg", body), ("hot.jpg", b"h" * 1000), ("none.jpg", b"")):
        with open(os.path.join(tmp_dir, "big", name), "wb") as f:
            f.write(data)
    monkeypatch.setattr(LS, "RANGE_BYTES", 70_000)
    monkeypatch.setattr(LS, "BATCH_BYTES", 100_000)
    monkeypatch.setattr(LS, "PACK_BYTES", 200_000)
    man = spark.range(3000).select("id", F.concat(F.lit(os.path.join(tmp_dir, "big/")), F.when(F.col("id") % 3 == 0, "hot.jpg").when(
        F.col("id") == 1, "large.jpg").when(F.col("id") == 2, "none.jpg")).alias("image_path"))
    got = SRC.attach_image_bytes(man, spark, tmp_dir)
    rows = {r.id: r.content for r in got.collect()}
    assert len(rows) == 3000 and bytes(rows[1]) == body and bytes(rows[2]) == b"" and bytes(rows[3]) == b"h" * 1000 and rows[4] is None
    parts = got.filter("image_path like '%hot.jpg'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 2 and max(p["count"] for p in parts) < 700
