"""Session helpers: a tuned local session for tests/bench, and the shared scratch area.

On a cluster the caller owns the session; nothing here overrides settings that are
already present in ``spark``'s configuration once it exists. The scratch area is always the
folder named by ``spark.checkpoint.dir`` so that it is shared by every executor; a private
temporary folder is only made for a local master. ``build_session`` is for local runs only.
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that shape the physical plans this package relies on.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partial top-k before the shuffle for row_number() <= k filters
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "vitrine") -> SparkSession:
    """Session for local runs. Spark UI stays off; event logs are not written."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in PLAN_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where none is set, a local master gets a private
    one; any other master is refused, as executors would not see each other's files."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
        conf = tempfile.mkdtemp(prefix="vitrine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", conf)     # informational only
        except Exception:  # noqa: BLE001 - a core conf some sessions refuse to change
            pass
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vitrine-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder, in this application's own part."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, through the file system that holds them. For the
    end of a run: results that were not written elsewhere can't be read after it."""
    delete_folder(spark, _scratch_root(spark))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vitrine`` importable in the Python workers (``addPyFile`` of a zip of the
    package, once per SparkContext) — what ``--py-files`` does for a submitted job. Tasks
    that run Python (``mapInPandas``) unpickle functions of this package by reference."""
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="vitrine-pyfiles-")      # driver-side build artifact
    zip_path = os.path.join(out_dir, "vitrine.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(root, fn)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zip_path)
    _SHIPPED.add(id(sc))
