"""Incremental feature-cache fill as a Structured Streaming job.

New index files (manifest rows: key + input columns) dropped into a folder are picked
up by a file stream; each micro-batch runs the same get-or-compute step as the batch
path (``left_anti`` against the cache -> extractor -> append). A replayed batch after a
failure finds the vectors that were committed already cached and computes the rest. A batch
whose append failed half way may leave rows behind and append them again; reads are not
affected, as they take one current row per key. The checkpoint location lives under the shared ``spark.checkpoint.dir``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import Extractor, fill_cache
from ..session import scratch_path


def start_feature_stream(spark: SparkSession, index_dir: str, index_schema: str, cache_path: str,
                         key_col: str, input_cols: list[str], factory: Callable[[], Extractor],
                         model_version: str, dim: int, checkpoint: str | None = None,
                         available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    stream = (spark.readStream.schema(index_schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(index_dir))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        fill_cache(batch.sparkSession, batch, cache_path, key_col, input_cols, factory,
                   model_version, dim)

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "feature-stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
