"""Dense position within a group, without sending a group to one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` moves every row of a group to one task:
with one group holding a third of the rows that task is the whole job. Here the rows are
range-partitioned on (g, k) instead (balanced by sampling, so a hot group spans many
partitions), each partition numbers its rows in sort order, and a small table of
per-(partition, group) counts supplies each partition's starting offset within the group.

The numbered rows are materialised once with a reliable ``checkpoint()`` (the shared
``spark.checkpoint.dir``) before the counts are taken: partition ids and positions are
only meaningful for one physical execution, and AQE may coalesce the same shuffle
differently in two branches of a plan. After the checkpoint both sides read the same
fixed rows, and a lost executor cannot renumber them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

def index_within_group(df: DataFrame, group_cols: list[str], order_cols: list[str],
                       index_col: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based position of each row inside its group in
    ``order_cols`` order (ties broken arbitrarily but consistently)."""
    keys = [*group_cols, *order_cols]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    pieces = (tagged.groupBy("_pid", *group_cols)
              .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    w = (Window.partitionBy(*group_cols).orderBy("_pid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # one row per (partition, group) piece: at most partitions + groups rows
    offsets = (pieces.withColumn("_offset", F.sum("_cnt").over(w) - F.col("_cnt"))
               .select("_pid", *group_cols, "_first", "_offset"))
    # AQE broadcasts the offsets by their measured size; a shuffle join on (partition, group)
    # is not skewed by a hot group either, which spans many partitions
    return (tagged.join(offsets, ["_pid", *group_cols])
            .withColumn(index_col, (F.col("_pos") - F.col("_first") + F.col("_offset")).cast("bigint"))
            .drop("_pid", "_pos", "_first", "_offset"))
