"""Fact-to-dimension join that stays balanced when one key holds a large share of rows.

A shuffle join sends every row of a key to one task; with one product holding a third of
the image rows that task is the job. AQE's skew-join split only applies when both join
inputs are separate shuffle stages, which a dimension side built from co-partitioned
semi joins is not (and a ``repartition`` on the same key is optimised away). So hot keys
are salted explicitly, per key and exactly:

1. rows per key are counted (map-side partial aggregation; the shuffle carries one row
   per key and task);
2. a key with more than ``hot_rows`` rows gets ``ceil(rows / hot_rows)`` salt buckets.
   At most ``MAX_HOT_KEYS`` keys are, so this table is small by construction and is
   broadcast; keys beyond those have too small a share to matter, and take one bucket;
3. each fact row of a hot key takes the bucket ``xxhash64(row) mod buckets`` (cold rows:
   bucket 0); the dimension rows of a hot key are repeated once per bucket (hot keys x
   buckets rows: bounded);
4. one ordinary equi-join on (key, bucket): every (key, bucket) group holds about
   ``hot_rows`` fact rows or fewer, and AQE may still broadcast the dimension side from
   its measured size.

The counts read the fact a second time unless the fact is itself a shuffle output (a
DISTINCT or aggregate), whose stage AQE reuses; with no hot key AQE drops the join to the
empty key table at runtime. No row is dropped or duplicated.

A fact row without a key matches nothing, but a left join keeps it, and a shuffle by the key alone
would bring all of them to one task. Such rows are salted too, whatever their number.

``spread_join`` does without counts: both sides get a salt that is zero for every row with a key, so
that both are shuffled for this join alone, and AQE may split a partition that turns out large. It is
the one to take where counting would run an expensive fact twice.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 100_000                       # of 16 bytes each: what is broadcast has a bound
NULL_SHARES = 1 << 16                        # that rows without a key are salted into


def row_spread(df: DataFrame):
    """A number of each row, the same however often a task runs: rows that are alike differ by the
    partition they are in."""
    return F.xxhash64(*[F.col(c) for c, t in df.dtypes if "map<" not in t], F.spark_partition_id())


def hot_keys(fact: DataFrame, key: str, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(key, _buckets) for keys with more than hot_rows rows, the ``MAX_HOT_KEYS`` hottest at most
    (a key beyond these has under a MAX_HOT_KEYS-th of the rows)."""
    return (fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > hot_rows).orderBy(F.desc("_rows"), key).limit(MAX_HOT_KEYS)
            .select(key, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_buckets")))


def salted_sides(fact: DataFrame, dim: DataFrame, key: str,
                 hot_rows: int = DEFAULT_HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension with a ``_salt`` column, ready to join on (key, _salt)."""
    hot = F.broadcast(hot_keys(fact, key, hot_rows))
    f = (fact.withColumn("_spread", row_spread(fact)).join(hot, key, "left")
         .withColumn("_salt", F.when(F.col("_buckets").isNotNull(), F.pmod(F.col("_spread"), F.col("_buckets")))
                     .when(F.col(key).isNull(), F.pmod(F.col("_spread"), F.lit(NULL_SHARES))).otherwise(F.lit(0)).cast("int"))
         .drop("_buckets", "_spread"))
    d = (dim.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.when(F.col("_buckets").isNotNull(),
                                               F.sequence(F.lit(0), F.col("_buckets") - 1))
                                        .otherwise(F.array(F.lit(0)))))
         .drop("_buckets"))
    return f, d


def skew_split_join(fact: DataFrame, dim: DataFrame, key: str,
                    hot_rows: int = DEFAULT_HOT_ROWS, how: str = "inner") -> DataFrame:
    """Equi-join ``fact JOIN dim USING (key)``, balanced under hot keys; ``how`` is inner, left
    or left_semi (a fact row meets every dimension row of its key, whatever its salt)."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"not a join that keeps to the fact's side: {how}")
    f, d = salted_sides(fact, dim, key, hot_rows)
    return f.join(d, [key, "_salt"], how).drop("_salt")


def spread_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The same join without counts: rows without a key are salted, and both sides are shuffled for this join
    alone, so that AQE may split the partitions of a hot key by their measured size."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"not a join that keeps to the fact's side: {how}")
    share = F.when(F.col(key).isNull(), 1 + F.pmod(row_spread(fact), F.lit(NULL_SHARES))).otherwise(F.lit(0))
    # zero, but not a literal: the planner would do without it and reuse a partitioning that can't be split
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return (fact.withColumn("_salt", share.cast("int")).join(dim.withColumn("_salt", zero.cast("int")), [key, "_salt"], how)
            .drop("_salt"))
