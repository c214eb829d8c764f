"""Mixing sources to target weights by Poisson replication.

A source with n documents and share w of the mixture has the mean rate w * total / n. Each document
is repeated k times, k drawn from the Poisson distribution of that mean by inverting it at a uniform
number from a hash of the whole row: no state, the same draw wherever and whenever a task runs, and rows
that share an id, or have none, are drawn each for itself.
A mean above ``MAX_RATE`` is drawn in parts, each from its own hash, whose sum is Poisson of the mean.
The copies are then put in a global order by another hash, which is uniform, so equal ranges of it make
equal partitions without a sample of the copies. All of it is DataFrame expressions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

SEED = "mix-1"
MAX_RATE = 64.0                              # mean of one part of a draw
BROADCAST_SOURCES = 2_000                    # a source's row has its name and about 200 numbers
UNIT = 2.0 ** -52


def uniform(seed: str, purpose: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of seed, purpose and parts (null: the word null)."""
    text = F.concat_ws(":", F.lit(seed), F.lit(purpose), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") * F.lit(UNIT)


def row_hash(docs: DataFrame) -> Column:
    """The MD5 of all of a row's values as text (null: the word null)."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(docs[c].cast("string"), F.lit("null")) for c in docs.columns]).cast("binary"))


def poisson_steps(rate: Column, most: float = MAX_RATE) -> Column:
    """The distribution function of a Poisson variable at 0, 1, 2, ..., until it is 1 within 52 bits."""
    last = int(most + 12 * most ** 0.5 + 40)
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        total = acc["sum"] + p
        # past the mean and without effect on the sum: done
        done = (k > rate) & (total == acc["sum"])
        return F.when(done, acc).otherwise(F.struct(p.alias("p"), total.alias("sum"),
                                                    F.concat(acc["steps"], F.array(total)).alias("steps")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(last)).cast("array<double>"), start, step)["steps"]


def target_rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None,
                 power: float = 0.5, size: float = 1.0) -> DataFrame:
    """(source, n_docs, rate, steps, parts, part_steps): one row for each source of ``docs``, null included.

    ``weights`` gives the sources' shares (they are scaled to sum to one over the sources there are; a
    source it doesn't name has none). Without it a source's share is in proportion to n_docs ** power.
    ``size`` is the mixture's expected number of documents over the input's. ``parts`` is how often
    ``MAX_RATE`` goes into the rate with something left; ``steps`` are those of what is left, and
    ``part_steps`` of one part (null where there are none).
    """
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        share = F.pow(F.col("n_docs").cast("double"), F.lit(float(power)))
    else:
        share = F.lit(0.0)
        for name in sorted(weights):
            share = F.when(F.col("source") == name, F.lit(float(weights[name]))).otherwise(share)
    counts = counts.withColumn("share", share)
    total = counts.agg(F.sum("share").alias("shares"), F.sum("n_docs").alias("docs"))
    rate = F.when(F.col("shares") > 0, F.lit(float(size)) * F.col("docs") * F.col("share")
                  / F.col("shares") / F.col("n_docs")).otherwise(F.lit(0.0))
    parts = F.greatest(F.ceil(F.col("rate") / MAX_RATE) - 1, F.lit(0)).cast("int")
    return (counts.join(F.broadcast(total)).withColumn("rate", rate).withColumn("parts", parts)   # total is one row
            .select("source", "n_docs", "rate", poisson_steps(F.col("rate") - F.col("parts") * MAX_RATE).alias("steps"), "parts",
                    F.when(F.col("parts") > 0, poisson_steps(F.lit(MAX_RATE))).alias("part_steps")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict[str, float] | None = None,
                power: float = 0.5, size: float = 1.0, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` as often as drawn, with ``copy`` (0, 1, ...) and ``rate``, globally shuffled.

    The order is by a hash of row and copy, so neither source nor input order shows in it; the partitions are
    in order, and so are the rows in each. A null id, or one that rows repeat, changes nothing; rows that are
    alike in every column are drawn alike. A null source is a source. A null or empty text is a document, and
    a very long one is hashed whole. Columns of ``docs`` called copy or rate keep their names and the new ones
    get underscores in front. An empty table gives none.
    """
    rates = target_rates(docs, source_col, weights, power, size)
    names = {x: free_name(docs, x) for x in ("copy", "rate", "steps", "parts", "part_steps", "drawn", "order_key", "mix_source", "row_key")}
    side = rates.select(F.col("source").alias(names["mix_source"]), F.col("rate").alias(names["rate"]),
                        *[F.col(x).alias(names[x]) for x in ("steps", "parts", "part_steps")])
    if rates.select("source").limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(side), docs[source_col].cast("string").eqNullSafe(F.col(names["mix_source"])))
    else:                                     # AQE splits a hot source, as the other side has one row of it
        joined = docs.join(side.hint("merge"), docs[source_col].cast("string").eqNullSafe(F.col(names["mix_source"])))
    row_key = F.col(names["row_key"])
    joined = joined.withColumn(names["row_key"], row_hash(docs))
    # the count is the number of steps at or below the uniform number
    drawn = joined.withColumn(names["drawn"], uniform(seed, "count", row_key))
    times = F.size(F.filter(F.col(names["steps"]), lambda s: s <= F.col(names["drawn"])))

    def part(acc: Column, k: Column) -> Column:
        at = uniform(seed, "part", k, row_key)
        return acc + F.size(F.filter(F.col(names["part_steps"]), lambda s: s <= at))

    parts = F.col(names["parts"])
    times = times + F.when(parts > 0, F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), part)).otherwise(F.lit(0))
    copies = drawn.withColumn(names["copy"], F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1))))
    order = F.col(names["order_key"])
    keyed = copies.withColumn(names["order_key"], uniform(seed, "order", row_key, F.col(names["copy"])))
    ranges = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (keyed.select(*docs.columns, names["copy"], names["rate"], names["order_key"], names["row_key"])
            .repartitionById(ranges, F.floor(order * ranges).cast("int"))
            .sortWithinPartitions(order, row_key, names["copy"]).select(*docs.columns, names["copy"], names["rate"]))
