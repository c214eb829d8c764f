"""Partitioned JDBC subquery scan.

The catalogue query is pushed to the database as a subquery; Spark splits it by a
modulo bucket column ``id_mod = mod(product_id, N)`` into N range predicates, one per
partition. Bounds are 0..N so partition i reads exactly residue i (bounds 1..N would
give N-1 partitions, the first holding two residues). Connection settings, credentials
included, always come from the caller.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as FV


def source_options(profile: dict[str, str], query: str, num_partitions: int,
                   partition_column: str = FV.BUCKET_COLUMN, alias: str = "q") -> dict[str, str]:
    """Reader options for a subquery split on its bucket column into num_partitions."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    opts = dict(profile)
    opts.update({
        "dbtable": f"({query}) {alias}",
        "partitionColumn": partition_column,
        "lowerBound": "0",
        "upperBound": str(num_partitions),
        "numPartitions": str(num_partitions),
    })
    return opts


def bucketed_query(select_sql: str, bucket_expr: str, num_partitions: int,
                   column: str = FV.BUCKET_COLUMN) -> str:
    """Append ``mod(<bucket_expr>, N) AS id_mod`` to a SELECT list (``{bucket}`` marker)."""
    return select_sql.replace("{bucket}", f"mod({bucket_expr}, {num_partitions}) AS {column}")


def read_subquery(spark: SparkSession, profile: dict[str, str], query: str,
                  num_partitions: int | None = None) -> DataFrame:
    n = num_partitions or spark.sparkContext.defaultParallelism
    return spark.read.format("jdbc").options(**source_options(profile, query, n)).load()


def profile(url: str, driver: str, user: str | None = None, password: str | None = None,
            fetchsize: int = 10_000) -> dict[str, str]:
    """A named source profile: driver + url (+ credentials supplied by the caller)."""
    out = {"url": url, "driver": driver, "fetchsize": str(fetchsize)}
    if user is not None:
        out["user"] = user
    if password is not None:
        out["password"] = password
    return out


# catalogue view -> (database table, numeric column the scan is split on)
CATALOGUE_TABLES = {
    "product": ("PRODUCT", "PRODUCT_ID"),
    "product_attribute": ("PRODUCT_ATTRIBUTE", "PRODUCT_ID"),
    "product_image": ("PRODUCT_IMAGE", "PRODUCT_ID"),
    "channel": ("PRODUCT_DESTINATION_CHANNEL", "PRODUCT_ID"),
    "product_type": ("PRODUCT_TYPE", "PRODUCT_TYPE_ID"),
    "upc": ("UPC", "PRODUCT_ID"),
    "product_colorway": ("PRODUCT_COLORWAY", "PRODUCT_COLORWAY_ID"),
    "product_colorway_image": ("PRODUCT_COLORWAY_IMAGE", "PRODUCT_COLORWAY_ID"),
    "image": ("PRODUCT_IMAGE", "PRODUCT_ID"),
}


def table_scan_query(table: str, split_column: str, num_partitions: int,
                     columns: list[str] | None = None) -> str:
    """``SELECT <columns>, mod(<split>, N) AS id_mod FROM <table>`` for a bucketed scan."""
    cols = ", ".join(columns) if columns else "t.*"
    return bucketed_query(f"SELECT {cols}, {{bucket}} FROM {table} t", f"t.{split_column}", num_partitions)


def read_table_bucketed(spark: SparkSession, profile: dict[str, str], table: str, split_column: str,
                        num_partitions: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """One database table as N parallel range reads on its modulo bucket; column names are
    lower-cased and the bucket column dropped after the read."""
    n = num_partitions or spark.sparkContext.defaultParallelism
    df = read_subquery(spark, profile, table_scan_query(table, split_column, n, columns), n)
    df = df.drop(FV.BUCKET_COLUMN).drop(FV.BUCKET_COLUMN.upper())
    return df.toDF(*[c.lower() for c in df.columns])
