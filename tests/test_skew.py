"""A hot product (a third of all image rows) in the catalogue fact join: its rows must be
spread over salt buckets of at most about ``hot_rows`` rows each (no join group receives
the hot key whole), and the result must equal the plain join."""
from pyspark.sql import functions as F

from vitrine.operators import catalog as C
from vitrine.sources.tables import Catalogue


def test_hot_product_is_split(spark):
    n = 120_000
    img = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000 + 100).cast("bigint").alias("product_id"),
        F.col("id").alias("image_id"))
    prod = spark.range(100, 5100).select(F.col("id").alias("product_id")).unionByName(
        spark.createDataFrame([(7,)], "product_id long")).select(
        "product_id", F.lit("d").alias("product_desc"), F.lit(2).cast("bigint").alias("state_id"))
    attr = prod.select("product_id", F.lit(708).cast("bigint").alias("attribute_type_id"),
                       F.concat(F.lit("v"), (F.col("product_id") % 4).cast("string")).alias("varchar_value"))
    chan = prod.select("product_id", F.lit("Y").alias("publish_flag"), F.lit("Y").alias("current_flag"))
    cat = Catalogue.from_frames(product=prod, product_attribute=attr, product_image=img, channel=chan)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = C.labelled_images(cat, 708, 16, hot_rows=10_000)
        rows = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()   # final adaptive plan
        plain = (img.join(attr.select("product_id", "varchar_value"), "product_id")
                 .select("product_id", "image_id", "varchar_value",
                         (F.col("product_id") % 16).alias("id_mod")).distinct())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "_salt" in plan, plan
    # the largest (key, salt) join group on the fact side
    from vitrine.operators.joins import salted_sides
    f, d = salted_sides(img, attr.select("product_id", "varchar_value"), "product_id", 10_000)
    groups = f.groupBy("product_id", "_salt").count()
    assert groups.agg(F.max("count")).first()[0] <= 10_000 * 1.2
    assert groups.filter(F.col("product_id") == 7).count() == -(-(n // 3) // 10_000)
    assert d.filter(F.col("product_id") == 7).count() == -(-(n // 3) // 10_000)
    assert rows == n            # every image row is distinct and its product eligible
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0


def test_hot_image_is_salted_in_the_asset_join(spark):
    """A third of the manifest's rows show one image: the left join keeps every row once and splits them."""
    from vitrine.operators import assets as A
    n = 60_000
    manifest = spark.range(n).select(F.col("id").alias("product_id"),
                                     F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 100).alias("image_id"),
                                     F.lit("Mini").alias("label"))
    assets = spark.range(0, 500).select(F.concat(F.col("id").cast("string"), F.lit("-214x261.jpg")).alias("file_name"))
    out = A.attach_assets(manifest, assets, hot_rows=5_000)
    assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
    plain = A.attach_assets(manifest, assets)
    assert out.count() == n and out.exceptAll(plain).count() == 0
    assert out.filter("image_id = 7 and has_asset").count() == n // 3
    from vitrine.operators.joins import salted_sides
    f, _ = salted_sides(manifest, A.landed_image_ids(assets), "image_id", 5_000)
    assert f.groupBy("image_id", "_salt").count().agg(F.max("count")).first()[0] <= 5_000 * 1.2


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _with(spark, conf, run):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def _third(spark, n, key, alike):
    """A third of the rows without a key, a third on one key; ``alike``: the former are all the same."""
    k = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 4000 + 100)
    product = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")) if alike else F.col("id")
    return spark.range(0, n, 1, 8).select(k.cast("bigint").alias(key), product.cast("bigint").alias("product_id"),
                                          F.sha2(product.cast("string"), 256).alias("label"))


def test_null_and_hot_keys_of_a_left_join(spark):
    """No task gets more than twice the median, by counts or by AQE, and the rows are those of the plain join."""
    from vitrine.operators import assets as A

    n = 80_000
    assets = spark.range(0, 4000).select(F.concat(F.col("id").cast("string"), F.lit("-214x261.jpg")).alias("file_name"))

    def run():
        for alike in (False, True):
            manifest = _third(spark, n, "image_id", alike)
            plain = manifest.join(A.landed_image_ids(assets).withColumn("has_asset", F.lit(True)), "image_id", "left").select(
                "product_id", "image_id", F.coalesce("has_asset", F.lit(False)))
            for how in (None, 5_000):
                out = A.attach_assets(manifest, assets, hot_rows=how)
                sizes = _tasks(out)
                assert sum(sizes) == n and max(sizes) <= 2 * sizes[len(sizes) // 2], (alike, how, sizes)
                got = out.select("product_id", "image_id", "has_asset")
                assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()

    _with(spark, NO_BROADCAST, run)


def test_null_and_hot_paths_of_record_checks(spark):
    """Records without an image, or of one image, don't meet in one task of either check."""
    from vitrine import fixed_values as FV
    from vitrine.operators import scoring as SC
    from vitrine.plans import flows as FL

    n = 60_000
    model = SC.fixed_model(list(FV.SHIPPED_LABELS), 4)

    def run():
        for alike in (False, True):
            recs = _third(spark, n, "k", alike).select(F.col("k").cast("string").alias("imagePath"), F.col("k").cast("string").alias("imageName"),
                                                       "product_id", F.lit(FV.DRESS_LENGTH_CHECK_ORDER[0]).alias("dressLengthValue"))
            vectors = spark.range(2000).select(F.col("id").cast("string").alias("imagePath"), F.col("id").cast("string").alias("imageName"),
                                               F.array(*[F.lit(0.5)] * 4).alias("features"))
            for out in (FL.check_lengths(recs, vectors.drop("imageName"), model),
                        FL.check_colors(recs, "dressLengthValue", vectors.drop("imagePath"), model)):
                sizes = _tasks(out)
                assert sum(sizes) == n and max(sizes) <= 2 * sizes[len(sizes) // 2], (alike, sizes)
                want = recs.filter("cast(imagePath as int) < 2000").count()
                assert out.filter("warning is not null").count() == want

    _with(spark, NO_BROADCAST, run)


def test_spread_join_is_the_plain_join(spark):
    from vitrine.operators.joins import spread_join

    fact = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (9, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 0)], "k int, w int")

    def run():
        for how in ("inner", "left", "left_semi"):
            assert sorted(map(tuple, spread_join(fact, dim, "k", how).collect()), key=str) == \
                sorted(map(tuple, fact.join(dim, "k", how).collect()), key=str)

    run()
    _with(spark, NO_BROADCAST, run)
