"""Operator properties: per-group index under skew, split stability, semi = inner+distinct,
caps, enum quarantine, rule warnings, scoring invariants, draws."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine import fixed_values as FV
from vitrine.operators import assets as A
from vitrine.operators import catalog as C
from vitrine.operators import ranking as RK
from vitrine.operators import rules as R
from vitrine.operators import sampling as SA
from vitrine.operators import scoring as SC
from vitrine.operators import splits as S
from vitrine.sources.tables import Catalogue

SF = "/root/testdata/sf0.01"


def test_index_within_group_skewed(spark):
    # one group holds a third of the rows; result must equal row_number() - 1
    n = 30000
    df = (spark.range(n).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                    .otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))))
          .withColumn("k", F.sha1(F.col("id").cast("string"))))
    got = RK.index_within_group(df, ["g"], ["k"], num_partitions=16)
    ref = df.withColumn("idx", (F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).cast("bigint"))
    assert got.count() == n
    assert got.select("g", "k", "idx").exceptAll(ref.select("g", "k", "idx")).count() == 0
    # the hot group is spread over many partitions before numbering
    parts = (df.repartitionByRange(16, "g", "k").filter(F.col("g") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 4


def test_split_is_stable_when_rows_are_added(spark):
    a = spark.createDataFrame([(f"l/{i}.jpg",) for i in range(300)], "key string")
    b = a.unionByName(spark.createDataFrame([(f"l/new{i}.jpg",) for i in range(300)], "key string"))
    sa = S.assign_split(a, "key").select("key", "split")
    sb = S.assign_split(b, "key").select("key", "split")
    assert sa.exceptAll(sb.join(sa.select("key"), "key")).count() == 0
    assert {r.split for r in sb.collect()} == {"training", "testing", "validation"}


def test_nohash_variants_share_split(spark):
    rows = [(f"long/img{i}_nohash_{j}.jpg",) for i in range(50) for j in range(3)]
    s = S.assign_split(spark.createDataFrame(rows, "key string"), "key")
    per = s.groupBy("group_key").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in per) and len(per) == 50


def test_split_counts_flags(spark):
    rows = [("a", f"a/{i}") for i in range(19)] + [("b", f"b/{i}") for i in range(20)] + [("c", "c/0")]
    df = S.assign_split(spark.createDataFrame(rows, "label string, key string"), "key")
    out = {r.label: r for r in S.split_counts(df).collect()}
    assert out["a"].small and not out["b"].small and out["c"].small
    assert out["a"].n_classes == 3
    assert out["b"].n_training + out["b"].n_testing + out["b"].n_validation == 20


def test_semi_join_equals_inner_distinct(spark):
    cat = Catalogue.from_tables(spark, SF)
    semi = C.labelled_images(cat, FV.ATTR_TYPE_CATEGORY, 16)
    p = cat.product.filter(F.col("state_id") == 2)
    ch = cat.channel.filter((F.col("publish_flag") == "Y") & (F.col("current_flag") == "Y"))
    pa = cat.product_attribute.filter(F.col("attribute_type_id") == FV.ATTR_TYPE_CATEGORY)
    inner = (cat.product_image.join(pa, "product_id").join(p.select("product_id"), "product_id")
             .join(ch.select("product_id"), "product_id")
             .select("product_id", "image_id", "varchar_value", (F.col("product_id") % 16).alias("id_mod"))
             .distinct())
    assert semi.exceptAll(inner).count() == 0 and inner.exceptAll(semi).count() == 0


def test_first_n_per_label_plan_and_result(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("label"), "id")
    capped = C.first_n_per_label(df, "label", 10, ["id"])
    rows = capped.collect()
    assert len(rows) == 30
    assert sorted(r.id for r in rows if r.label == 0) == list(range(0, 30, 3))
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cap_then_distinct(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b")] * 3 + [(3, "c")], "id int, v string")
    counted = df.groupBy("id", "v").agg(F.count("*").alias("copies"))
    for n, want in ((0, 0), (1, 1), (3, 1), (4, 2), (6, 2), (7, 3), (100, 3)):
        assert C.cap_then_distinct(counted, n, ["id", "v"]).count() == want
    assert sorted(tuple(r) for r in C.cap_then_distinct(counted, 4, ["id", "v"]).collect()) == [(1, "a"), (2, "b")]


def test_enum_quarantine_and_paths(spark):
    df = spark.createDataFrame([("Mini",), ("Long/Maxi",), ("Other",), (None,)], "t string")
    m = df.withColumn("label", A.enum_label("t"))
    good, bad = A.split_quarantine(m)
    assert sorted(r.label for r in good.collect()) == ["Long_Maxi", "Mini"]
    assert bad.count() == 2
    p = spark.createDataFrame([("Long/Maxi",), ("50%",)], "l string").select(A.path_label("l").alias("p"))
    assert [r.p for r in p.collect()] == ["Long%2FMaxi", "50%25"]


def test_attach_assets_flags_missing(spark):
    man = spark.createDataFrame([(1, "Mini", "http://h/x/1-214x261.jpg"), (2, "Mini", "http://h/x/2-214x261.jpg")],
                                "image_id int, label string, image_url string")
    assets = spark.createDataFrame([("1-214x261.jpg",), ("1-214x261.jpg",)], "file_name string")
    out = {r.image_id: r for r in A.attach_assets(man, assets).collect()}
    assert len(out) == 2
    assert out[1].has_asset and out[1].image_path == "assets/Mini/1-214x261.jpg"
    assert not out[2].has_asset and out[2].image_path is None


def test_length_rules_table(spark):
    rows = [(s, p) for s in FV.LENGTH_RULES for p in FV.SHIPPED_LABELS] + [("Unknown", "short")]
    df = spark.createDataFrame(rows, "src string, label1 string")
    got = {(r.src, r.label1): r.warning for r in R.length_warning(df, "src").collect()}
    for s, acc in FV.LENGTH_RULES.items():
        for p in FV.SHIPPED_LABELS:
            assert got[(s, p)] == (p not in acc)
    assert got[("Unknown", "short")] is None


def test_color_warning_literal_and_normalised(spark):
    df = spark.createDataFrame([("ivory cream", "Ivory_Cream"), ("black", "Black")], "label1 string, exp string")
    lit = {r.exp: r.warning for r in R.color_warning(df, "exp", literal=True).collect()}
    norm = {r.exp: r.warning for r in R.color_warning(df, "exp").collect()}
    assert lit == {"Ivory_Cream": True, "Black": False}
    assert norm == {"Ivory_Cream": False, "Black": False}


def test_scoring_invariants(spark):
    m = SC.fixed_model(FV.SHIPPED_LABELS, 4)
    df = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4]), (2, [1.0, -1.0, 0.5, 0.0])], "vec_id int, features array<float>")
    s = SC.score(df, m)
    for r in s.collect():
        assert abs(sum(r.probs) - 1.0) < 1e-12
    top = SC.top_labels(s, m, ["vec_id"], 3).collect()
    assert len(top) == 6 and {r["rank"] for r in top} == {1, 2, 3}
    lab = spark.createDataFrame([(0,), (4,), (5,), (-1,)], "c int").select(m.label_of("c").alias("l"))
    assert [r.l for r in lab.collect()] == ["below the knee", "long", "", ""]


def test_model_table_roundtrip(spark):
    m = SC.fixed_model(["a", "b"], 3)
    back = SC.SoftmaxModel.from_table(m.to_table(spark))
    assert back.labels == ["a", "b"] and back.weights == m.weights and back.bias == [0.0, 0.0]
    rows = spark.createDataFrame([([1.0, 2.0, 3.0],), (None,)], "features array<float>")
    z = [r.z for r in rows.select(m.logits("features").alias("z")).collect()]
    assert z[0] == pytest.approx([sum(a * b for a, b in zip(w, (1, 2, 3))) for w in m.weights]) and z[1] is None


def test_draws_reach_all_labels_and_images(spark):
    """More labels, and more images of a label, than 16 bits can number."""
    n = 70_000
    wide = spark.range(n).select(F.format_string("l%07d", "id").alias("label"), F.lit("training").alias("split"),
                                 F.col("id").cast("string").alias("key"), F.lit(0).cast("long").alias("idx"))
    got = SA.balanced_draws(spark, wide, 40_000, "training", "s").agg(F.max("class_id"), F.countDistinct("class_id")).first()
    assert got[0] > 65_535 and got[1] > 25_000
    deep = spark.range(100_000).select(F.lit("a").alias("label"), F.lit("training").alias("split"),
                                       F.col("id").cast("string").alias("key"), F.col("id").alias("idx"))
    assert SA.balanced_draws(spark, deep, 2_000, "training", "s").agg(F.max("idx")).first()[0] > 95_000
    assert SA.balanced_draws(spark, deep, 2_000, "training", "s", index_range=65_536).agg(F.max("idx")).first()[0] < 65_536
    with pytest.raises(ValueError, match="class list"):
        SA.balanced_draws(spark, deep, 10, "training", "s", labels=["b"])


def test_distinct_comes_after_the_selective_join(spark):
    """Without broadcasts, the image fact meets the eligible products below its DISTINCT."""
    from vitrine.sources.tables import Catalogue
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = C.labelled_images(Catalogue.from_tables(spark, "/root/testdata/sf0.001"))
        plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = {}
    for line in plan:
        for word in ("Aggregate", "Join Inner"):
            if word in line:
                depth.setdefault(word, len(line) - len(line.lstrip(" :+-|")))
    assert depth["Aggregate"] < depth["Join Inner"]


def test_first_n_per_label_at_any_n(spark):
    df = spark.range(9_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("label"))
    for n in (1, 1_000, 1_001, 2_500):
        got = C.first_n_per_label(df, "label", n, ["id"]).groupBy("label").agg(F.count("*"), F.max("id")).collect()
        assert {r[0]: tuple(r[1:]) for r in got} == {"hot": (n, 3 * (n - 1)), "cold": (n, 3 * ((n - 1) // 2) + 1 + (n - 1) % 2)}


def test_balanced_draws_skip_empty_labels(spark):
    pool = spark.createDataFrame(
        [("a", "training", f"a{i}", i) for i in range(3)] + [("b", "testing", "b0", 0)] +
        [("c", "training", f"c{i}", i) for i in range(5)], "label string, split string, key string, idx long")
    d = SA.balanced_draws(spark, pool, 400, "training", "s")
    rows = d.collect()
    assert len(rows) == 400
    assert {r.label for r in rows} == {"a", "c"}
    assert all(r.idx == r.image_index % (3 if r.label == "a" else 5) for r in rows)
    again = SA.balanced_draws(spark, pool, 400, "training", "s").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
