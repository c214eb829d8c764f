"""Sources and sinks: label list, synset/two-line lookups, JSON arrays, image folders,
vector text, JDBC options, label-partitioned landing."""
import json
import os

from pyspark.sql import functions as F

from vitrine import sinks
from vitrine.operators import lookup as LK
from vitrine.sources import files as SRC
from vitrine.sources import jdbc as J


def test_label_list_keeps_last_character(spark, tmp_dir):
    p = os.path.join(tmp_dir, "labels.txt")
    with open(p, "w") as f:
        f.write("below the knee\nhigh low\nMidi/Tea_Length \nshort\n")
    got = [(r.label_id, r.label) for r in SRC.read_label_list(spark, p).orderBy("label_id").collect()]
    assert got == [(0, "below the knee"), (1, "high low"), (2, "Midi/Tea_Length "), (3, "short")]
    # no trailing newline: the last label is still whole
    p2 = os.path.join(tmp_dir, "labels2.txt")
    with open(p2, "w") as f:
        f.write("a\nlong")
    assert [r.label for r in SRC.read_label_list(spark, p2).orderBy("label_id").collect()] == ["a", "long"]


def test_label_list_sink_roundtrip(spark, tmp_dir):
    labels = spark.createDataFrame([(1, "high low"), (0, "below the knee"), (2, "long")], "label_id int, label string")
    out = os.path.join(tmp_dir, "ll")
    sinks.write_label_list(labels, out)
    back = SRC.read_label_list(spark, out).orderBy("label_id").collect()
    assert [(r.label_id, r.label) for r in back] == [(0, "below the knee"), (1, "high low"), (2, "long")]


def test_two_hop_lookup(spark, tmp_dir):
    syn = os.path.join(tmp_dir, "synsets.txt")
    with open(syn, "w") as f:
        f.write("n01440764\ttench, Tinca tinca\nn01443537\tgoldfish, Carassius auratus\n")
    proto = os.path.join(tmp_dir, "map.pbtxt")
    with open(proto, "w") as f:
        f.write('entry {\n  target_class: 449\n  target_class_string: "n01440764"\n}\n'
                'entry {\n  target_class: 450\n  target_class_string: "n01443537"\n}\n'
                'entry {\n  target_class: 451\n  target_class_string: "n09999999"\n}\n')
    names = SRC.read_synset_names(spark, syn)
    uids = SRC.read_class_uids(spark, proto)
    ok, missing = LK.two_hop_labels(uids, names)
    assert sorted((r.class_id, r.label) for r in ok.collect()) == [
        (449, "tench, Tinca tinca"), (450, "goldfish, Carassius auratus")]
    assert [(r.class_id, r.uid) for r in missing.collect()] == [(451, "n09999999")]


def test_attach_label_unknown_is_empty(spark):
    labels = spark.createDataFrame([(0, "a"), (1, "b")], "label_id int, label string")
    df = spark.createDataFrame([(0,), (1,), (7,)], "label_id int")
    got = {r.label_id: r.label for r in LK.attach_label(df, labels).collect()}
    assert got == {0: "a", 1: "b", 7: ""}


def test_json_arrays_absent_keys(spark, tmp_dir):
    d = os.path.join(tmp_dir, "json")
    os.makedirs(d)
    with open(os.path.join(d, "dresses_Mini.json"), "w") as f:
        json.dump([{"productId": 1, "imageUrl": "u1", "imagePath": "/x/1.jpg", "colorNormalId": 0},
                   {"productId": 2, "imageUrl": "u2", "colorNormalId": 0}], f)
    df = SRC.read_json_arrays(spark, d)
    rows = {r.productId: r for r in df.collect()}
    assert rows[1].imagePath == "/x/1.jpg" and rows[2].imagePath is None
    assert rows[1].source_file.endswith("dresses_Mini.json")


def test_json_array_sink_per_label(spark, tmp_dir):
    df = spark.createDataFrame([(3, "u3", "Mini"), (1, "u1", "Mini"), (2, None, "Long_Maxi")],
                               "productId int, imageUrl string, label string")
    out = os.path.join(tmp_dir, "arr")
    sinks.write_json_arrays_by_label(df, out, 10, ["productId"])
    mini = [f for f in os.listdir(os.path.join(out, "label=Mini")) if f.endswith(".txt")]
    with open(os.path.join(out, "label=Mini", mini[0])) as f:
        arr = json.loads(f.read())
    assert [x["productId"] for x in arr] == [1, 3]
    back = SRC.read_json_arrays(spark, out, "productId int, imageUrl string")
    assert back.count() == 3
    assert back.filter(F.col("imageUrl").isNull()).count() == 1


def test_image_listing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "images")
    for label, files in {"Long_Maxi": ["a.jpg", "b.JPEG", "c.png"], "Mini": ["d.jpeg"], "empty": []}.items():
        os.makedirs(os.path.join(root, label))
        for fn in files:
            with open(os.path.join(root, label, fn), "wb") as f:
                f.write(b"\xff\xd8\xff" + fn.encode())
    rows = SRC.list_images(spark, root).collect()
    assert sorted((r.label, r.dir, r.base_name) for r in rows) == [
        ("long maxi", "Long_Maxi", "a.jpg"), ("long maxi", "Long_Maxi", "b.JPEG"), ("mini", "Mini", "d.jpeg")]
    content = SRC.read_image_bytes(spark, root).filter(F.col("path").endswith("d.jpeg")).first().content
    assert bytes(content) == b"\xff\xd8\xffd.jpeg"


def test_vector_text_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("k1", [0.1, 1e-05, -3.25]), ("k2", [2.0])], "key string, features array<float>")
    out = os.path.join(tmp_dir, "vec")
    sinks.write_vectors_text(df, out)
    back = {r.key: r.features for r in SRC.read_vector_text(spark, out).collect()}
    orig = {r.key: r.features for r in df.collect()}
    assert back == orig


def test_jdbc_options_bounds():
    opts = J.source_options(J.profile("jdbc:derby:memory:x", "org.apache.derby.jdbc.EmbeddedDriver"),
                            "SELECT a, mod(a, 16) AS id_mod FROM t", 16)
    assert opts["dbtable"] == "(SELECT a, mod(a, 16) AS id_mod FROM t) q"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("0", "16", "16")
    assert opts["partitionColumn"] == "id_mod" and "password" not in opts
    q = J.bucketed_query("SELECT DISTINCT p.id, {bucket} FROM p", "p.id", 8)
    assert q == "SELECT DISTINCT p.id, mod(p.id, 8) AS id_mod FROM p"


def test_landing_by_label(spark, tmp_dir):
    df = spark.createDataFrame([(1, "Long/Maxi"), (2, "Mini"), (3, "Mini")], "image_id int, label string")
    out = os.path.join(tmp_dir, "land")
    sinks.land_by_label(df, out)
    back = spark.read.parquet(out)
    assert sorted((r.image_id, r.label) for r in back.collect()) == [(1, "Long/Maxi"), (2, "Mini"), (3, "Mini")]


def fixed_vectors(spark, key_col, keys):
    from vitrine.operators import scoring as SC
    rows = [(k, [float(i + j) for j in range(3)]) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, f"{key_col} string, features array<float>"), SC.fixed_model(["short", "long", "red"], 3)


def test_length_check_keeps_every_record_once(spark, tmp_dir):
    """Records that share an image, records without an image or a vector, and keys of their own."""
    from vitrine.plans import flows as FL
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    recs = [{"productId": 3_000_000_000, "imagePath": "/p/1.jpg", "dressLengthValue": "Mini", "brand": "b", "n": {"x": 1}},
            {"productId": 2, "imagePath": "/p/1.jpg", "dressLengthValue": "Mini"}, {"productId": 2, "imagePath": "/p/1.jpg", "dressLengthValue": "Mini"},
            {"productId": 4, "imageUrl": "u"}, {"productId": 5, "imagePath": "/p/none.jpg", "dressLengthValue": "Long_Maxi"}]
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        json.dump(recs, f)
    vectors, model = fixed_vectors(spark, "imagePath", ["/p/1.jpg", "/p/1.jpg", None])
    FL.validate_exports(spark, src, vectors, model, out)
    back = []
    for root, _, files in os.walk(out):
        for fn in files:
            if fn.endswith(".json"):
                with open(os.path.join(root, fn)) as f:
                    back += [json.loads(line) for line in f]
    added = {"cvResult", "cvScore", "cvResult2", "cvScore2", "warning"}
    plain = [{k: v for k, v in r.items() if k not in added} for r in back]
    label = {r["productId"]: r.get("dressLengthValue") for r in recs}
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, plain)) == sorted(key({k: v for k, v in r.items()}) for r in recs), label
    assert all((added <= set(r)) == (r.get("imagePath") == "/p/1.jpg") and bool(added & set(r)) == (added <= set(r)) for r in back)


def test_color_check_is_by_file(spark):
    """One image in two colours' files: a record each, with its own file's warning."""
    from vitrine.plans import flows as FL
    recs = spark.createDataFrame([("a.jpg", "Short", "x"), ("a.jpg", "Long", "y"), ("b.jpg", "Red", None)],
                                 "imageName string, want string, brand string")
    vectors, model = fixed_vectors(spark, "imageName", ["a.jpg"])
    rows = {(r.imageName, r.want): r for r in FL.check_colors(recs, "want", vectors, model).collect()}
    assert len(rows) == 3 and rows["b.jpg", "Red"].warning is None and rows["b.jpg", "Red"].color1 is None
    first = rows["a.jpg", "Short"].color1
    assert [rows["a.jpg", c].warning for c in ("Short", "Long")] == [first != "short", first != "long"]
    assert rows["a.jpg", "Long"].brand == "y"


def test_path_helpers(spark):
    from vitrine.functions import text as TX
    df = spark.createDataFrame([("root", "long", "a.jpg")], "r string, l string, b string")
    r = df.select(TX.join_path("r", "l", "b").alias("p"),
                  TX.cache_path(TX.join_path("r", "l", "b")).alias("c")).first()
    assert r.p == "root/long/a.jpg" and r.c == "root/long/a.jpg.txt"
    r2 = spark.createDataFrame([(r.p,)], "p string").select(
        TX.label_from_path("p").alias("l"), TX.base_name("p").alias("b")).first()
    assert (r2.l, r2.b) == ("long", "a.jpg")


def test_class_count_guard(spark):
    import pytest
    from vitrine.operators.splits import check_class_count
    one = spark.createDataFrame([("a", "k1"), ("a", "k2")], "label string, key string")
    with pytest.raises(ValueError):
        check_class_count(one)
    with pytest.raises(ValueError):
        check_class_count(one.filter("label = 'z'"))
    assert check_class_count(one.unionByName(spark.createDataFrame([("b", "k3")], "label string, key string"))) == 2


def test_jdbc_table_scan_query():
    q = J.table_scan_query("PRODUCT_IMAGE", "PRODUCT_ID", 16, ["t.PRODUCT_ID", "t.IMAGE_ID"])
    assert q == "SELECT t.PRODUCT_ID, t.IMAGE_ID, mod(t.PRODUCT_ID, 16) AS id_mod FROM PRODUCT_IMAGE t"
    opts = J.source_options({"url": "jdbc:x", "driver": "d"}, q, 16)
    assert opts["dbtable"].startswith("(SELECT t.PRODUCT_ID") and opts["dbtable"].endswith(") q")
    assert set(J.CATALOGUE_TABLES) >= {"product", "product_attribute", "product_image", "channel",
                                       "product_type", "upc", "product_colorway", "product_colorway_image"}


def test_image_bytes_attach_and_binary_landing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "img")
    os.makedirs(os.path.join(root, "Mini"))
    for i in range(3):
        with open(os.path.join(root, "Mini", f"{i}-214x261.jpg"), "wb") as f:
            f.write(bytes([0xFF, 0xD8, i]))
    man = spark.createDataFrame([(0, "Mini", os.path.join(root, "Mini", "0-214x261.jpg")),
                                 (2, "Mini", os.path.join(root, "Mini", "2-214x261.jpg")),
                                 (9, "Mini", os.path.join(root, "Mini", "9-214x261.jpg"))],
                                "image_id int, label string, image_path string")
    got = SRC.attach_image_bytes(man, spark, root)
    by_id = {r.image_id: (bytes(r.content) if r.content is not None else None) for r in got.collect()}
    assert by_id == {0: bytes([0xFF, 0xD8, 0]), 2: bytes([0xFF, 0xD8, 2]), 9: None}
    out = os.path.join(tmp_dir, "landed")
    sinks.land_by_label(got.filter(F.col("content").isNotNull()), out)
    back = {r.image_id: bytes(r.content) for r in spark.read.parquet(out).collect()}
    assert back == {0: bytes([0xFF, 0xD8, 0]), 2: bytes([0xFF, 0xD8, 2])}


def test_label_collisions_reported(spark, tmp_dir):
    root = os.path.join(tmp_dir, "coll")
    for label in ["Long_Maxi", "long-maxi", "Mini"]:
        os.makedirs(os.path.join(root, label))
        with open(os.path.join(root, label, "a.jpg"), "wb") as f:
            f.write(b"x")
    listing = SRC.list_images(spark, root)
    rows = SRC.label_collisions(listing).collect()
    assert [(r.label, r.dirs) for r in rows] == [("long maxi", ["Long_Maxi", "long-maxi"])]
    assert listing.filter("label = 'long maxi'").count() == 2      # merged, not overwritten


def test_catalogue_from_jdbc_views(spark, monkeypatch):
    from decimal import Decimal
    from vitrine.sources import jdbc as JD
    from vitrine.sources.tables import Catalogue
    calls = []

    def fake_scan(spark_, profile, table, split, n=None, columns=None):
        calls.append((table, split, n))
        if table == "PRODUCT":
            return spark_.createDataFrame([(Decimal(5), "a ring", Decimal(2))],
                                          "product_id decimal(38,0), product_desc string, state_id decimal(38,0)")
        return spark_.createDataFrame([(Decimal(5), Decimal(99999999999999999999))],
                                      "product_id decimal(38,0), image_id decimal(38,0)")

    monkeypatch.setattr(JD, "read_table_bucketed", fake_scan)
    assets = spark.createDataFrame([("5-214x261.jpg",)], "file_name string")
    cat = Catalogue.from_jdbc(spark, {"url": "jdbc:x", "driver": "d"}, 16, assets=assets)
    from vitrine.operators import catalog as C
    # the filter is on the column as the database has it, so it can be pushed down
    plan = cat.product.filter(F.col("state_id") == 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(state_id" not in plan
    got = C.labelled_images(Catalogue.from_frames(
        product=cat.product, product_image=cat.product_image,
        channel=spark.createDataFrame([(Decimal(5), "Y", "Y")], "product_id decimal(38,0), publish_flag string, current_flag string"),
        product_attribute=spark.createDataFrame([(Decimal(5), 708, "v")], "product_id decimal(38,0), attribute_type_id long, varchar_value string")))
    assert got.schema["product_id"].dataType.simpleString() == "bigint"
    row = got.first()
    assert (row.product_id, row.image_id) == (5, None)    # does not fit a bigint: NULL, never wrapped
    assert cat.image.columns == ["product_id", "image_id"]
    assert cat.landed_assets.count() == 1
    assert ("PRODUCT", "PRODUCT_ID", 16) in calls and ("PRODUCT_IMAGE", "PRODUCT_ID", 16) in calls


def test_json_array_sink_caps_labels(spark, tmp_dir):
    df = spark.range(5_000).selectExpr("id", "if(id % 10 = 0, 'Mini', 'Long') AS label")
    out = os.path.join(tmp_dir, "big")
    sinks.write_json_arrays_by_label(df, out, 1_200, ["id"])
    back = SRC.read_json_arrays(spark, out, "id long")
    assert sorted(r.id for r in back.filter("label = 'Mini'").collect()) == list(range(0, 5_000, 10))
    assert back.filter("label = 'Long'").agg(F.count("id"), F.max("id")).first() == (1_200, 1_333)


def test_landing_keeps_labels_as_they_are(spark, tmp_dir):
    labels = ["007", "1e3", "", "a/b", "2024-01-01", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "id long, label string")
    out = os.path.join(tmp_dir, "labels")
    sinks.land_by_label(df, out)
    back = sinks.read_landing(spark, out, df.schema)
    assert back.columns == ["id", "label"]
    assert [r.label for r in back.orderBy("id").collect()] == labels


def test_class_uids_pair_by_adjacency(spark, tmp_dir):
    path = os.path.join(tmp_dir, "map.pbtxt")
    with open(path, "w") as f:
        f.write('entry {\n  target_class: 1\n}\nentry {\n  target_class: 2\n  target_class_string: "n2"\n}\n'
                'entry {\n  target_class: 3\n  other: 9\n  target_class_string: "n3"\n}\n'
                'entry {\n  target_class: 3\n  target_class_string: "n3b"\n}\nentry {\n  target_class_string: "n4"\n}\n')
    got = {r.class_id: r.uid for r in SRC.read_class_uids(spark, path).collect()}
    assert got == {2: "n2", 3: "n3b"}


def test_listing_is_one_folder_deep(spark, tmp_dir):
    for name in ("top.jpg", "Mini/a.jpg", "Mini/deep/b.jpg"):
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, name)), exist_ok=True)
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(name.encode())
    rows = SRC.list_images(spark, tmp_dir).collect()
    assert [(r.dir, r.base_name) for r in rows] == [("Mini", "a.jpg")]
    some = spark.createDataFrame([(rows[0].path,), ("s3a://bucket" + os.path.join(tmp_dir, "Mini/a.jpg"),), ("/none",), (None,)], "image_path string")
    got = {r.image_path: r.content for r in SRC.attach_image_bytes(some, spark, tmp_dir).collect()}
    assert [bytes(v) if v else None for v in got.values()].count(b"Mini/a.jpg") == 2 and len(got) == 4


def test_read_table_sees_appended_files(spark, tmp_dir):
    from vitrine.sources.tables import Catalogue, read_table
    path = os.path.join(tmp_dir, "part.parquet")
    rows = spark.range(5).selectExpr("id p_partkey", "'n' p_name", "'b' p_brand", "1L p_size", "'MEDIUM' p_type")
    rows.write.parquet(path)
    assert read_table(spark, tmp_dir, "part").count() == Catalogue.from_tables(spark, tmp_dir).product.count() == 5
    rows.write.mode("append").parquet(path)
    assert read_table(spark, tmp_dir, "part").count() == Catalogue.from_tables(spark, tmp_dir).product.count() == 10


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    import pytest
    from vitrine import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_landing_splits_a_hot_label(spark, tmp_dir):
    from pyspark.sql import functions as F
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), (F.col("id") % 7).cast("string")))
        .alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        out = os.path.join(tmp_dir, "land_hot")
        sinks.land_by_label(df, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(os.path.join(out, "label_folder=hot")) if f.endswith(".parquet")]
    small_files = [f for f in os.listdir(os.path.join(out, "label_folder=l1")) if f.endswith(".parquet")]
    assert len(hot_files) > 1 and len(small_files) <= len(hot_files)
    assert spark.read.parquet(out).count() == 60_000


def test_scratch_is_the_application_s_own(spark):
    from vitrine.session import ensure_checkpoint_dir, scratch_path
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and spark.sparkContext.applicationId in a and a.startswith(ensure_checkpoint_dir(spark))
