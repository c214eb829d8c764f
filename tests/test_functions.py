"""Golden scalar tests for URL, text, hash, score-text and vector functions."""
import hashlib

import pytest
from pyspark.sql import functions as F

from vitrine import fixed_values as FV
from vitrine.functions import hashing as H
from vitrine.functions import text as TX
from vitrine.functions import urls as U
from vitrine.functions import vectors as V
from vitrine.operators import rules as R


def url_reference(image_id: int, suffix: str, prefix: str) -> str:
    """Independent digit-by-digit construction of the sharded path."""
    digits = str(image_id % 10**8).rjust(8, "0")
    shard = "/" + "/".join(digits[i:i + 2] for i in range(0, 8, 2)) + "/"
    return f"{prefix}{shard}final/{image_id}-{suffix}"


IDS = [0, 7, 3456789, 12345678, 99999999, 123456789, 2147483647]


def test_image_url_golden(spark):
    df = spark.createDataFrame([(i,) for i in IDS] + [(-1,), (None,)], "id bigint")
    got = {r["id"]: r["u"] for r in df.select("id", U.image_url("id", "214x261.jpg", "http://h").alias("u")).collect()}
    for i in IDS:
        assert got[i] == url_reference(i, "214x261.jpg", "http://h")
    assert got[3456789] == "http://h/03/45/67/89/final/3456789-214x261.jpg"
    assert got[-1] is None and got[None] is None


def test_file_name_and_roles(spark):
    df = spark.createDataFrame([(5,)], "id bigint")
    rows = df.select(F.explode(U.role_suffix_map()).alias("role", "suffix")).collect()
    assert {r.role: r.suffix for r in rows} == FV.IMAGE_ROLE_SUFFIX
    r = df.select(U.file_name(U.image_url("id")).alias("f")).first()
    assert r.f == "5-214x261.jpg"


def test_normalize_label(spark):
    vals = ["Long/Maxi", "Ivory_Cream", "Midi/Tea_Length ", "A--B", "a  b", "Tan_Beige"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.n for r in df.select(TX.normalize_label("v").alias("n")).collect()]
    assert got == ["long maxi", "ivory cream", "midi tea length ", "a b", "a b", "tan beige"]


def test_variant_group_key(spark):
    df = spark.createDataFrame([("long/a_nohash_1.jpg",), ("long/a_nohash_2.jpg",), ("long/b.jpg",)], "k string")
    got = [r.g for r in df.select(TX.variant_group_key("k").alias("g")).collect()]
    assert got == ["long/a", "long/a", "long/b.jpg"]


def test_hash_percentage_matches_python(spark):
    keys = [f"label{i % 7}/img_{i}.jpg" for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.p for r in df.select("k", H.hash_percentage("k").alias("p")).collect()}
    for k in keys:
        h = int(hashlib.sha1(k.encode("utf-8")).hexdigest(), 16)
        assert got[k] == (h % 65536) * (100 / 65535.0)


def test_split_boundaries(spark):
    vals = [6553 * FV.HASH_SCALE, 6554 * FV.HASH_SCALE, 13107 * FV.HASH_SCALE, 0.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.s for r in df.select(H.split_of("p", 10, 10).alias("s")).collect()]
    # 13107 * 100/65535 is exactly 20.0: not below 20, so training
    assert got == ["validation", "testing", "training", "validation", "training"]


def test_known_split_answer(spark):
    from vitrine.plans.split_queries import hash_split
    counts = {r.split: r["count"] for r in hash_split(spark, "/root/testdata/sf0.01").groupBy("split").count().collect()}
    assert counts == {"training": 792, "testing": 117, "validation": 91}


@pytest.mark.parametrize("value,text", [(0.125, "0.12"), (0.285, "0.28"), (0.375, "0.38"),
                                        (1.0, "1.00"), (0.005, "0.01"), (0.015, "0.01")])
def test_score_text_rounds_like_python(spark, value, text):
    assert format(value, ".2f") == text
    got = spark.createDataFrame([(value,)], "s double").select(R.score_text("s").alias("t")).first().t
    assert got == text


def test_vector_functions(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], 2, [1.0, 2.0, 3.0])], "s array<double>, c int, z array<double>")
    r = df.select(V.argmax("s").alias("am"), V.top_k("s", 2).alias("tk"), V.one_hot("c", 4).alias("oh"),
                  V.softmax("z").alias("sm"), V.log_sum_exp("z").alias("lse"),
                  V.to_csv("z").alias("csv")).first()
    assert r.am == 0                                  # lowest index wins the tie
    assert [t.class_id for t in r.tk] == [1, 0]       # argsort()[-2:][::-1] order
    assert r.oh == [0.0, 0.0, 1.0, 0.0]
    assert abs(sum(r.sm) - 1.0) < 1e-12
    import math
    assert abs(r.lse - math.log(sum(math.exp(v) for v in [1, 2, 3]))) < 1e-12
    back = spark.createDataFrame([(r.csv,)], "t string").select(V.from_csv("t", "double").alias("v")).first().v
    assert back == [1.0, 2.0, 3.0]


def test_reshape_and_wrap(spark):
    df = spark.createDataFrame([(list(range(6)), 70000, 3)], "v array<int>, i int, n int")
    r = df.select(V.reshape("v", 2, 3).alias("m"), V.wrap_index("i", "n").alias("w")).first()
    assert r.m == [[0, 1, 2], [3, 4, 5]] and r.w == 70000 % 3


def test_to_id_never_wraps(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("123"),), (Decimal("99999999999999999999"),), (None,)],
                               "n decimal(38,0)")
    assert [r.i for r in df.select(U.to_id("n").alias("i")).collect()] == [123, None, None]
