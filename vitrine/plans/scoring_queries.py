"""Scoring, rule check and evaluation queries on the embeddings table, with oracle SQL.

Test model (FIXTURES.md part 2): W[c][d] = ((c*31 + d*17) mod 13 - 6) / 10, bias 0, classes
= the shipped label list; the catalogue label of a vector is ``label % 5`` in check order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions import vectors as V
from ..operators import lookup as LK
from ..operators import rules as R
from ..operators import scoring as SC
from ..sources.tables import read_table

DIM = 64
K = len(FV.SHIPPED_LABELS)
DEC = 6
SQL: dict[str, str] = {}


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id"), F.col("embedding").alias("features"),
                      (F.col("label") % K).cast("int").alias("true_id"),
                      F.element_at(F.array(*[F.lit(x) for x in FV.DRESS_LENGTH_CHECK_ORDER]),
                                   (F.col("label") % K + 1).cast("int")).alias("source_label"))


def model() -> SC.SoftmaxModel:
    return SC.fixed_model(FV.SHIPPED_LABELS, DIM)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.score(features(spark, sf_dir), model(), "features")


def _case(col: str, values: list[str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " ELSE '' END"


def logits_sql(k: int) -> str:
    return f"""
e AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS d
      FROM embeddings),
cls AS (SELECT range AS c FROM range(0, {k})),
z AS (SELECT e.vec_id, cls.c AS class_id,
             sum(CAST(e.x AS DOUBLE) * (CAST(((cls.c * 31 + e.d * 17) % 13) - 6 AS DOUBLE) / 10.0)) AS z
      FROM e CROSS JOIN cls GROUP BY e.vec_id, cls.c),
zm AS (SELECT *, max(z) OVER (PARTITION BY vec_id) AS mz FROM z),
p AS (SELECT vec_id, class_id, z, mz,
             exp(z - mz) / sum(exp(z - mz)) OVER (PARTITION BY vec_id) AS score,
             mz + ln(sum(exp(z - mz)) OVER (PARTITION BY vec_id)) AS lse FROM zm)"""


LOGITS_SQL = logits_sql(K) + f""",
truth AS (SELECT vec_id, CAST(label % {K} AS INTEGER) AS true_id,
                 {_case(f'label % {K}', FV.DRESS_LENGTH_CHECK_ORDER)} AS source_label FROM embeddings)"""


def softmax_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model()
    return (SC.scores_long(scored(spark, sf_dir), m, ["vec_id"])
            .withColumn("label_id", F.col("label_id").cast("int"))
            .withColumn("score", F.round("score", DEC)))


SQL["softmax_scores"] = f"""WITH {LOGITS_SQL}
SELECT vec_id, CAST(class_id AS INTEGER) AS label_id, round(score, {DEC}) AS score,
       {_case('class_id', FV.SHIPPED_LABELS)} AS label FROM p"""


def topk_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (SC.top_labels(SC.score_top(features(spark, sf_dir), model(), FV.TOP_K_LENGTH), model(), ["vec_id"], FV.TOP_K_LENGTH)
            .withColumn("score", F.round("score", DEC)))


SQL["topk_labels"] = f"""WITH {LOGITS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id DESC) AS rank FROM p)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(class_id AS INTEGER) AS label_id,
       round(score, {DEC}) AS score, {_case('class_id', FV.SHIPPED_LABELS)} AS label
FROM r WHERE rank <= {FV.TOP_K_LENGTH}"""


def validated_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = SC.first_two(SC.score_top(features(spark, sf_dir), model(), 2), model())
    checked = R.length_warning(two, "source_label", "label1")
    return checked.select("vec_id", "source_label", "label1", F.round("score1", DEC).alias("score1"),
                          "label2", F.round("score2", DEC).alias("score2"), "warning")


def _rules_sql() -> str:
    rows = ", ".join(f"('{s}', '{a}')" for s, acc in FV.LENGTH_RULES.items() for a in acc)
    return f"rules AS (SELECT * FROM (VALUES {rows}) AS t(source_label, accepted))"


SQL["validated_predictions"] = f"""WITH {LOGITS_SQL}, {_rules_sql()},
r AS (SELECT *, {_case('class_id', FV.SHIPPED_LABELS)} AS lab,
             row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id DESC) AS rank FROM p),
two AS (SELECT vec_id, max(CASE WHEN rank = 1 THEN lab END) AS label1,
               max(CASE WHEN rank = 1 THEN score END) AS score1,
               max(CASE WHEN rank = 2 THEN lab END) AS label2,
               max(CASE WHEN rank = 2 THEN score END) AS score2 FROM r GROUP BY vec_id)
SELECT two.vec_id, truth.source_label, label1, round(score1, {DEC}) AS score1, label2,
       round(score2, {DEC}) AS score2,
       NOT EXISTS (SELECT 1 FROM rules WHERE rules.source_label = truth.source_label
                   AND rules.accepted = two.label1) AS warning
FROM two JOIN truth USING (vec_id)"""


def argmax_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir).withColumn("pred_id", V.argmax("probs"))
    return (s.groupBy(F.col("true_id").alias("class_id"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum((F.col("pred_id") == F.col("true_id")).cast("bigint")).alias("n_correct"),
                 F.round(F.avg((F.col("pred_id") == F.col("true_id")).cast("double")), DEC)
                 .alias("accuracy")))


SQL["argmax_accuracy"] = f"""WITH {LOGITS_SQL},
pred AS (SELECT vec_id, class_id AS pred_id FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, class_id ASC) AS rn FROM p)
         WHERE rn = 1)
SELECT true_id AS class_id, count(*) AS n,
       CAST(sum(CAST(pred_id = true_id AS BIGINT)) AS BIGINT) AS n_correct,
       round(avg(CAST(pred_id = true_id AS DOUBLE)), {DEC}) AS accuracy
FROM pred JOIN truth USING (vec_id) GROUP BY true_id"""


def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    per = s.select((V.log_sum_exp("logits") - F.get("logits", F.col("true_id"))).alias("xent"))
    return per.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("xent"), DEC).alias("mean_xent"))


SQL["cross_entropy"] = f"""WITH {LOGITS_SQL}
SELECT count(*) AS n, round(avg(p.lse - p.z), {DEC}) AS mean_xent
FROM p JOIN truth ON p.vec_id = truth.vec_id AND p.class_id = truth.true_id"""


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    oh = V.one_hot("true_id", K)
    return f.select("vec_id", F.col("true_id").alias("label_id"),
                    F.array_join(F.transform(oh, lambda v: v.cast("int").cast("string")), ",")
                    .alias("one_hot"),
                    F.aggregate(oh, F.lit(0.0), lambda a, v: a + v).alias("n_hot"))


SQL["one_hot"] = f"""SELECT vec_id, CAST(label % {K} AS INTEGER) AS label_id,
  array_to_string(list_transform(range(0, {K}), lambda i: CAST(CAST(i = label % {K} AS INTEGER) AS VARCHAR)), ',')
    AS one_hot, CAST(1.0 AS DOUBLE) AS n_hot FROM embeddings"""


# ---------------------------------------------------------------- colour check
# Colour model: one class per palette colour, named as training names its folders
# (normalised); the expected colour of a vector is palette[label].
COLOR_LABELS = [" ".join(c.lower().split("_")) for c in FV.COLOR_PALETTE]


def color_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    m = SC.fixed_model(COLOR_LABELS, DIM)
    f = emb.select("vec_id", F.col("embedding").alias("features"),
                   F.element_at(F.array(*[F.lit(c) for c in FV.COLOR_PALETTE]),
                                (F.col("label") % len(FV.COLOR_PALETTE) + 1).cast("int")).alias("expected"))
    top = SC.first_two(SC.score_top(f, m, 2), m, "color")
    lit = R.color_warning(top, "expected", "color1", literal=True).withColumnRenamed("warning", "warning_literal")
    out = R.color_warning(lit, "expected", "color1")
    return out.select("vec_id", "expected", "color1", F.round("score1", DEC).alias("score1"),
                      "color2", F.round("score2", DEC).alias("score2"), "warning_literal", "warning")


SQL["color_check"] = f"""WITH {logits_sql(len(COLOR_LABELS))},
r AS (SELECT *, {_case('class_id', COLOR_LABELS)} AS lab,
             row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id DESC) AS rank FROM p),
two AS (SELECT vec_id, max(CASE WHEN rank = 1 THEN lab END) AS color1,
               max(CASE WHEN rank = 1 THEN score END) AS score1,
               max(CASE WHEN rank = 2 THEN lab END) AS color2,
               max(CASE WHEN rank = 2 THEN score END) AS score2 FROM r GROUP BY vec_id),
ex AS (SELECT vec_id, {_case(f'label % {len(FV.COLOR_PALETTE)}', FV.COLOR_PALETTE)} AS expected FROM embeddings)
SELECT two.vec_id, expected, color1, round(score1, {DEC}) AS score1, color2, round(score2, {DEC}) AS score2,
       color1 <> lower(expected) AS warning_literal,
       regexp_replace(lower(color1), '[^a-z0-9]+', ' ', 'g')
         <> regexp_replace(lower(expected), '[^a-z0-9]+', ' ', 'g') AS warning
FROM two JOIN ex USING (vec_id)"""


def top_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top three classes of each vector, named by a join to a label list that lacks the last class."""
    m = SC.fixed_model(COLOR_LABELS, DIM)
    f = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    top = SC.top_labels(SC.score_top(f, m, FV.TOP_K_COLOR), m, ["vec_id"], FV.TOP_K_COLOR).drop("label")
    labels = m.to_table(spark).filter(F.col("label_id") < len(COLOR_LABELS) - 1)
    return LK.attach_label(top, labels).withColumn("score", F.round("score", DEC))


SQL["top_colors"] = f"""WITH {logits_sql(len(COLOR_LABELS))},
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id DESC) AS rank FROM p)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(class_id AS INTEGER) AS label_id, round(score, {DEC}) AS score,
       {_case('class_id', COLOR_LABELS[:-1])} AS label
FROM r WHERE rank <= {FV.TOP_K_COLOR}"""


QUERIES = {
    "top_colors": top_colors,
    "color_check": color_check,
    "softmax_scores": softmax_scores,
    "topk_labels": topk_labels,
    "validated_predictions": validated_predictions,
    "argmax_accuracy": argmax_accuracy,
    "cross_entropy": cross_entropy,
    "one_hot": one_hot,
}
