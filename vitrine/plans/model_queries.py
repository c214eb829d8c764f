"""Feature cache, draws, gradient, training and augmentation queries, with oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as FV
from .. import sinks
from ..functions import vectors as V
from ..operators import augment as AU
from ..operators import features as FE
from ..operators import sampling as SA
from ..operators import scoring as SC
from ..operators import splits as S
from ..operators import training as T
from ..session import scratch_path, ship_package
from ..sources import files as SRC
from ..sources.tables import read_table
from . import scoring_queries as SQ
from . import split_queries as SPQ

DEC = 6
SQL: dict[str, str] = {}
DRAW_SEED = "draws"
AUG_SEED = "aug"
IMG = (8, 8)
CROP = (6, 6)


def _u16(seed: str, id_sql: str, stream: str) -> str:
    return f"('0x' || right(sha1('{seed}:' || CAST({id_sql} AS VARCHAR) || ':{stream}'), 4))::INTEGER"


def _u60(seed: str, id_sql: str, stream: str) -> str:
    return f"('0x' || right(sha1('{seed}:' || CAST({id_sql} AS VARCHAR) || ':{stream}'), 15))::BIGINT"


def _unit(seed: str, id_sql: str, stream: str) -> str:
    return f"(CAST({_u16(seed, id_sql, stream)} AS DOUBLE) / CAST(65536 AS DOUBLE))"


# ---------------------------------------------------------------- gradient step
def softmax_gradient_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = SQ.features(spark, sf_dir)
    out = T.gradient_step(f, SQ.model(), FV.LEARNING_RATE, "features", "true_id")
    return out.select("class_id", "dim", F.round("grad", DEC).alias("grad"),
                      F.round("weight", DEC).alias("weight"))


SQL["softmax_gradient_step"] = f"""WITH {SQ.LOGITS_SQL},
res AS (SELECT p.vec_id, p.class_id,
               p.score - CASE WHEN p.class_id = t.true_id THEN 1.0 ELSE 0.0 END AS r
        FROM p JOIN truth t USING (vec_id)),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM embeddings),
g AS (SELECT res.class_id, CAST(e.d AS INTEGER) AS dim,
             sum(res.r * CAST(e.x AS DOUBLE)) / (SELECT n FROM nn) AS grad
      FROM res JOIN e USING (vec_id) GROUP BY res.class_id, e.d
      UNION ALL
      SELECT class_id, -1, sum(r) / (SELECT n FROM nn) FROM res GROUP BY class_id)
SELECT CAST(class_id AS INTEGER) AS class_id, dim, round(grad, {DEC}) AS grad,
       round(CASE WHEN dim < 0 THEN 0.0
                  ELSE CAST(((class_id * 31 + dim * 17) % 13) - 6 AS DOUBLE) / 10.0 END
             - {FV.LEARNING_RATE} * grad, {DEC}) AS weight
FROM g"""


# ---------------------------------------------------------------- balanced draws
def balanced_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = SPQ.split_lists(spark, sf_dir)       # numbered rows are already checkpointed
    n = pool.filter(F.col("split") == "training").count()       # one draw per pool image
    return SA.balanced_draws(spark, pool, n, "training", DRAW_SEED)


SQL["balanced_draws"] = f"""WITH {SPQ.INDEX_SQL}, {SPQ.SPLIT_SQL},
pool AS (SELECT label, split, key,
                row_number() OVER (PARTITION BY label, split ORDER BY key) - 1 AS idx
         FROM splitted WHERE split = 'training'),
allc AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS class_id
         FROM (SELECT DISTINCT label FROM splitted)),
sizes AS (SELECT label, count(*) AS n FROM pool GROUP BY label),
ne AS (SELECT s.label, s.n, a.class_id,
              CAST(row_number() OVER (ORDER BY a.class_id) - 1 AS INTEGER) AS label_pos
       FROM sizes s JOIN allc a USING (label)),
dr AS (SELECT range AS draw_id,
              {_u60(DRAW_SEED, 'range', 'label')} % (SELECT count(*) FROM ne) AS label_pos,
              {_u60(DRAW_SEED, 'range', 'image')} AS image_index
       FROM range(0, (SELECT count(*) FROM pool)))
SELECT dr.draw_id, ne.class_id, ne.label, dr.image_index,
       CAST(dr.image_index % ne.n AS BIGINT) AS idx, pool.key
FROM dr JOIN ne ON ne.label_pos = dr.label_pos
JOIN pool ON pool.label = ne.label AND pool.idx = dr.image_index % ne.n"""


# ---------------------------------------------------------------- feature cache
def missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = SPQ.hash_split(spark, sf_dir).select("doc_id", "label", "key", "split")
    cache = read_table(spark, sf_dir, "embeddings").select("vec_id")
    return FE.missing_keys(idx, cache.withColumnRenamed("vec_id", "doc_id"), "doc_id", "doc_id")


SQL["missing_features"] = f"""WITH {SPQ.INDEX_SQL}, {SPQ.SPLIT_SQL}
SELECT doc_id, label, key, split FROM splitted s
WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = s.doc_id)"""


def weighted_sum(vec: str):
    """Sum of value times place, from one."""
    return F.aggregate(F.transform(vec, lambda v, i: v.cast("double") * (i + 1)),
                       F.lit(0.0).cast("double"), lambda a, v: a + v)


def feature_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed the cache with the embeddings, fill it for every document, fill it again (which adds nothing), merge
    its fills and read it back: each vector by a weighted sum of its values."""
    path = scratch_path(spark, "feature-cache")
    emb = read_table(spark, sf_dir, "embeddings")
    FE.add_vectors(spark, emb.select(F.col("vec_id").alias("key"), F.lit(None).alias("content_hash"), F.col("embedding").alias("features")),
                   path, "v1", batch_id="seed")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    added = [FE.fill_cache(spark, docs, path, "doc_id", ["text"], FE.text_histogram_factory(64), "v1", 64) for _ in range(2)]
    FE.compact_cache(spark, path, "v1")
    cache = FE.read_cache(spark, path)
    return cache.select("key",
                        F.when(F.col("batch_id") == "seed", "cached").otherwise("computed").alias("origin"),
                        F.lit(added[0]).cast("bigint").alias("added"), F.lit(added[1]).cast("bigint").alias("added_again"),
                        F.size("features").alias("n_dims"), F.round(weighted_sum("features"), 4).alias("checksum"))


# the stand-in's vector of a document: the shares of its bytes by their value modulo 64, as floats
SQL["feature_fill"] = """
WITH new AS (SELECT CAST(doc_id AS VARCHAR) AS key, hex(encode(coalesce(text, ''))) AS h FROM documents
             WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)),
bytes AS (SELECT key, length(h) // 2 AS n, unnest(range(length(h) // 2)) AS i, h FROM new),
cells AS (SELECT key, n, ('0x' || substr(h, 2 * i + 1, 2))::INTEGER % 64 AS cell, count(*) AS c
          FROM bytes GROUP BY ALL),
sums AS (SELECT key, sum(CAST(CAST(CAST(c AS DOUBLE) / n AS FLOAT) AS DOUBLE) * (cell + 1)) AS s
         FROM (SELECT key, n, cell, sum(c) AS c FROM cells GROUP BY ALL) GROUP BY key)
SELECT CAST(vec_id AS VARCHAR) AS key, 'cached' AS origin, (SELECT count(*) FROM new) AS added, CAST(0 AS BIGINT) AS added_again,
       CAST(len(embedding) AS INTEGER) AS n_dims,
       round(list_sum(list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * i)), 4) AS checksum
FROM embeddings
UNION ALL
SELECT key, 'computed', (SELECT count(*) FROM new), CAST(0 AS BIGINT), 64, round(coalesce(s, 0), 4) FROM new LEFT JOIN sums USING (key)"""


def feature_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors -> ``key<TAB>csv`` text -> parsed back, compared with the originals."""
    path = scratch_path(spark, "vector-text")
    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("features"))
    sinks.write_vectors_text(emb, path)
    back = SRC.read_vector_text(spark, path)
    joined = back.join(emb.withColumnRenamed("features", "orig"), "key")
    checksum = weighted_sum("features")
    return joined.select(F.col("key").cast("bigint").alias("vec_id"),
                         F.size("features").alias("n_values"),
                         F.round(checksum, DEC).alias("checksum"),
                         (F.col("features") == F.col("orig")).alias("roundtrip_ok"))


SQL["vector_csv"] = f"""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_values,
       round(list_sum(list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * i)), {DEC}) AS checksum,
       true AS roundtrip_ok
FROM embeddings"""


# ---------------------------------------------------------------- training
FULL_ITER, FULL_TOL, FULL_GRADIENT = 200, 1e-9, 2e-3
SGD_SEED, SGD_STEPS, SGD_EVAL, SGD_RATE = "sgd", 3, 2, 0.05
DESCENT_STEPS = 3
FIT_DEC, SQL_FIT_STEPS = 5, 2000


def _training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = SQ.features(spark, sf_dir).withColumn("key", F.col("vec_id").cast("string"))
    return S.assign_split(f.withColumn("label", SQ.model().label_of("true_id")), "key")


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.indexed_split_lists(_training_frame(spark, sf_dir), "label", "key")


def _sgd(spark: SparkSession, sf_dir: str, vectors: DataFrame, init: SC.SoftmaxModel, **how) -> tuple:
    """Each batch has as many draws as its split has images, so the work grows with the pool."""
    pool = _pool(spark, sf_dir)
    n = dict(pool.groupBy("split").count().collect())
    return T.train_sgd(spark, pool, vectors, FV.SHIPPED_LABELS, SGD_STEPS, n.get("training", 0), SGD_RATE, SGD_EVAL,
                       n.get("validation", 0), n.get("testing", 0), SGD_SEED, init=init, **how)


def _metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select("step", *[F.round(c, DEC).alias(c) for c in metrics.columns if c != "step"])


def sgd_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of gradient descent from the fixed model over hash-drawn batches: the schedule's metrics."""
    vectors = _training_frame(spark, sf_dir).select("key", "features")
    return _metrics(_sgd(spark, sf_dir, vectors, SQ.model())[1])


def sgd_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original schedule, 4,000 steps of 100 draws with a measure at every tenth and a test of 500 at the
    last, from the truncated normal start, in one barrier job."""
    vectors = _training_frame(spark, sf_dir).select("key", "features")
    return _metrics(T.train_sgd(spark, _pool(spark, sf_dir), vectors, FV.SHIPPED_LABELS, seed=SGD_SEED)[1])


def sgd_augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps where images vary: each draw's image is augmented afresh and its vector computed, while validation
    and test take the cached vectors of the images as they are: the schedule's metrics."""
    pixels = _pixels(spark, sf_dir).select(F.col("vec_id").cast("string").alias("key"), "pixels")
    factory = mean_rows_factory(IMG[0])
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("flat"))
    cached = FE.extract_features(emb, factory, "v1", "key", ["flat"], IMG[0])
    return _metrics(_sgd(spark, sf_dir, cached, SC.fixed_model(FV.SHIPPED_LABELS, IMG[0]), pixels=pixels, augment=AUG_TRAIN,
                         extractor_factory=factory)[1])


def _descent(spark: SparkSession, sf_dir: str) -> SC.SoftmaxModel:
    rows = _training_frame(spark, sf_dir).filter(F.col("split") == "training")
    return T.train_descent(rows, SQ.model(), DESCENT_STEPS, SGD_RATE)


def train_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model after steps of gradient descent over every row of the training split, written by the model
    sink and read back."""
    path = scratch_path(spark, "model")
    sinks.write_model(_descent(spark, sf_dir).to_table(spark), path)
    return spark.read.parquet(path).select(
        F.col("label_id").alias("class_id"), "label",
        F.posexplode(F.concat(F.array("bias"), "weights")).alias("at", "value")).select(
        "class_id", "label", (F.col("at") - 1).cast("int").alias("dim"), F.round("value", DEC).alias("value"))


def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and cross-entropy over the whole splits of the L-BFGS fit to every row of the training split. The
    fit ends where the loss no longer changes in double precision, with measures right to about 1e-8."""
    data = _training_frame(spark, sf_dir)
    model = T.train_lbfgs(data.filter(F.col("split") == "training"), FV.SHIPPED_LABELS, max_iter=FULL_ITER, tol=FULL_TOL)
    out = T.evaluate(data, model, ["split"])
    return out.select("split", "n", F.round("accuracy", DEC).alias("accuracy"), F.round("mean_xent", FIT_DEC).alias("mean_xent"))


def train_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The L-BFGS fit to every row of the training split, written by the model sink and read back. Of each
    weight (dim -1 is the bias): its class, the rows fitted to, the mean over them of the class's own
    values there, and whether the model is the best fit: at that the model's expected mean is the own one
    for every weight, here to ``FULL_GRADIENT`` over the root of n, far below what chance leaves
    between the two in a model that was not fitted."""
    path = scratch_path(spark, "full-model")
    rows = _training_frame(spark, sf_dir).filter(F.col("split") == "training")
    sinks.write_model(T.train_lbfgs(rows, FV.SHIPPED_LABELS, max_iter=FULL_ITER, tol=FULL_TOL).to_table(spark), path)
    found = SC.SoftmaxModel.from_table(spark.read.parquet(path))
    own = (rows.select("true_id", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("features").cast("array<double>"))).alias("at", "x"))
           .groupBy((F.col("true_id")).alias("class_id"), (F.col("at") - 1).cast("int").alias("dim")).agg(F.sum("x").alias("total")))
    n = rows.count()
    off = T.gradient(rows, found).withColumn("worst", F.max(F.abs("grad")).over(Window.partitionBy()))       # K x (D+1) rows
    return (off.join(own, ["class_id", "dim"], "left")
            .select("class_id", found.label_of("class_id").alias("label"), "dim", F.lit(n).cast("bigint").alias("n"),
                    F.round(F.coalesce("total", F.lit(0.0)) / n, DEC).alias("own_mean"),
                    (F.col("worst") < FULL_GRADIENT / max(1, n) ** 0.5).alias("fitted")))


def _size_sql(split: str) -> str:
    return f"(SELECT count(*) FROM rows_ WHERE split = '{split}')"


def _draws_sql(name: str, what: str, split: str, batches: int) -> str:
    """A class-balanced batch list: draw number, vector and class; a batch has as many as the split has images."""
    return f"""
{name} AS (
  SELECT r.range AS draw_id, r.range // {_size_sql(split)} AS turn, m.vec_id, c.class_id
  FROM range(0, {batches} * {_size_sql(split)}) r
  JOIN classes c ON c.split = '{split}' AND c.place = {_u60(f'{SGD_SEED}:{what}', 'r.range', 'label')} % c.n_classes
  JOIN members m ON m.split = '{split}' AND m.class_id = c.class_id
       AND m.place = {_u60(f'{SGD_SEED}:{what}', 'r.range', 'image')} % c.n)"""


def _scored_sql(name: str, weights: str, rows: str, x: str = "x") -> str:
    """Probabilities p, hit and cross-entropy of each row of ``rows`` (id, vec_id, class_id)."""
    return f"""
{name}_z AS (SELECT b.id, b.vec_id, b.class_id, w.class_id AS k, sum(w.w * x.x) AS z
             FROM ({rows}) b JOIN {x} x USING (vec_id) JOIN {weights} w ON w.dim = x.dim GROUP BY ALL),
{name}_p AS (SELECT *, exp(z - max(z) OVER (PARTITION BY id)) AS e, max(z) OVER (PARTITION BY id) AS top FROM {name}_z),
{name} AS (SELECT *, e / sum(e) OVER (PARTITION BY id) AS p, top + ln(sum(e) OVER (PARTITION BY id)) AS lse,
                  row_number() OVER (PARTITION BY id ORDER BY z DESC, k) AS place FROM {name}_p)"""


def _step_sql(step: int, batch: str, x: str = "x") -> str:
    """The scored batch s<step>, and the weights after it."""
    return _scored_sql(f"s{step}", f"w{step}", batch, x) + f""",
w{step + 1} AS (SELECT w.class_id, w.dim, w.w - {SGD_RATE} * g.g AS w
      FROM w{step} w JOIN (SELECT s.k, x.dim, sum((s.p - CAST(s.k = s.class_id AS INTEGER)) * x.x) / {_size_sql('training')} AS g
                           FROM s{step} s JOIN {x} x USING (vec_id) GROUP BY s.k, x.dim) g ON g.k = w.class_id AND g.dim = w.dim)"""


def _accuracy_sql(name: str) -> str:
    return f"(SELECT avg(CAST(k = class_id AS DOUBLE)) FROM {name} WHERE place = 1)"


def _rows_sql(dim: int) -> str:
    """keyed, parted, rows_, members, classes, x (bias first) and the fixed model w0 of ``dim`` dimensions."""
    return f"""
keyed AS (SELECT vec_id, CAST(label % {SQ.K} AS INTEGER) AS class_id, CAST(vec_id AS VARCHAR) AS key FROM embeddings),
parted AS (SELECT *, CAST(('0x' || right(sha1(key), 4))::INTEGER AS DOUBLE) * (CAST(100 AS DOUBLE) / CAST(65535.0 AS DOUBLE)) AS pct
           FROM keyed),
rows_ AS (SELECT *, CASE WHEN pct < {float(FV.DEFAULT_VALIDATION_PCT)} THEN 'validation'
                         WHEN pct < {float(FV.DEFAULT_VALIDATION_PCT + FV.DEFAULT_TESTING_PCT)} THEN 'testing'
                         ELSE 'training' END AS split FROM parted),
members AS (SELECT *, row_number() OVER (PARTITION BY split, class_id ORDER BY key) - 1 AS place FROM rows_),
classes AS (SELECT split, class_id, count(*) AS n, row_number() OVER (PARTITION BY split ORDER BY class_id) - 1 AS place,
                   count(*) OVER (PARTITION BY split) AS n_classes FROM rows_ GROUP BY split, class_id),
x AS (SELECT vec_id, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
      UNION ALL SELECT vec_id, -1, 1.0 FROM embeddings),
w0 AS (SELECT CAST(c.range AS INTEGER) AS class_id, CAST(d.range AS INTEGER) AS dim,
              CASE WHEN d.range < 0 THEN 0.0 ELSE CAST(((c.range * 31 + d.range * 17) % 13) - 6 AS DOUBLE) / 10.0 END AS w
       FROM range(0, {SQ.K}) c, range(-1, {dim}) d)"""


MEASURED = [s for s in range(SGD_STEPS) if s % SGD_EVAL == 0 or s + 1 == SGD_STEPS]
_ALL_DRAWS = [_draws_sql("train_draws", "train", "training", SGD_STEPS),
              _draws_sql("validation_draws", "validation", "validation", len(MEASURED)),
              _draws_sql("test_draws", "test", "testing", 1)]


def _schedule_sql(train_id: str = "vec_id", x_train: str = "x", x_cached: str = "x") -> list[str]:
    """The steps over the draws. A training draw's vector is that of its ``train_id`` in ``x_train``."""
    parts = []
    for step in range(SGD_STEPS):
        batch = f"SELECT draw_id AS id, {train_id} AS vec_id, class_id FROM train_draws WHERE turn = {step}"
        parts.append(_step_sql(step, batch, x_train))
        if step in MEASURED:
            val = f"SELECT draw_id AS id, vec_id, class_id FROM validation_draws WHERE turn = {MEASURED.index(step)}"
            parts += [_scored_sql(f"t{step}", f"w{step + 1}", batch, x_train), _scored_sql(f"v{step}", f"w{step + 1}", val, x_cached)]
    parts.append(_scored_sql("final_test", f"w{SGD_STEPS}", "SELECT draw_id AS id, vec_id, class_id FROM test_draws", x_cached))
    return parts


_METRICS_SQL = " UNION ALL ".join(f"""
SELECT {s} AS step, round({_accuracy_sql(f't{s}')}, {DEC}) AS train_accuracy,
       round((SELECT avg(lse - z) FROM t{s} WHERE k = class_id), {DEC}) AS cross_entropy,
       round({_accuracy_sql(f'v{s}')}, {DEC}) AS validation_accuracy,
       {f"round({_accuracy_sql('final_test')}, {DEC})" if s + 1 == SGD_STEPS else 'CAST(NULL AS DOUBLE)'} AS test_accuracy"""
                                  for s in MEASURED)
_SGD_SQL = "WITH" + ",".join([_rows_sql(SQ.DIM), *_ALL_DRAWS, *_schedule_sql()])
SQL["sgd_steps"] = _SGD_SQL + _METRICS_SQL



def _schedule_draws_sql(name: str, what: str, split: str, n: int, size: int) -> str:
    """n batches of a fixed size: turn, class and the vector with the bias first."""
    return f"""
{name} AS MATERIALIZED (
  SELECT r.range // {size} AS turn, c.class_id, list_prepend(1.0, list_transform(e.embedding, lambda v: CAST(v AS DOUBLE))) AS xs
  FROM range(0, {n * size}) r
  JOIN classes c ON c.split = '{split}' AND c.place = {_u60(f'{SGD_SEED}:{what}', 'r.range', 'label')} % c.n_classes
  JOIN members m ON m.split = '{split}' AND m.class_id = c.class_id
       AND m.place = {_u60(f'{SGD_SEED}:{what}', 'r.range', 'image')} % c.n
  JOIN embeddings e ON e.vec_id = m.vec_id)"""


def _whole_schedule_sql() -> str:
    """The 4,000 steps as a recursion over the weights, a list of a list for each class."""
    measured = [s for s in range(FV.TRAINING_STEPS) if s % FV.EVAL_INTERVAL == 0 or s + 1 == FV.TRAINING_STEPS]
    start = T.init_model(FV.SHIPPED_LABELS, SQ.DIM)
    weights = "[" + ", ".join(str([0.0, *w]) for w in start.weights) + "]"
    z = "list_transform(w, lambda wk: list_dot_product(wk, xs))"
    e = "list_transform(z, lambda v: exp(v - list_max(z)))"
    return f"""WITH RECURSIVE {_rows_sql(SQ.DIM)},
{_schedule_draws_sql('batches', 'train', 'training', FV.TRAINING_STEPS, FV.TRAIN_BATCH)},
{_schedule_draws_sql('validations', 'validation', 'validation', len(measured), FV.VALIDATION_BATCH)},
{_schedule_draws_sql('tests', 'test', 'testing', 1, FV.TEST_BATCH)},
model AS (
  SELECT 0 AS step, CAST({weights} AS DOUBLE[][]) AS w
  UNION ALL
  SELECT any_value(step) + 1, list(wk ORDER BY k) FROM (
    SELECT step, k, list(old - {FV.LEARNING_RATE} * g / {FV.TRAIN_BATCH} ORDER BY dim) AS wk FROM (
      SELECT step, k, dim, any_value(w[k][dim]) AS old, sum((p[k] - CAST(k = class_id + 1 AS INTEGER)) * xs[dim]) AS g
      FROM (SELECT step, w, class_id, xs, list_transform(e, lambda v: v / list_sum(e)) AS p
            FROM (SELECT *, {e} AS e FROM (SELECT step, w, class_id, xs, {z} AS z FROM model JOIN batches b ON b.turn = model.step))),
           (SELECT unnest(range(1, {SQ.K + 1})) AS k), (SELECT unnest(range(1, {SQ.DIM + 2})) AS dim)
      GROUP BY step, k, dim) GROUP BY step, k) HAVING count(*) > 0),
kept AS MATERIALIZED (
  SELECT step - 1 AS step, row_number() OVER (ORDER BY step) - 1 AS turn, w FROM model
  WHERE step > 0 AND ((step - 1) % {FV.EVAL_INTERVAL} = 0 OR step = {FV.TRAINING_STEPS})),
scored AS (
  SELECT step, part, avg(CAST(list_position(z, list_max(z)) = class_id + 1 AS DOUBLE)) AS accuracy,
         avg(list_max(z) + ln(list_sum({e})) - z[class_id + 1]) AS xent
  FROM (SELECT step, part, class_id, {z} AS z
        FROM (SELECT k.step, 'train' AS part, w, class_id, xs FROM kept k JOIN batches b ON b.turn = k.step
              UNION ALL SELECT k.step, 'validation', w, class_id, xs FROM kept k JOIN validations b ON b.turn = k.turn
              UNION ALL SELECT k.step, 'test', w, class_id, xs FROM kept k JOIN tests b ON k.step + 1 = {FV.TRAINING_STEPS}))
  GROUP BY step, part)
SELECT t.step, round(t.accuracy, {DEC}) AS train_accuracy, round(t.xent, {DEC}) AS cross_entropy,
       round(v.accuracy, {DEC}) AS validation_accuracy, round(e.accuracy, {DEC}) AS test_accuracy
FROM scored t LEFT JOIN scored v ON v.step = t.step AND v.part = 'validation' LEFT JOIN scored e ON e.step = t.step AND e.part = 'test'
WHERE t.part = 'train'"""


SQL["sgd_schedule"] = _whole_schedule_sql()

_TRAIN_ROWS = "SELECT vec_id AS id, vec_id, class_id FROM rows_ WHERE split = 'training'"
_DESCENT_SQL = "WITH" + ",".join([
    _rows_sql(SQ.DIM), *[_step_sql(step, _TRAIN_ROWS) for step in range(DESCENT_STEPS)],
    _scored_sql("every", f"w{DESCENT_STEPS}", "SELECT vec_id AS id, vec_id, class_id FROM rows_")])
SQL["train_softmax"] = _DESCENT_SQL + f"""
SELECT class_id, {SQ._case('class_id', FV.SHIPPED_LABELS)} AS label, dim, round(w, {DEC}) AS value FROM w{DESCENT_STEPS}"""


def _fit_sql() -> str:
    """The best fit by accelerated gradient steps as a recursion over the weights v and the point a step is taken from. Each dimension is
    divided by its root mean square over the training split; then half the largest row sum of their products
    bounds the curvature, which gives the rate."""
    z = "list_transform(point, lambda wk: list_dot_product(wk, xs))"
    e = "list_transform(z, lambda u: exp(u - list_max(z)))"
    zero = f"list_transform(range({SQ.K}), lambda k: list_transform(range({SQ.DIM + 1}), lambda d: CAST(0 AS DOUBLE)))"
    return f"""WITH RECURSIVE {_rows_sql(SQ.DIM)},
splits AS (SELECT key, any_value(split) AS split FROM rows_ GROUP BY key),
vectors AS MATERIALIZED (
  SELECT s.split, CAST(e.label % {SQ.K} AS INTEGER) AS class_id,
         list_prepend(1.0, list_transform(e.embedding, lambda u: CAST(u AS DOUBLE))) AS xs
  FROM embeddings e JOIN splits s ON s.key = CAST(e.vec_id AS VARCHAR)),
dims AS (SELECT unnest(range(1, {SQ.DIM + 2})) AS dim),
sizes AS MATERIALIZED (
  SELECT list(coalesce(1 / nullif(sqrt(m), 0), 0) ORDER BY dim) AS by_dim
  FROM (SELECT dim, avg(xs[dim] * xs[dim]) AS m FROM vectors, dims WHERE split = 'training' GROUP BY dim)),
scaled AS MATERIALIZED (SELECT split, class_id, list_transform(xs, lambda u, i: u * by_dim[i]) AS xs FROM vectors, sizes),
rate AS MATERIALIZED (
  SELECT 2 / max(total) AS rate, any_value(n) AS n
  FROM (SELECT a, sum(abs(product)) AS total, any_value(n) AS n
        FROM (SELECT i.dim AS a, j.dim AS b, avg(xs[i.dim] * xs[j.dim]) AS product, count(*) AS n
              FROM scaled, dims i, dims j WHERE split = 'training' GROUP BY i.dim, j.dim) GROUP BY a)),
model AS (
  SELECT 0 AS step, {zero} AS v, {zero} AS point
  UNION ALL
  SELECT any_value(step) + 1, list(new_k ORDER BY k), list(point_k ORDER BY k) FROM (
    SELECT step, k, list(new ORDER BY dim) AS new_k, list(new + step / (step + 3) * (new - old) ORDER BY dim) AS point_k FROM (
      SELECT step, k, dim, any_value(v[k][dim]) AS old,
             any_value(point[k][dim]) - any_value(rate / n) * sum((p[k] - CAST(k = class_id + 1 AS INTEGER)) * xs[dim]) AS new
      FROM (SELECT step, v, point, class_id, xs, list_transform(e, lambda u: u / list_sum(e)) AS p
            FROM (SELECT *, {e} AS e
                  FROM (SELECT step, v, point, class_id, xs, {z} AS z FROM model, scaled WHERE split = 'training' AND step < {SQL_FIT_STEPS}))),
           (SELECT unnest(range(1, {SQ.K + 1})) AS k), dims, rate
      GROUP BY step, k, dim) GROUP BY step, k) HAVING count(*) > 0)
SELECT split, count(*) AS n, round(avg(CAST(list_position(z, list_max(z)) = class_id + 1 AS DOUBLE)), {DEC}) AS accuracy,
       round(avg(list_max(z) + ln(list_sum({e})) - z[class_id + 1]), {FIT_DEC}) AS mean_xent
FROM (SELECT split, class_id, {z.replace('point', 'v')} AS z FROM scaled, (SELECT v FROM model WHERE step = {SQL_FIT_STEPS}))
GROUP BY split"""


SQL["training_metrics"] = _fit_sql()

SQL["train_full"] = "WITH" + _rows_sql(SQ.DIM) + f""",
split_rows AS (SELECT vec_id, class_id FROM rows_ WHERE split = 'training')
SELECT w.class_id, {SQ._case('w.class_id', FV.SHIPPED_LABELS)} AS label, w.dim, (SELECT count(*) FROM split_rows) AS n,
       round(coalesce(sum(x.x), 0) / (SELECT count(*) FROM split_rows), {DEC}) AS own_mean, true AS fitted
FROM w0 w LEFT JOIN (split_rows r JOIN x USING (vec_id)) ON r.class_id = w.class_id AND x.dim = w.dim GROUP BY w.class_id, w.dim"""


# ---------------------------------------------------------------- augmentation
def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, pixels): the embeddings as image tensors of one channel."""
    ship_package(spark)
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", AU.pack("embedding", F.lit(IMG[0]), F.lit(IMG[1]), F.lit(1)).alias("pixels"))


AUG_DRAW = AU.Augmentation(*CROP, flip=True, crop=10, scale=20, brightness=20)
AUG_PLAIN = AU.Augmentation(*CROP, flip=True, brightness=20)
AUG_SCALE = AU.Augmentation(*IMG, crop=10, scale=20)
AUG_TRAIN = AU.Augmentation(*IMG, flip=True, crop=10, scale=20, brightness=20)


def augment_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = AU.augment_params(_pixels(spark, sf_dir), "vec_id", AUG_SEED, AUG_DRAW)
    return p.select("vec_id", "flip", F.round("scale", DEC).alias("scale"), "scaled_h", "scaled_w", "crop_y", "crop_x",
                    F.round("brightness", DEC).alias("brightness"))


def _params_sql(how: AU.Augmentation, table: str = "embeddings", key: str = "vec_id", seed: str = AUG_SEED) -> str:
    def crop(name: str, size: int, scaled: str) -> str:
        return f"CAST({_u16(seed, key, f'crop_{name}')} % ({scaled} - {size} + 1) AS INTEGER) AS crop_{name}"

    return f"""
prm0 AS (SELECT *, {f"{_unit(seed, key, 'flip')} < 0.5" if how.flip else 'false'} AS flip,
                ({1.0 + how.crop / 100.0!r} * (1.0 + {how.scale / 100.0!r} * {_unit(seed, key, 'scale')})) AS scale,
                {1.0 - how.brightness / 100.0!r} + {2.0 * how.brightness / 100.0!r} * {_unit(seed, key, 'brightness')} AS brightness
         FROM {table}),
prm1 AS (SELECT *, CAST(floor(scale * {float(how.height)}) AS INTEGER) AS scaled_h,
                CAST(floor(scale * {float(how.width)}) AS INTEGER) AS scaled_w FROM prm0),
prm AS (SELECT *, {crop('y', how.height, 'scaled_h')}, {crop('x', how.width, 'scaled_w')} FROM prm1)"""


def _pixels_sql(how: AU.Augmentation, key: str = "vec_id") -> str:
    """Each pixel of the augmented images: the four neighbours of its place in the source."""
    def at(y: str, x: str) -> str:
        return f"CAST(embedding[{y} * {IMG[1]} + {x} + 1] AS DOUBLE)"

    return f"""
grid AS (SELECT CAST(a.range AS INTEGER) AS r, CAST(b.range AS INTEGER) AS c FROM range(0, {how.height}) a, range(0, {how.width}) b),
place AS (SELECT *, (crop_y + r) * (CAST({IMG[0]} AS DOUBLE) / scaled_h) AS sy,
                 (crop_x + CASE WHEN flip THEN {how.width - 1} - c ELSE c END) * (CAST({IMG[1]} AS DOUBLE) / scaled_w) AS sx
          FROM prm, grid),
corner AS (SELECT *, CAST(floor(sy) AS INTEGER) AS y0, CAST(floor(sx) AS INTEGER) AS x0, sy - floor(sy) AS dy, sx - floor(sx) AS dx,
                  least(CAST(floor(sy) AS INTEGER) + 1, {IMG[0] - 1}) AS y1, least(CAST(floor(sx) AS INTEGER) + 1, {IMG[1] - 1}) AS x1
           FROM place),
pixel AS (SELECT *, (({at('y0', 'x0')} * (1 - dx) + {at('y0', 'x1')} * dx) * (1 - dy)
                     + ({at('y1', 'x0')} * (1 - dx) + {at('y1', 'x1')} * dx) * dy) * brightness AS value FROM corner)"""


SQL["augment_draws"] = f"""WITH {_params_sql(AUG_DRAW)}
SELECT vec_id, flip, round(scale, {DEC}) AS scale, scaled_h, scaled_w, crop_y, crop_x, round(brightness, {DEC}) AS brightness
FROM prm"""


def _pixel_rows(spark: SparkSession, sf_dir: str, how: AU.Augmentation) -> DataFrame:
    p = AU.augment_params(_pixels(spark, sf_dir), "vec_id", AUG_SEED, how)
    a = AU.augment_tensors(p, "pixels", how, keep_cols=["vec_id"])
    return a.select("vec_id", F.posexplode(AU.values("augmented")).alias("at", "v")).select(
        "vec_id", F.expr(f"cast(at div {how.width} as int)").alias("r"), (F.col("at") % how.width).cast("int").alias("c"),
        F.round("v", DEC).alias("value"))


def augment_flip_crop_brightness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No random scale: the image is resized to the model's size, then flipped and brightened."""
    return _pixel_rows(spark, sf_dir, AUG_PLAIN)


def augment_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random scale (bilinear resize), then a random crop to the model's size: every pixel."""
    return _pixel_rows(spark, sf_dir, AUG_SCALE)


for _name, _how in (("augment_flip_crop_brightness", AUG_PLAIN), ("augment_scale", AUG_SCALE)):
    SQL[_name] = f"""WITH {_params_sql(_how)}, {_pixels_sql(_how)}
SELECT vec_id, r, c, round(value, {DEC}) AS value FROM pixel"""


def mean_rows_factory(dim: int):
    """Stand-in extractor of flat pixels: the mean of each of ``dim`` equal stretches."""
    def factory():
        def fn(pdf):
            import numpy as np

            flat = np.stack(pdf["flat"].to_numpy())
            return flat.reshape(len(flat), dim, -1).mean(axis=2)
        return fn
    return factory


def augmented_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many draws as there are training images, each augmented afresh and passed through an extractor: what
    a step trains on where images vary."""
    pool = _pool(spark, sf_dir)
    n = pool.filter(F.col("split") == "training").count()
    draws = SA.balanced_draws(spark, pool, n, "training", f"{SGD_SEED}:train", FV.SHIPPED_LABELS)
    pixels = _pixels(spark, sf_dir).select(F.col("vec_id").cast("string").alias("key"), "pixels")
    out = T.augmented_draws(draws.withColumn("step", F.col("draw_id").cast("int")), pixels, "key", AUG_DRAW, AUG_SEED,
                            mean_rows_factory(CROP[0]), "v1", CROP[0], "features")
    return out.select(F.col("step").cast("bigint").alias("draw_id"), "true_id", F.posexplode("features").alias("dim", "v")).select(
        "draw_id", "true_id", F.col("dim").cast("int").alias("dim"), F.round(F.col("v").cast("double"), 4).alias("value"))


_DRAWN_SQL = "drawn AS (SELECT d.draw_id, d.turn, d.class_id, e.embedding FROM train_draws d JOIN embeddings e USING (vec_id))"
SQL["augmented_batch"] = "WITH" + ",".join([_rows_sql(SQ.DIM), _draws_sql("train_draws", "train", "training", 1), _DRAWN_SQL,
                                            _params_sql(AUG_DRAW, 'drawn', 'draw_id'), _pixels_sql(AUG_DRAW)]) + """
SELECT draw_id, class_id AS true_id, r AS dim, round(CAST(CAST(avg(value) AS FLOAT) AS DOUBLE), 4) AS value
FROM pixel GROUP BY draw_id, class_id, r"""

SQL["sgd_augmented"] = "WITH" + ",".join([
    _rows_sql(IMG[0]), *_ALL_DRAWS, _DRAWN_SQL, _params_sql(AUG_TRAIN, 'drawn', 'draw_id', f"{SGD_SEED}:augment"), _pixels_sql(AUG_TRAIN), f"""
xt AS (SELECT draw_id AS vec_id, r AS dim, CAST(CAST(avg(value) AS FLOAT) AS DOUBLE) AS x FROM pixel GROUP BY draw_id, r
       UNION ALL SELECT draw_id, -1, 1.0 FROM drawn),
xc AS (SELECT vec_id, CAST(dim // {IMG[1]} AS INTEGER) AS dim, CAST(CAST(avg(x) AS FLOAT) AS DOUBLE) AS x FROM x WHERE dim >= 0
       GROUP BY vec_id, dim // {IMG[1]} UNION ALL SELECT vec_id, -1, 1.0 FROM embeddings)""",
    *_schedule_sql("draw_id", "xt", "xc")]) + _METRICS_SQL


QUERIES = {
    "softmax_gradient_step": softmax_gradient_step,
    "balanced_draws": balanced_draws,
    "missing_features": missing_features,
    "feature_fill": feature_fill,
    "vector_csv": feature_csv_roundtrip,
    "sgd_steps": sgd_steps,
    "sgd_schedule": sgd_schedule,
    "sgd_augmented": sgd_augmented,
    "train_softmax": train_softmax,
    "train_full": train_full,
    "training_metrics": training_metrics,
    "augment_draws": augment_draws,
    "augment_flip_crop_brightness": augment_flip_crop_brightness,
    "augment_scale": augment_scale,
    "augmented_batch": augmented_batch,
}
