import corpus_pipeline
import numpy as np
import pytest
from vitrine.llm import decontaminate, quality, simhash, toxicity

AT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, as lists of rows."""
    from vitrine.llm.common import stored
    from vitrine.session import ship_package
    ship_package(spark)
    docs, out = spark.read.parquet(f"{AT}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, AT), f"test-{name}")
        out[name] = docs, after
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "mixing"]
    for name, (before, after) in stages.items():
        assert after.columns == (before.columns if name != "mixing" else [*before.columns, "copy", "rate"])


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    net = toxicity.fit(before, spark.read.parquet(f"{AT}/labels.parquet"))
    rows = before.collect()
    scores = toxicity.text_scores(net, [r.text for r in rows])
    kept = {r.doc_id for r, s in zip(rows, scores) if s < 0.5}
    assert set(ids(after)) == kept
    assert len(kept) > 0.75 * len(rows)


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    assert set(ids(after)) == set(ids(quality.resample(before, spark.read.parquet(f"{AT}/labels.parquet"))))


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    rows = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in before.collect()}
    doc_ids = sorted(rows)
    fps = np.array([rows[i] for i in doc_ids], np.uint64)
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= 3) for f in fps]
    group = list(range(len(fps)))
    for i in range(len(fps)):                              # smallest first: flood each group from it
        if group[i] == i:
            todo = [i]
            while todo:
                for j in near[todo.pop()]:
                    if j > i and group[j] == j:
                        group[j] = i
                        todo.append(j)
    assert sorted(ids(after)) == [d for i, d in enumerate(doc_ids) if group[i] == i]


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    matcher = decontaminate.Matcher([tuple(r) for r in spark.read.parquet(f"{AT}/benchmark.parquet").collect()], 5, 0.5)
    assert sorted(ids(after)) == sorted(r.doc_id for r in before.collect() if not matcher.leaks(r.text))


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    assert set(ids(after)) <= set(ids(before)) and 0.8 < after.count() / before.count() < 1.2


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, AT)
    assert sorted(map(tuple, got.select("doc_id", "copy").collect())) == sorted(
        map(tuple, stages["mixing"][1].select("doc_id", "copy").collect()))
