"""JSON arrays and two-line records, cut at every place."""
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from vitrine.sources import files as SRC
from vitrine.sources import ranges as RG

HOSTILE = [{"a": "x,y", "b": "[{"}, {"a": "q\"uote\\", "b": "\\\\\""}, {"a": "]}", "n": [1, [2, {"z": "]"}], 3]}, {}, {"a": None},
           {"a": "é\U0001f642 ", "b": "tab\tnew\nline"}, {"a": "\\\\\\\\", "b": "\\"}, {"deep": {"deep": {"deep": ["}", "\"]"]}}}]


def elements(spark, path, step=None):
    return [r.element for r in RG.json_elements(spark, path, step).orderBy("path", "offset").collect()]


def scan_all(data, step):
    """The range logic alone, on bytes, as a task does it."""
    found, scan = [], None
    cuts = [0] + [c for c in range(step, len(data), step)] + [len(data)]
    cuts = [c if c in (0, len(data)) else next((i for i in range(c, len(data)) if data[i - 1:i] != b"\\"), len(data)) for c in cuts]
    inside, depth, marks = 0, 0, []
    for a, b in zip(cuts, cuts[1:]):
        own = RG.Scan(inside, depth)
        places, closes = own.feed(data[a:b])
        marks += [(a + p, c) for p, c in zip(places.tolist(), closes.tolist())]
        effect = RG.Scan()
        effect.feed(data[a:b])
        depth += effect.inner if inside else effect.outer
        inside ^= effect.quotes % 2
        assert (own.depth, (own.quotes + own.inside) % 2) == (depth, inside)
    del scan
    for (p, c), (q, _) in zip(marks, marks[1:]):
        if not c and data[p + 1:q].strip():
            found.append(json.loads(data[p + 1:q]))
    return found


@pytest.mark.parametrize("indent", [None, 1])
def test_every_cut_of_hostile_arrays(indent):
    rng = random.Random(1)
    for _ in range(12):
        rows = [rng.choice(HOSTILE) for _ in range(rng.randint(0, 5))]
        data = json.dumps(rows, ensure_ascii=rng.random() < 0.5, indent=indent).encode()
        for step in range(1, len(data) + 1):
            assert scan_all(data, step) == rows


def test_chunks_may_end_anywhere():
    data = json.dumps(HOSTILE * 3).encode()
    whole = RG.Scan().feed(data)[0].tolist()
    for size in (1, 2, 3, 7, 50):
        scan, got = RG.Scan(), []
        for at in range(0, len(data), size):
            got += [at + p for p in scan.feed(data[at:at + size])[0].tolist()]
        assert got == whole


def test_files_in_ranges(spark, tmp_dir, monkeypatch):
    """The same elements whatever the ranges, several tasks to a file, and files of other shapes."""
    rows = [dict(rng_row, i=i) for i, rng_row in enumerate(HOSTILE * 12)]
    for name, text in (("big.json", json.dumps(rows)), ("indented.json", json.dumps(rows[:9], indent=2)), ("empty.json", "[ ]"),
                       ("blank.json", " \n "), ("one.json", json.dumps({"a": "alone", "i": -1})), ("nothing.json", "")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    monkeypatch.setattr(RG, "CHUNK_BYTES", 64)
    whole = [json.loads(e) for e in elements(spark, tmp_dir)]
    assert sorted(map(str, whole)) == sorted(map(str, [*rows, *rows[:9], {"a": "alone", "i": -1}]))
    for step in (97, 1000):
        assert [json.loads(e) for e in elements(spark, tmp_dir, step)] == whole
    tasks = RG.json_elements(spark, os.path.join(tmp_dir, "big.json"), 500).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 3 and sum(t["count"] for t in tasks) == len(rows)


def test_array_reader_equals_spark_s(spark, tmp_dir, monkeypatch):
    """Rows, folders as columns and file names as Spark's own multi-line reader has them."""
    for label in ("Mini", "Long"):
        os.makedirs(os.path.join(tmp_dir, f"label={label}"))
        with open(os.path.join(tmp_dir, f"label={label}", "x y.json"), "w") as f:
            json.dump([{"productId": i, "imageUrl": f"u,{i}\"]", "dressLengthValue": None if i % 3 else label, "other": [i]} for i in range(200)], f)
    monkeypatch.setattr(RG, "RANGE_BYTES", 700)
    got = SRC.read_json_arrays(spark, tmp_dir, other_keys=False)
    want = spark.read.option("multiLine", True).schema(SRC.MANIFEST_SCHEMA).json(tmp_dir).withColumn("source_file", F.col("_metadata.file_path"))
    assert sorted(got.columns) == sorted(want.columns) and got.count() == 400
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.rdd.getNumPartitions() > 2


def records(rng, n):
    """Pairs, lone ids and uids, other lines, long lines."""
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.7:
            out.append(f'  target_class: {rng.randint(0, 30)}\n' + rng.choice(["", "  other: 1\n", "x" * 300 + "\n"])
                       + (f'  target_class_string: "n{rng.randint(0, 99)}é"\n' if rng.random() < 0.8 else ""))
        else:
            out.append(rng.choice(['entry {\n', '}\n', '  target_class_string: "alone"\n', '\n', ' target_class: 5\n', 'x  target_class: 6\n']))
    return "".join(out)


def slow_pairs(text):
    """The two kinds of lines in order; an id holds the uid that is the next of them."""
    found = re.findall(r'(?m)^  target_class(?:: (\d+)|_string: "([^"\n]*)")', text)
    kinds = [("id", int(i)) if i else ("uid", u) for i, u in found]
    return [(a[1], b[1]) for a, b in zip(kinds, kinds[1:]) if a[0] == "id" and b[0] == "uid"]


def test_two_line_records_in_ranges(spark, tmp_dir, monkeypatch):
    rng = random.Random(2)
    text = records(rng, 120)
    path = os.path.join(tmp_dir, "map.pbtxt")
    with open(path, "w") as f:
        f.write(text)
    want = slow_pairs(text)
    assert len(want) > 40
    monkeypatch.setattr(RG, "CHUNK_BYTES", 50)
    for step in (61, 400, 1 << 20):
        rows = RG.class_pairs(spark, path, step).orderBy("offset").collect()
        assert [(r.class_id, r.uid) for r in rows] == want
    last = {i: u for i, u in want}
    assert {r.class_id: r.uid for r in SRC.read_class_uids(spark, path).collect()} == last


def test_every_cut_of_a_record(spark, tmp_dir):
    path = os.path.join(tmp_dir, "small.pbtxt")
    text = 'entry {\n  target_class: 1\n  target_class_string: "n1"\n}\n  target_class: 22\n  x\n  target_class_string: "n22"'
    with open(path, "w") as f:
        f.write(text)
    for step in range(1, len(text) + 1, 5):
        assert sorted((r.class_id, r.uid) for r in RG.class_pairs(spark, path, step).collect()) == [(1, "n1"), (22, "n22")]
