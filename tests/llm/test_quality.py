import random
import re
import zlib

import numpy as np
import pytest

from wellspring.llm import _ftrl
from wellspring.llm import quality as Q


@pytest.fixture(scope="module")
def scored(spark):
    return Q.op8_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").toPandas()
    assert sorted(scored["doc_id"]) == sorted(docs["doc_id"])
    assert scored["score"].between(0, 1).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    both = scored.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.95


def test_held_out_labels_are_not_used(spark, small_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(_ftrl.held_out(5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.quality_scores(small_docs, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def brute_features(text):
    out = {}
    parts = [p for p in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0d]+",
                                   "".join(c.lower() if c.isascii() else c for c in text))]
    for i, p in enumerate(parts):
        out[p] = out.get(p, 0) + 1
        if i:
            key = "again" if parts[i - 1] == p else (parts[i - 1], p)
            out[key] = out.get(key, 0) + 1
    total = sum(out.values())
    return sorted(np.sqrt(n / total) for n in out.values())


def test_features_against_brute_force():
    rnd = random.Random(1)
    texts = ["", "a", "End%%% end%% é| é|", "x x x x", " ".join(rnd.choice(["ab", "C&&", "d1", "|", "ü"]) for _ in range(99))]
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    at, x, rows = Q.features(np.frombuffer(b"".join(raw), np.uint8), offs)
    for i, t in enumerate(texts):
        assert np.allclose(sorted(x[rows[i]:rows[i + 1]]), brute_features(t))
        assert (at[rows[i]:rows[i + 1]] > 0).all()


def test_ftrl_learns_and_calibrates():
    rng = np.random.default_rng(0)
    model = _ftrl.Ftrl(0.5, 1.0, 0.01, 0.1)
    rows = [(np.unique(rng.integers(1, 50, 5)), y) for y in rng.integers(0, 2, 600)]
    for at, y in rows:
        at = np.append(at, 60 + y)
        model.learn(at, np.ones(len(at)), float(y))
    assert model.weights(np.array([61]))[0] > 0.5 > -0.5 > model.weights(np.array([60]))[0]
    margin = rng.normal(size=20_000)
    label = (rng.random(20_000) < _ftrl.sigmoid(3 * margin - 1)).astype(int)
    scale, bias = _ftrl.calibrated(margin, label)
    assert abs(scale - 3) < 0.15 and abs(bias + 1) < 0.1
    assert _ftrl.calibrated(np.zeros(0), np.zeros(0)) == (1.0, 0.0)
    assert np.isfinite(_ftrl.calibrated(np.ones(5), np.ones(5))).all()


def test_edge_rows(spark, docs):
    df = docs([(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "y " * 50_000), (4, "good words here")],
              extra=("score", "Text", "label", "turn"))
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (3, 0, 0), (3, 1, 0), (4, 1, None), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = Q.quality_scores(df, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    none = Q.quality_scores(df, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    kept = Q.keep_good(df, labels.limit(0))
    assert kept.columns == df.columns and kept.count() == 6
    assert Q.quality_scores(docs([]), labels).count() == 0 and Q.keep_good(docs([]), labels).columns == docs([]).columns


def test_sample_is_bounded(spark):
    labels = spark.range(500).selectExpr("id doc_id", "1 quality")
    from pyspark.sql import functions as F
    assert _ftrl.sample_labels(labels, "quality", F.lit(True), 100).count() == 100


def test_training_rows_are_bounded(spark, docs):
    rows = [(1, f"text {i % 700}") for i in range(2000)] + [(i, f"other {i}") for i in range(2, 60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)], "doc_id long, quality int, toxic int")
    sample = _ftrl.sample_labels(labels, "quality", ~_ftrl.held_out(5, 0), 30)
    for most in (10, 500, 100_000):
        got = _ftrl.labelled(docs(rows).select("doc_id", "text"), sample, most).collect()
        found = {(bytes(r["text"]).decode(), r["label"]) for r in got}
        assert len(got) == len(found) <= most  # rows that agree count once
        again = _ftrl.labelled(docs(rows[::-1]).select("doc_id", "text"), sample, most).collect()
        assert found == {(bytes(r["text"]).decode(), r["label"]) for r in again}
    sampled = {r["doc_id"] for r in sample.collect()}
    assert found == {(t, i % 2) for i, t in rows if i in sampled}
    assert _ftrl.labelled(docs([]).select("doc_id", "text"), sample, 5).count() == 0


def test_training_against_brute_force(spark):
    """Coordinate by coordinate, one row at a time, with plain floats; then the mean over shards and the calibration."""
    rnd = random.Random(3)
    rows = []
    for turn in range(60):
        at = sorted(rnd.sample(range(1, 40), rnd.randrange(1, 8)))
        rows.append((turn * 7919 - 200_000, int(sum(at) % 3 == 0), at, [rnd.random() + 0.1 for _ in at]))
    df = spark.createDataFrame(rows, "turn long, label int, at array<int>, x array<double>").selectExpr(
        "turn", "label", "at", "cast(x as array<float>) as x")
    settings = {"alpha": 0.5, "beta": 1.0, "l1": 0.05, "l2": 0.1}
    got = _ftrl.train(df, 2, 3, **settings)
    shard = {r[0]: r[1] for r in df.selectExpr("turn", "pmod(hash(turn), 3)").collect()}
    kept = [r for r in df.collect()]
    weights = []
    for k in range(3):
        z, n = {}, {}

        def weight(i, z=z, n=n):
            l1 = 0.0 if i == 0 else settings["l1"]
            if abs(z.get(i, 0.0)) <= l1:
                return 0.0
            sign = 1 if z[i] > 0 else -1
            return (sign * l1 - z[i]) / ((settings["beta"] + n[i] ** 0.5) / settings["alpha"] + settings["l2"])
        for _ in range(2):
            for r in sorted((r for r in kept if shard[r["turn"]] == k), key=lambda r: (r["turn"], r["label"])):
                pairs = [*zip(r["at"], r["x"]), (0, 1.0)]
                now = {i: weight(i) for i, _ in pairs}
                p = 1 / (1 + np.exp(-sum(now[i] * x for i, x in pairs)))
                for i, x in pairs:
                    g = (p - r["label"]) * x
                    sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / settings["alpha"]
                    z[i] = z.get(i, 0.0) + g - sigma * now[i]
                    n[i] = n.get(i, 0.0) + g * g
        weights.append({i: weight(i) for i in n if n[i] > 0})
    want = np.zeros(_ftrl.DIM)
    for i in set().union(*weights):
        seen = [w[i] for w in weights if i in w]
        want[i] = sum(seen) / len(seen)
    margin = np.array([sum(want[i] * x for i, x in zip(r["at"], r["x"])) for r in kept])
    scale, bias = _ftrl.calibrated(margin, np.array([r["label"] for r in kept]))
    want *= scale
    want[0] = bias
    assert np.allclose(got, want, atol=1e-4) and np.count_nonzero(want) > 20
