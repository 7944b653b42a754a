import math
import re
from collections import Counter, defaultdict

import pytest

from wellspring.llm import mixing as M


def WORD_COUNT(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: 3.0 * sizes[s] for s in capped}
        target.update({s: rest * weight[s] / sum(weight[f] for f in free) for s in free})
        over = {s for s in free if target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        capped |= over


def brute_mix(spark, rows):
    """Word by word, from the targets alone; rows of (doc_id, source, size)."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    target = brute_targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    df = spark.createDataFrame([(i, n) for i, _, n in rows], "doc_id long, size long")
    key = {(r[0], r[1]): r[2] for r in df.selectExpr("doc_id", "size", f"xxhash64({M.SEED}, coalesce(doc_id, 0L), size)").collect()}
    out = []
    for s in order:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (key[r[0], r[2]], r[0] is not None, r[0] or 0, r[2]))
        words, at = min(math.floor(target[s] + 0.5), 3 * sizes[s]), 0
        for i, _, n in own:
            taken = sum(max(0, min(words, e * sizes[s] + at + n) - (e * sizes[s] + at)) for e in range(3))
            out.append((i, n, sizes[s], taken))
            at += n
    return out, target


def compare(spark, got, rows):
    want, target = brute_mix(spark, rows)
    assert sorted(((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got), key=str) == sorted(want, key=str)
    by_size = {(i, n): s for i, s, n in rows}
    for r in got:
        assert math.isclose(r["target"], target[by_size[r["doc_id"], r["size"]]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] <= 3 * r["size"]


def test_whole_table_against_brute_force(spark, small_docs):
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))) for r in small_docs.collect()]
    got = M.op2_mix_sources(spark, "/root/testdata/sf0.001").collect()
    compare(spark, got, rows)
    assert sorted(got) == sorted(M.op2_mix_sources(spark, "/root/testdata/sf0.001").collect())


def test_taken_is_near_the_target(spark):
    got = M.op2_mix_sources(spark, "/root/testdata/sf0.01").toPandas()
    by = got.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by["taken"] - by["target"]).abs() <= 0.5).all()
    assert math.isclose(by["target"].sum(), by.index.to_series().sum(), rel_tol=1e-9)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3}, {"a": 5, None: 7, "é": 100, "z": 2}, {"a": 0, "b": 0},
                                   {"x": 0, "y": 50}, {"s": 9}, {f"t{i}": 4 for i in range(9)},
                                   {"big": 999, **{f"t{i}": 4 for i in range(9)}}])
def test_targets_against_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes)


def words(n, w="w"):
    return " ".join([w] * n)


def test_edge_rows(spark, docs):
    rows = [(1, None, "a"), (2, "", None), (None, words(70), "b"), (4, words(5000), "a"), (5, words(3), None),
            (6, words(40), "b"), (6, words(40), "b"), (6, words(41), "b"), (None, words(70), "b"), (7, words(9), "c")]
    df = docs(rows, extra=("size", "taken", "Text"))
    got = M.mix_counts(df).collect()
    compare(spark, got, [(i, s, len((t or "").split())) for i, t, s in rows])
    mixed = M.mixed_documents(df)
    assert mixed.columns == df.columns
    per = Counter()
    for r in mixed.collect():
        per[r["source"]] += len(r["text"].split())
    want = Counter()
    for r, (s) in [(r, r) for r in got]:
        want[r["source_size"]] += r["taken"]
    assert sum(per.values()) == sum(want.values())


def test_empty_tables(spark, docs):
    assert M.mix_counts(docs([])).count() == 0 and M.mixed_documents(docs([])).count() == 0
    assert [r["taken"] for r in M.mix_counts(docs([(1, None), (2, " ")])).collect()] == [0, 0]


@pytest.mark.parametrize("sizes", [[300_000] + [10] * 300, [4] * 2_000, [1, 2, 3] * 5, [33], [1]])
def test_small_sources_reach_their_targets(spark, sizes):
    rows = [(k * 10 + j, f"s{k:05}", n // 2 + n % 2 if j else n // 2) for k, n in enumerate(sizes) for j in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = M.mix(df).groupBy("source").agg({"taken": "sum", "target": "first", "source_size": "first"}).collect()
    target = brute_targets({f"s{k:05}": n for k, n in enumerate(sizes)})
    assert len(got) == len(sizes)
    for r in got:
        assert abs(r["sum(taken)"] - target[r["source"]]) <= 0.5 and r["sum(taken)"] <= 3 * r["first(source_size)"]


@pytest.mark.parametrize("quotas", [[1], [2], [5, 0, 1], [9000, 1, 3000, 12], [1] * 40, [20_000]])
def test_schedule_is_a_spread_permutation(spark, quotas):
    total, rows, lo = sum(quotas), [], 0
    for i, q in enumerate(quotas):
        rows.append((i, lo, lo + q))
        lo += q
    got = M.schedule(spark.createDataFrame(rows, "source_id int, lo long, hi long"), total).collect()
    step, source_of = M.golden_step(total), [i for i, q in enumerate(quotas) for _ in range(q)]
    assert sorted(r["slot"] for r in got) == list(range(total)) and math.gcd(step, total) == 1
    by_slot = {r["slot"]: r for r in got}
    seen = Counter()
    for i in range(total):  # the definition: slot i has the point i * step mod total
        r = by_slot[i]
        assert r["source_id"] == source_of[i * step % total] and r["block"] == seen[r["source_id"]]
        seen[r["source_id"]] += 1
        # after any number of slots each source has its share to within a few blocks
        assert abs(seen[r["source_id"]] - (i + 1) * quotas[r["source_id"]] / total) < 6


def test_large_products(spark):
    n = (1 << 41) - 21
    x = [0, 1, n - 1, n // 3, 123456789012]
    df = spark.createDataFrame([(v,) for v in x], "x long")
    for g in (1, 7, n - 1, n // 2 + 5):
        assert [r[0] for r in df.select(M._times(df["x"], g, n)).collect()] == [v * g % n for v in x]
    with pytest.raises(ValueError):
        M.golden_step((1 << 41) + 1)
