import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wellspring.llm import simhash as S
from wellspring.llm._graph import components


def brute_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _signed(fp):
    return int(np.uint64(fp).view(np.int64))


def brute_groups(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def groups_of(spark, fps):
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {int(np.int64(r["fp"]).view(np.uint64)): r["root"] for r in S.near_groups(df).collect()}
    return [got[f] for f in fps]


def same_partition(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_whole_table_against_brute_force(spark, small_docs):
    rows = small_docs.collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    roots = brute_groups(fps)
    least = {}
    for r, g in zip(rows, roots, strict=True):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, roots, strict=True)}
    assert set(map(tuple, S.op7_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect())) == want


@pytest.mark.parametrize("seed", range(3))
def test_every_distance_up_to_three_links(spark, seed):
    rnd = random.Random(seed)
    fps = []
    for _ in range(60):
        f = rnd.getrandbits(64)
        fps.append(f)
        for d in (1, 2, 3, 4, 5):
            bits = rnd.sample(range(64), d) if rnd.random() < 0.5 else rnd.sample(range(16 * rnd.randrange(4), 64), d) \
                if rnd.random() < 0.2 else [16 * rnd.randrange(4) + b for b in rnd.sample(range(16), d)]
            fps.append(f ^ sum(1 << b for b in set(b % 64 for b in bits)))
    fps = sorted(set(fps))
    assert same_partition(groups_of(spark, fps), brute_groups(fps))


def test_chains_and_large_ball(spark):
    rnd = random.Random(5)
    chain = [0]
    for _ in range(40):
        chain.append(chain[-1] ^ sum(1 << b for b in rnd.sample(range(64), 3)))
    ball = [0xABCD0123456789 ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(7))) for _ in range(400)]
    fps = sorted(set(chain + ball))
    assert same_partition(groups_of(spark, fps), brute_groups(fps))


def test_bucket_lookup_equals_matrix():
    rnd = np.random.default_rng(3)
    for density in (40, 400):
        outs, flips = rnd.integers(0, 1 << 16, density) & 0x1F1F, rnd.integers(0, 49, density)
        codes = np.unique(outs * 64 + flips).astype(np.int64)
        fps = S._restore(np.full(len(codes), 12345, S.U64), codes)
        near = np.nonzero(np.triu(S._distance(fps[:, None], fps[None, :]) <= 3, 1))
        want = S._roots(len(codes), *near)
        left, right = S._lookup_pairs(codes)
        assert (S._distance(fps[left], fps[right]) <= 3).all()
        assert np.array_equal(S._roots(len(codes), left, right), want)


def test_edge_rows(spark, docs):
    df = docs([(5, None), (2, ""), (9, " \n\t "), (None, None), (1, "one two"), (3, "ONE two"), (3, "ONE two"),
               (7, "x" * 100_000), (8, "word " * 30_000)], extra=("fp", "Text", "component_id"))
    got = sorted(map(tuple, S.simhash_groups(df).collect()), key=str)
    comp = {}
    for i, _, c in got:
        comp.setdefault(i, set()).add(c)
    assert len(got) == 9 and comp[5] == comp[2] == comp[9] == comp[None] == {2}
    assert comp[1] == comp[3] == {1} and comp[7] == {7} and comp[8] == {8}
    kept = S.keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.collect()) == [1, 2, 7, 8]


def test_empty_table_and_null_ids(spark, docs):
    assert S.simhash_groups(docs([])).count() == 0 and S.keep_one_each(docs([])).count() == 0
    both = S.simhash_groups(docs([(None, "a b c"), (None, "a b c")])).collect()
    assert [r["component_id"] for r in both] == [None, None]
    assert S.keep_one_each(docs([(None, "a b c"), (None, "a b c")])).count() == 1


def test_components_rounds(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(path).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 501: 500}


def test_a_third_of_the_rows_in_one_fingerprint(shuffles, docs):
    """Copies are spread over tasks, with repeated ids too, and all are named."""
    n = 18_000
    df = docs([(i // 2 if i % 3 == 0 else i, "one two three" if i % 3 == 0 else f"w{i} x{i * i} y{i}") for i in range(n)])
    out = S.simhash_groups(df)
    rows = out.select("doc_id", "fp", "component_id", F.spark_partition_id().alias("p")).collect()
    per_task = Counter(r["p"] for r in rows)
    assert len(rows) == n and max(per_task.values()) <= 2 * n / 16
    named = {r["doc_id"]: r["component_id"] for r in rows if r["fp"] == _signed(brute_fingerprint("one two three"))}
    assert len(named) >= n // 3 - 1 and set(named.values()) == {0}
