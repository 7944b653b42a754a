import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from wellspring.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def feats(text, ngram=1, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, ngram=1, buckets=10_000, seed=2024, percent=10, least=20):
    """rows: (doc_id, text)"""
    docs = [(i, *feats(t, ngram, buckets)) for i, t in rows]
    s = Counter(b for _, _, f in docs for b in f)
    t = Counter(b for x in target for b in feats(x, ngram, buckets)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(ss + buckets) / (float(s[b] + 1) * float(tt + buckets))))
            for b in range(buckets)]
    out = []
    for i, n_words, f in docs:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        said = f"{seed}:{'null' if i is None else i}"
        u = (int(hashlib.sha256(said.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append((i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log(u)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    rank = Counter()
    ranks = {}
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks.setdefault(r, []).append(k)
    result = []
    for r in out:
        k = ranks.get(r, [])
        result.append((r[0], r[2], r[3], r[4], k[rank[r]] if rank[r] < len(k) else None))
        rank[r] += 1
    return sorted(result, key=str)


def rows_and_target(spark, sf):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    return docs, [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, I.op12_importance_resampling(spark, sf).collect()), key=str)
    assert got == brute(*rows_and_target(spark, sf)) and sum(r[-1] is not None for r in got) > 5


def test_sql_gives_the_same(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = con.execute(f"select doc_id, n_features, weight, score, rank from ({I.OP12_SQL})").fetchall()
    assert sorted(want, key=str) == sorted(map(tuple, I.op12_importance_resampling(spark, sf).collect()), key=str)


def test_scan_random_texts():
    rnd = random.Random(5)
    parts = ["a", "B", "word", "É", "é", "漢", "1", " ", "  ", "\n", "\t", "-", "'", "\x7f", "{", "@", "\x00", "😀", " "]
    for ngram in (1, 2, 3):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(200)]
        data = [t.encode() for t in texts]
        offs = np.cumsum([0, *map(len, data)])
        bucket, at, words = I.scan(b"".join(data), offs, ngram, 10_000)
        for k, t in enumerate(texts):
            n, want = feats(t, ngram)
            assert words[k] == n and bucket[at[k]:at[k + 1]].tolist() == want, t


@pytest.mark.parametrize("ngram,buckets,percent,least", [(2, 100, 50, 1), (3, 7, 100, 0), (1, 10_000, 0, 2)])
def test_other_parameters_nulls_and_ties(spark, docs, ngram, buckets, percent, least):
    rnd = random.Random(ngram)
    words = ["alpha", "beta", "Gamma", "delta", "ε", "42"]
    rows = [(i // 2, " ".join(rnd.choice(words) for _ in range(rnd.randrange(30)))) for i in range(80)]
    rows += [(None, None), (None, "beta beta"), (500, ""), (501, "- !"), (502, "long " * 100_000)] + [(7, "alpha ε")] * 9
    target = ["alpha beta", None, "", "ε 42 42"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = I.resample(docs(rows, extra=("Text", "buckets", "score", "TIE")), wanted, ngram=ngram, buckets=buckets,
                     percent=percent, least_words=least)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target, ngram, buckets, 2024, percent, least)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert I.resample(docs([]), none).collect() == []
    rows = [(i, "some words here") for i in range(30)]
    assert sorted(map(tuple, I.resample(docs(rows), none, least_words=1).collect()), key=str) == brute(rows, [], least=1)


def test_draw_follows_the_weights(spark, docs):
    rows = [(i, "target words only" if i % 2 else "other words here") for i in range(2000)]
    wanted = spark.createDataFrame([("target words only",)] * 200, "text string")
    got = I.resample(docs(rows), wanted, least_words=1).collect()
    drawn = [r["doc_id"] % 2 for r in got if r["rank"] is not None]
    assert len(drawn) == 200 and sum(drawn) > 120
