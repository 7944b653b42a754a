import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wellspring.llm import substring as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 8, 20, 35])
def test_covers(window):
    period, cover, width = S.cover_for(window)
    assert period + width - 1 == window and width >= 1
    for i in range(period):
        assert any((i + k) % period in cover and k % period in cover for k in range(period))


def test_whole_table_against_brute_force(spark, small_docs):
    rows = small_docs.collect()
    want = sorted((r["doc_id"], *b) for r, b in zip(rows, brute([r["text"] for r in rows], 35), strict=True))
    got = sorted(map(tuple, S.op1_substring_dedup(spark, "/root/testdata/sf0.001").collect()))
    assert got == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("window,seed", [(35, 1), (5, 2), (1, 3)])
def test_random_texts(spark, docs, window, seed):
    rnd = random.Random(seed)
    passages = [[rnd.choice("abcdefgh") + str(rnd.randrange(4)) for _ in range(rnd.randrange(1, 90))] for _ in range(6)]
    texts = []
    for _ in range(40):
        w = []
        for _ in range(rnd.randrange(5)):
            w += rnd.choice(passages) if rnd.random() < 0.5 else [f"u{rnd.randrange(10**6)}" for _ in range(30)]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(w))
    texts += [None, "", " ", "é " * 100, texts[0], "x" * 50_000, ("long" * 30 + " ") * 200]
    df = docs(list(enumerate(texts)), extra=("rid", "Text", "n_words", "h1"))
    got = sorted(map(tuple, S.substring_counts(df, window).collect()))
    assert got == [(i, *b) for i, b in enumerate(brute(texts, window))]


def test_removal_keeps_columns_and_rows(spark, docs):
    shared = " ".join(f"s{i}" for i in range(40))
    df = docs([(1, "a  b " + shared + " c"), (2, shared), (3, "x\ny"), (None, None), (3, "x\ny")], extra=("copies",))
    out = S.remove_substrings(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str) == sorted(
        [(1, "a b c", 5), (2, "", 0), (3, "x\ny", 3), (3, "x\ny", 3), (None, None, 0)], key=str)


def test_empty_table(spark, docs):
    assert S.substring_counts(docs([])).count() == 0
    assert S.remove_substrings(docs([])).count() == 0


def test_boundaries_do_not_cross_documents(spark, docs):
    w = [f"w{i}" for i in range(36)]
    df = docs([(1, " ".join(w)), (2, " ".join(w[:20])), (3, " ".join(w[20:])), (4, " ".join(["z", *w[1:]]))])
    got = {r["doc_id"]: r["n_removed"] for r in S.substring_counts(df).collect()}
    assert got == {1: 35, 2: 0, 3: 0, 4: 35}


def test_a_third_of_the_rows_in_one_text(shuffles, docs):
    """Its rows are spread over tasks, and every row gets its result."""
    n = 18_000
    shared = " ".join(f"s{i}" for i in range(40))
    df = docs([(i, shared if i % 3 == 0 else f"a{i} b{i}") for i in range(n)])
    out = S.substring_counts(df)
    rows = out.select("doc_id", "n_words", "n_removed", F.spark_partition_id().alias("p")).collect()
    assert max(Counter(r["p"] for r in rows).values()) <= 2 * n / 16
    assert {tuple(r)[:3] for r in rows} == {(i, 40, 40) if i % 3 == 0 else (i, 2, 0) for i in range(n)} and len(rows) == n


def test_equal_first_digests_stay_apart(spark, docs, monkeypatch):
    monkeypatch.setattr(S, "_digest", lambda text: (F.lit(1).cast("long"), F.xxhash64(text)))
    got = sorted(map(tuple, S.substring_counts(docs([(1, "a b"), (2, "a b c"), (3, "a b"), (4, None)]), 5).collect()))
    assert [r[:3] for r in got] == [(1, 2, 0), (2, 3, 0), (3, 2, 0), (4, 0, 0)]
