import random
import re
from collections import Counter

import numpy as np
import pytest

from wellspring.llm import repetition as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_longest(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            if i != j:
                k = 0
                while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
        out.append(best)
    return out


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(again), failed)


def brute_cover(words, least):
    longest = brute_longest(words)
    spans = {p for i, n in enumerate(longest) if n >= least for p in range(i, i + n)}
    return len(spans), max(longest, default=0)


@pytest.mark.parametrize("seed", range(6))
def test_longest_repeats_against_brute_force(seed):
    rnd = random.Random(seed)
    texts = [[rnd.randrange(rnd.choice([1, 2, 5, 40])) for _ in range(rnd.randrange(60))] for _ in range(30)]
    texts.append([1, 2, 3, 4] * 20)
    texts.append([7] * 65)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    words = np.array([w for t in texts for w in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert R.longest_repeats(words, row).tolist() == [n for t in texts for n in brute_longest(t)]


def test_whole_table_against_brute_force(spark, small_docs):
    got = {r["doc_id"]: r for r in R.op10_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    rows = small_docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert tuple(g)[1:7] == brute_base(r["text"])
        words = WORD.findall(r["text"])
        if len(words) <= 700:
            cover, longest = brute_cover(words, R.MIN_REPEAT)
            assert (g["covered_words"], g["longest_repeat"]) == (cover, longest)
            assert g["kept"] == (not g["base_failed"] and cover <= R.MAX_COVERED * len(words)
                                 and longest <= R.MAX_REPEAT)


def test_edge_rows(spark, docs):
    texts = [None, "", " \n\n ", "a\n\na\n a\nb\nb", "é|ü " * 80, "x" * 200_000, "w " * 60_000,
             "\n".join(["one two three four"] * 3), "a\nb\n", "same\r\nsame\r\n"]
    df = docs([(i, t) for i, t in enumerate(texts)] + [(None, "q"), (3, texts[3])], extra=("Text", "n_words", "kept"))
    got = R.repetition_rules(df).collect()
    assert len(got) == 12
    by = {r["doc_id"]: r for r in got}
    for i, t in enumerate(texts):
        assert tuple(by[i])[1:6] + (by[i]["base_failed"],) == brute_base(t), i
    assert by[6]["longest_repeat"] == 59_999 and not by[0]["kept"]


def test_long_repeat_is_rejected_and_clean_text_kept(spark, docs):
    clean = " ".join(f"w{i}" for i in range(300))
    part = " ".join(f"p{i}" for i in range(160))
    rest = " ".join(f"r{i}" for i in range(1000))
    got = {r["doc_id"]: r["kept"] for r in R.repetition_rules(
        docs([(1, clean), (2, f"{part} {rest} {part}"), (3, f"{clean} {clean}")])).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_empty_table(spark, docs):
    assert R.repetition_rules(docs([])).count() == 0
