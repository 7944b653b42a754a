import itertools
import random
import re
import zlib

import numpy as np
import pytest

from wellspring.llm import toxicity as X


@pytest.fixture(scope="module")
def lm(spark):
    return X.language_model(X.letter_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def arrays(texts):
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8),
            np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def test_held_out_scores(spark):
    scored = X.op5_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").toPandas()
    assert sorted(scored["doc_id"]) == sorted(docs["doc_id"]) and scored["score"].between(0, 1).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in scored["doc_id"]]).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() >= 0.9


def test_disguised_words_are_restored(lm):
    for said, spelled, want in (("id1ot", False, "idiot"), ("$tupid", False, "stupid"), ("stuuuupid", False, "stupid"),
                                ("s t u p i d", True, "stupid"), ("m0r0n", False, "moron"), ("l.o.s.e.r", False, "loser"),
                                ("tr4$h", False, "trash")):
        assert X.restore_word(said, lm, spelled) == want


def brute(text, lm, spelled):
    """All readings, one by one."""
    lattice = X.edges(text, spelled)

    def readings(i):
        if i == len(text):
            yield 0.0, ""
            return
        for used, said, cost in lattice[i]:
            for loss, rest in readings(i + used):
                yield cost + loss, said + rest

    def spoken(said):
        state, total = (0, 0, 0), 0.0
        for c in said:
            s = X._symbol(c)
            if s or state[2]:
                total -= float(lm[state][s])
            state = (state[1], state[2], s) if s else (0, 0, 0)
        return total - (float(lm[state][0]) if state[2] else 0.0)
    return min(cost + spoken(said) for cost, said in readings(0))


def test_viterbi_equals_all_readings(lm):
    rnd = random.Random(3)
    for _ in range(60):
        text = "".join(rnd.choice("aabstue01$*.!é") for _ in range(rnd.randrange(1, 7)))
        spelled = rnd.random() < 0.3
        got = X.restore_word(text, lm, spelled)
        costs = [c for c, s in all_readings(text, spelled) if s == got]
        state_cost = min(costs) + loss(got, lm)
        assert abs(state_cost - brute(text, lm, spelled)) < 1e-4, text


def all_readings(text, spelled, i=0):
    if i == len(text):
        yield 0.0, ""
        return
    for used, said, cost in X.edges(text, spelled)[i]:
        for more, rest in all_readings(text, spelled, i + used):
            yield cost + more, said + rest


def loss(said, lm):
    state, total = (0, 0, 0), 0.0
    for c in [*said, None]:
        s = 0 if c is None else X._symbol(c)
        if s or state[2]:
            total -= float(lm[state][s])
        state = (state[1], state[2], s) if s else (0, 0, 0)
    return total


def test_letter_counts_against_brute_force(spark, docs):
    texts = ["Abc é1 b", None, "", "a\nba", "x" * 5]
    want = {}
    for t in texts:
        for w in re.findall(r"[a-z\x80-\U0010ffff]+", (t or "").lower()):
            codes = [0, 0, 0] + [27 if ord(c) >= 128 else ord(c) - 96 for c in w] + [0]
            for i in range(3, len(codes)):
                key = ((codes[i - 3] * 28 + codes[i - 2]) * 28 + codes[i - 1]) * 28 + codes[i]
                want[key] = want.get(key, 0) + 1
    got = X.letter_counts(docs(list(enumerate(texts))))
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == want


def test_language_model_is_a_distribution():
    lm = X.language_model(np.random.default_rng(0).integers(0, 3, 28**4).astype(float))
    assert np.allclose(np.exp(lm).sum(axis=-1), 1, atol=1e-4)


def test_detection(lm):
    texts = ["fine words, nothing odd.", "an id1ot here", "so s t u p i d now", "the$$$ ### 123 a b", "stuuupid", "1234 5-6"]
    data, offs = arrays(texts)
    out, at = X.restore_batch(data, offs, lm)
    got = [out[a:b].tobytes().decode() for a, b in itertools.pairwise(at)]
    assert got == [texts[0], "an idiot here", "so stupid now", texts[3], "stupid", texts[5]]


def test_edge_rows(spark, docs):
    df = docs([(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "y1 " * 30_000), (4, "z" * 50_000), (5, "!! ..."),
               (6, "B4D words")], extra=("score", "Text", "label", "restored"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 1, 1), (3, 0, 1), (3, 0, 1), (4, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = X.toxicity_scores(df, labels).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in X.toxicity_scores(df, labels.limit(0)).collect()} == {0.5}
    assert X.toxicity_scores(docs([]), labels).count() == 0
    back = {r["doc_id"]: r["restored"] for r in X.restore_texts(df).collect()}
    assert back[1] is None and back[2] == "" and back[5] == "!! ..."


def restored(texts, lm):
    out, at = X.restore_batch(*arrays(texts), lm)
    return [out[a:b].tobytes().decode() for a, b in itertools.pairwise(at)]


def test_every_word_with_readings_is_decoded(lm, monkeypatch):
    asked = set()
    monkeypatch.setattr(X, "_restored", lambda token, spelled, *_: asked.add((token.decode(), spelled)))
    words = ["sh1+", "idi0+", "hat3", "a55", "455", "(rap", "<rap", "i~d~i~o~t", "a.s.s", "s.c.um", "l-o-ser", "4",
             "stuuupid"]
    plain = ["fine", "words,", "end.", "-", "...", "#", "&%", "a", "aé", "x=y", "odd", "too"]
    restored([f"{w} fine" for w in words] + plain + ["s c u", "4 5 5", "x y", "s - c - u"], lm)
    assert asked == {(w, False) for w in words} | {("s c u", True), ("4 5 5", True), ("s - c - u", True)}


def test_disguises_at_the_end_and_short_ones(lm):
    assert restored(["an idi0t", "an idio+", "l-o-ser", "i~d~i~o~t.", "s t u", "GOOD. 5-6, 3.14 1 2 3"], lm) == [
        "an idiot", "an idiot", "loser", "idiot.", "stu", "GOOD. 5-6, 3.14 1 2 3"]


@pytest.mark.parametrize("text", ["z" * 300_000, "a1" * 60_000, "*" * 2_000, "idi0t" * 20_000, "1" * 30_000])
def test_a_long_word_takes_little_memory(lm, text):
    import tracemalloc
    tracemalloc.start()
    X.restore_word(text, lm)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def test_long_words_are_decoded_as_a_whole(lm):
    """Writing off settled beginnings changes nothing: against one pass that keeps every state."""
    def whole(text, spelled):
        best = [{} for _ in range(len(text) + 1)]
        best[0][0, 0, 0] = (0.0, "")
        for i, here in enumerate(X.edges(text, spelled)):
            for state, (cost, before) in best[i].items():
                for used, said, more in here:
                    now, total = state, cost + more
                    for c in said:
                        s = X._symbol(c)
                        if s or now[2]:
                            total -= float(lm[now][s])
                        now = (now[1], now[2], s) if s else (0, 0, 0)
                    old = best[i + used].get(now)
                    if old is None or total < old[0]:
                        best[i + used][now] = (total, before + said)
        last = best[-1]
        return last[min(last, key=lambda s: (last[s][0] - (float(lm[s][0]) if s[2] else 0.0), s))][1]

    rnd = random.Random(7)
    for k in range(12):
        text = "".join(rnd.choice("aabstue01$.!éz ") for _ in range(rnd.randrange(200, 900)))
        assert X.restore_word(text, lm, k % 3 == 0) == whole(text, k % 3 == 0)
    run = "ab" + "c" * 700 + "d1"
    assert X.restore_word(run, lm) == whole(run, False)


def test_held_out_recall_and_ranking(spark):
    scored = X.op5_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = scored[scored["held_out"]].merge(labels, on="doc_id")
    toxic, said = held["toxic"] == 1, held["predicted"] == 1
    assert (toxic & said).sum() / toxic.sum() >= 0.9 and (toxic & said).sum() / said.sum() >= 0.9
    rank = held["score"].rank()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc >= 0.98
