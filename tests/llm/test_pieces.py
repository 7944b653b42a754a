import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pytest
import sentencepiece

from wellspring.llm import pieces as P

HARD = ["", " ", "  ", "a", " lead", "tail ", "Hello  world\n\tx", "▁literal▁", "漢字 \U0001f600 café", "x" * 300,
        "ab" * 200 + " " * 70 + "end", "<s> </s> <unk> <0x41>", "();\r\n{\r", "a\xa0b ﬁ", "\x00\x01", "12 345.6", "é",
        "ก" * 100, "the the the the"]


@pytest.fixture(scope="module")
def m():
    return P.model(P.default_model())


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=P.default_model())


def run(m, texts, rate=0.0, seed=1, variants=4):
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, at = P.encode_batch(m, data, offs, np.arange(len(texts)).astype(np.uint64), rate, seed)
    out, back = P.decode_batch(m, ids, at)
    assert [out[a:b].tobytes().decode() for a, b in zip(back[:-1], back[1:], strict=True)] == texts
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_without_dropout_equals_the_library(m, sp, small_docs):
    texts = HARD + [r["text"] for r in small_docs.collect()]
    for t, ids in zip(texts, run(m, texts), strict=True):
        if P.MARK not in t:
            assert ids == sp.encode(t), t


def brute(m, text, key, rate):
    """One unit, by looking at all pairs anew in each step."""
    s = [(i, int(m.of_char[ord(c)])) for i, c in enumerate(text)]
    gone = set()
    while True:
        cand = []
        for (i, a), (j, b) in zip(s, s[1:], strict=False):
            piece = m.pairs.get((a, b))
            if piece is None or (i, a, b) in gone:
                continue
            if rate and P._skipped(np.array([key], np.uint64) ^ P._candidate(np.array([i]), np.array([a]), np.array([b])), rate)[0]:
                gone.add((i, a, b))
                continue
            cand.append((int(m.priority[piece]), i, j, piece))
        if not cand:
            return [x for _, x in s]
        _, i, j, piece = min(cand)
        s = [(p, piece if p == i else x) for p, x in s if p != j]


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_dropout_against_step_by_step(m, rate):
    rnd = random.Random(2)
    units = [" " + "".join(rnd.choice("theringation") for _ in range(rnd.randrange(1, 90))) for _ in range(80)]
    key = np.arange(80).astype(np.uint64) * np.uint64(7919)
    flat, lens = P.encode_units(m, [u.encode() for u in units], key, rate)
    got = np.split(flat, np.cumsum(lens)[:-1])
    for u, k, g in zip(units, key, got, strict=True):
        want = brute(m, u, int(k), rate)
        ids, _ = m.ids(np.array(want, np.int32), np.array([len(want)]))
        assert g.tolist() == ids.tolist()


def test_dropout_varies_is_seeded_and_lossless(m):
    texts = HARD + ["the information about international transportation " * 40]
    one, two, other = (run(m, texts, 0.3, s) for s in (1, 1, 2))
    assert one == two and one != other
    plain = run(m, texts)
    assert len(one[-1]) > len(plain[-1])
    assert len({tuple(run(m, ["transportation"] * 40, 0.3)[i]) for i in range(40)}) > 1


def test_whole_table_round_trip(spark, small_docs):
    rows = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    got = P.op3_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    again = P.op3_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert sorted(got) == sorted(again) and len(got) == len(rows)
    ids = {r["doc_id"]: r["ids"] for r in P.encode(small_docs).collect()}
    for r in got:
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()
        own = ids[r["doc_id"]]
        assert r["n_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())


def test_edge_rows(spark, docs):
    df = docs([(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "y " * 50_000), (4, "z" * 20_000)],
              extra=("ids", "Text", "decoded"))
    enc = P.encode(df)
    assert enc.columns == [c for c in df.columns if c != "ids"] + ["n_tokens", "ids"]
    back = P.decode(enc, keep=["doc_id", "text", "n_tokens"]).collect()
    assert len(back) == 6 and all((r["text"] or "") == r["decoded"] for r in back)
    assert {r["n_tokens"] for r in back if not r["text"]} == {0}
    assert P.encode(docs([])).count() == 0 and P.decode(P.encode(docs([]))).count() == 0


def test_every_occurrence_has_its_own_draws(m):
    texts = ["transportation " * 300, "of the in " * 200 + "ab" * 60]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.cumsum([0, *map(len, raw)])
    doc_key = np.array([5, 6], np.uint64)
    ids, at = P.encode_batch(m, data, offs, doc_key, 0.1, 1)
    units = [[b" " + w for w in t.split()] + ([b" "] if t.endswith(b" ") else []) for t in raw]
    keys = P.occurrence_keys(doc_key, np.cumsum([0, *map(len, units)]), 1)
    flat, lens = P.encode_units(m, sum(units, []), keys, 0.1)
    assert ids.tolist() == flat.tolist() and at[-1] == lens.sum()
    found = [tuple(x) for x in np.split(flat, np.cumsum(lens)[:-1])]
    assert len(set(found[:300])) > 4  # not bounded by a number of variants
    some = [x for x, u in zip(found, sum(units, []), strict=True) if u == b" the"]
    assert len(set(some)) > 1


def test_copies_are_drawn_apart(spark, docs):
    df = docs([(1, "the international transportation of information " * 5)] * 3)
    assert len({tuple(r["ids"]) for r in P.encode(df).collect()}) == 1
    assert len({tuple(r["ids"]) for r in P.encode(df, copies=True).collect()}) == 3
    assert sorted(P.encode(df, copies=True).collect()) == sorted(P.encode(df, copies=True).collect())


def test_digests_are_those_of_the_decoded_rows(spark, docs):
    enc = P.encode(docs([(i, t) for i, t in enumerate(HARD)] + [(-1, None), (None, "a b"), (None, "a b")]), keep=["doc_id"])
    want = [(r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()),
             hashlib.sha256(r["decoded"].encode()).hexdigest()) for r in P.decode(enc).collect()]
    got = P.decode(enc, keep=["doc_id"], digest=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) == len(HARD) + 3


def test_a_task_has_two_python_workers(spark):
    plan = P.op3_sentencepiece(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2


def peak(f, *args):
    tracemalloc.start()
    try:
        f(*args)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_decoding_holds_little(m):
    v = P.vocabulary(P.default_model())
    assert not hasattr(v, "pairs") and not hasattr(v, "of_char")
    assert all(np.array_equal(getattr(v, x), getattr(m, x)) for x in ("out", "out_start", "out_len"))
    ids = np.random.default_rng(3).choice(np.flatnonzero(v.out_len > 3), 500_000).astype(np.int32)
    offs = np.array([0, 100_000, 100_000, 500_000])
    want = b"".join(v.out[v.out_start[i]:v.out_start[i] + v.out_len[i]].tobytes() for i in ids[:100_000].tolist())
    data, at = P.decode_batch(v, ids, offs)
    assert data[at[0]:at[1]].tobytes() == want[1:] and at[1] == at[2]
    assert peak(P.decode_batch, v, ids, offs) < 16 * len(data)


def test_few_characters_without_a_piece_cost_little(m):
    own = [next(c for c in range(*r) if m.of_char[c] >= m.size) for r in
           ((1, 0x80), (0x80, 0x800), (0x800, 0xD800), (0x10000, 0x110000))]  # of one to four bytes
    symbols = np.full(500_000, m.of_char[ord("e")], np.int32)
    symbols[1000:1004] = m.of_char[own]
    lens = np.full(5_000, 100)
    ids, n = m.ids(symbols, lens)
    assert [m.out[m.out_start[i]] for i in ids[1000:1010]] == list("".join(map(chr, own)).encode())
    assert len(ids) == 500_006 and n.tolist() == [100] * 10 + [106] + [100] * 4_989
    assert (np.delete(ids, np.s_[1000:1010]) == symbols[0]).all()
    assert peak(m.ids, symbols, lens) < 40 * len(symbols)
