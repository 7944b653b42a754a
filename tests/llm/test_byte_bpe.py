import hashlib
import random

import pytest

from wellspring.llm import byte_bpe as B

SPACES = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x85", "\x1c", "\x1f", "\x0b"]
PARTS = ["a", "word", "it's", "'ll", "1234", "é", "ü", "漢字", "😀", "<|endoftext|>", "...", "à", "ª", "x́", "–",
         "%%%", "anana", "banana", "'S", "ı", "​", "٣", "Ⅷ"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(B.default_ranks()),
                             special_tokens={})


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))))
    return sorted(out)


def test_whole_table_against_tiktoken(spark, small_docs, library):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    assert sorted(map(tuple, B.op13_byte_bpe(spark, "/root/testdata/sf0.001").collect())) == brute(library, rows)


def test_random_scripts_ids_and_offsets(spark, docs, library):
    rnd = random.Random(13)
    texts = ["".join(rnd.choice(SPACES if rnd.random() < 0.5 else PARTS) for _ in range(rnd.randrange(60)))
             for _ in range(400)]
    got = B.encode(docs(list(enumerate(texts))), keep=["doc_id"], offsets=True).collect()
    m = B.model(B.default_ranks())
    for r in got:
        text = texts[r["doc_id"]]
        assert r["ids"] == library.encode_ordinary(text), text
        assert list(zip(r["starts"], r["ends"])) == m.tokenizer.encode(text, add_special_tokens=False).offsets, text


def test_table_covers_all_bytes():
    table = B.byte_table()
    assert len(set(table)) == 256 and table[0x41] == "A" and table[0x20] == "Ġ" and table[0x0A] == "Ċ"


def test_split_characters_and_unknown_ids(spark, library):
    ids = library.encode_ordinary("x😀y")
    cut = ids[:2]  # ends inside the character
    rows = [(1, ids), (2, cut), (3, []), (4, None), (5, [ids[0], None, 50_256, -7, ids[-1]])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in B.decode(df).collect()}
    assert got[1] == "x😀y" and got[2].startswith("x") and set(got[2][1:]) == {"�"}
    assert got[3] == got[4] == "" and got[5] == "xy"
    raw = {r["doc_id"]: bytes(r["decoded"]) for r in B.decode(df, binary=True).collect()}
    assert raw[2] == library.decode_bytes(cut)


def test_edge_rows(spark, docs, library):
    rows = [(9, "z"), (None, "none"), (3, None), (5, ""), (4, "word " * 50_000), (6, "y" * 20_000), (7, "漢" * 20_000),
            (1, "a b"), (1, "a b")]
    df = docs(rows, extra=("Text", "ids", "IDS", "_ws_row"))
    got = B.decode(B.encode(df), out="back").collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"Text", "IDS", "_ws_row", "text", "back"}
    for r in got:
        assert r["back"] == (r["text"] or "") and r["ids"] == library.encode_ordinary(r["text"] or "")
    assert B.encode(docs([])).count() == 0 and B.decode(B.encode(docs([]))).count() == 0


def test_columns_named_twice_stay(spark, docs):
    df = docs([(1, "a b")])
    twice = df.select("doc_id", "lang", "source", "text").toDF("doc_id", "c", "c", "text")
    row = B.encode(twice).collect()[0]
    assert row.__fields__ == ["doc_id", "c", "c", "text", "ids"] and (row[1], row[2]) == ("en", "s")


def test_cache_is_bounded():
    import numpy as np
    import pyarrow as pa

    from wellspring.llm._units import LONGEST_IDS, LONGEST_KEPT, UnitCache
    asked = []

    def encode(units):
        asked.extend(units)
        ids = [[len(u), *u] if u != b"many" else [7] * (LONGEST_IDS + 1) for u in units]
        return np.array([x for i in ids for x in i], np.int32), np.array([len(i) for i in ids], np.int64)
    cache = UnitCache(encode, most=100)
    rnd = random.Random(1)
    for k in range(60):
        units = {b"u%d" % rnd.randrange(30 * k, 30 * k + 60) for _ in range(rnd.choice([0, 5, 40, 150]))}
        units = list(units | {b"often", b"", b"many", b"l" * (LONGEST_KEPT + 1)})
        rnd.shuffle(units)
        flat, starts, lens = cache.ids(pa.array(units, pa.large_binary()))
        for u, a, n in zip(units, starts.tolist(), lens.tolist(), strict=True):
            assert flat[a:a + n].tolist() == encode([u])[0].tolist()
            asked.pop()
        assert max(cache.young.n, cache.old.n) <= 100
        assert len(cache.young.flat) == cache.young.length[:cache.young.n].sum() <= 100 * LONGEST_IDS
    assert asked.count(b"often") == 1 and asked.count(b"l" * (LONGEST_KEPT + 1)) == asked.count(b"many") == 60
