import random
import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest

from wellspring.llm import token_files as T
from wellspring.operators.scans import fresh_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(T.default_tokenizer())
    t.encode_special_tokens = True
    return t


def brute(tokenizer, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_against_the_library(spark, small_docs, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    got = sorted(map(tuple, T.op9_token_files(spark, "/root/testdata/sf0.001").collect()))
    assert got == brute(tokenizer, rows)


def encoded(spark, df):
    path = fresh_path(df, "token_test", temporary=True)
    T.write_tokens(df, path)
    return path


SPACES = [" ", "  ", "\n", "\t", "\r\n", " ", " ", " ", "…", "　", "\x85", "\x1c", "\x1f", " ", " "]
PARTS = ["a", "word", "it's", "'ll", "1234", "é", "ü", "漢字", "😀", "<|endoftext|>", "...", "à", "À", "ª", "x́", "–", "%%%"]


def test_random_spaces_and_scripts(spark, docs, tokenizer):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(SPACES if rnd.random() < 0.5 else PARTS) for _ in range(rnd.randrange(60)))
             for _ in range(400)]
    rows = list(enumerate(texts))
    df = docs(rows)
    got = sorted(tuple(r) for r in T.read_tokens(spark, encoded(spark, df), ["doc_id", "n_tokens", "ids"]).collect())
    for i, n, ids in got:
        want = tokenizer.encode(texts[i], add_special_tokens=False).ids + [2]
        assert ids == want and n == len(want), texts[i]


def test_edge_rows_and_order(spark, docs, tokenizer):
    rows = [(9, "z"), (None, "none"), (3, None), (5, ""), (4, "word " * 50_000), (6, "y" * 20_000), (-1, "neg")]
    df = docs(rows, extra=("shard", "start", "Text", "ids"))
    got = sorted(map(tuple, T.read_tokens(spark, encoded(spark, df)).collect()), key=lambda r: r[1])
    assert [(r[0], r[1], r[2], zlib.crc32(np.array(r[3], "<u4").tobytes())) for r in got] == brute(tokenizer, rows)


def test_repeated_rows_and_empty_table(spark, docs):
    back = T.read_tokens(spark, encoded(spark, docs([(1, "a b"), (1, "a b"), (1, "c")]))).collect()
    assert sorted(r["start"] for r in back)[0] == 0 and sum(r["n_tokens"] for r in back) == max(
        r["start"] + r["n_tokens"] for r in back)
    assert T.read_tokens(spark, encoded(spark, docs([]))).count() == 0


def test_file_layout(spark, docs):
    import pyarrow.parquet as pq
    path = encoded(spark, docs([(i, f"word{i} and more") for i in range(500)]))
    files = ds.dataset(path.removeprefix("file:")).files
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    ids = next(c for p, c in by.items() if p.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings and by["doc_id"].has_offset_index and by["doc_id"].has_column_index
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings and "DELTA_BINARY_PACKED" in by["local_start"].encodings
