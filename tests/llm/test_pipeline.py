"""Each stage of the pipeline on its own input against a brute-force version."""

import importlib
import sys

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_mixing import WORD_COUNT, brute_mix
from tests.llm.test_simhash import brute_fingerprint, brute_groups
from tests.llm.test_substring import WORD, brute
from wellspring.llm import pieces, quality
from wellspring.llm._stage import store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        found.append(docs)
        docs = store(stage(spark, docs, SF), "pipeline_test")
    return [*found, docs]


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_keep_the_columns(outputs):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for df in outputs[:-1]:
        assert df.columns == outputs[0].columns
    assert outputs[-1].columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]


def test_quality_keeps_what_scores_high(spark, outputs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(outputs[0], labels).collect()}
    assert sorted(map(str, rows(outputs[1]))) == sorted(str(r) for r in rows(outputs[0]) if scores[r["doc_id"]])


def test_one_of_each_near_group_stays(outputs):
    before = sorted(rows(outputs[1]), key=lambda r: r["doc_id"])
    roots = brute_groups([brute_fingerprint(r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in rows(outputs[2])) == [r["doc_id"] for i, r in enumerate(before) if roots[i] == i]


def test_repeated_passages_are_cut(outputs):
    before = rows(outputs[2])
    after = {r["doc_id"]: r for r in rows(outputs[3])}
    for r, (n, gone, _) in zip(before, brute([r["text"] for r in before], 35), strict=True):
        new = after[r["doc_id"]]
        assert len(WORD.findall(new["text"])) == n - gone
        assert new["text"] == r["text"] if gone == 0 else new["n_chars"] == len(new["text"])


def test_mix_repeats_whole_documents_and_cuts_one(spark, outputs):
    before = rows(outputs[3])
    sized = [(r["doc_id"], r["source"], WORD_COUNT(r["text"])) for r in before]
    want = {i: taken for i, _, _, taken in brute_mix(spark, [s for s in sized if s[2]])[0]}
    got = {}
    for r in rows(outputs[4]):
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + WORD_COUNT(r["text"])
    assert got == {i: n for i, n in want.items() if n}


def test_tokens_decode_to_the_texts(spark, outputs):
    m = pieces.model(pieces.default_model())
    texts = sorted(r["text"] for r in rows(outputs[4]))
    back = []
    for r in rows(outputs[5]):
        data, _ = pieces.decode_batch(m, np.array(r["ids"], np.int64), np.array([0, len(r["ids"])]))
        back.append(data.tobytes().decode())
    assert sorted(back) == texts


def test_run_equals_the_stages(spark, outputs):
    assert sorted(map(str, rows(corpus_pipeline.run(spark, SF)))) == sorted(map(str, rows(outputs[5])))


@pytest.mark.parametrize("case", ["empty", "odd"])
def test_odd_documents(spark, docs, case):
    table = docs([] if case == "empty" else [(None, None), (1, ""), (1, ""), (2, "a b c"), (2, "a b c"), (None, "x " * 40),
                                             (3, "w" * 30_000), (4, "v " * 9_000)], extra=("ids", "size"))
    for _, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, table, SF), "pipeline_odd")
        table, before = out, table
    assert [c for c in before.columns if c not in ("text", "ids")] + ["n_tokens", "ids"] == table.columns


def test_entry_registers_the_queries():
    entry = importlib.import_module("__spark_entry__")
    names = list(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names) and "corpus_pipeline" in sys.modules
