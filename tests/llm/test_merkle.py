import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wellspring.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout=2):
    """The root over nodes, and each node's runs: (place in the run, the run) level by level."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % fanout:p - p % fanout + fanout]
            paths[i].append((p % fanout, run))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [p // fanout for p in at]
    return (level[0] if level else None), paths


def brute(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text)"""
    def first_null(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)
    leaves = [(r[2], r[0], h(*map(field, r)), r) for r in rows]
    langs = sorted({r[2] for r in rows}, key=first_null)
    trees = {}
    for lang in langs:
        own = sorted((x for x in leaves if x[0] == lang), key=lambda x: (first_null(x[1]), x[2]))
        trees[lang] = (own, *climb([x[2] for x in own], fanout))
    root, upper = climb([trees[lang][1] for lang in langs], fanout)
    out = []
    for lang, up in zip(langs, upper):
        own, subroot, paths = trees[lang]
        for (_, doc, leaf, r), path in zip(own, paths):
            whole = path + up
            proof = h(*[n for place, run in whole for k, n in enumerate(run) if k != place])
            node = leaf
            if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and r[3] is not None:
                node = h(*map(field, (r[0], r[1], r[2], r[3] + 1, r[4])))
            for place, run in whole:
                node = h(*[node if k == place else n for k, n in enumerate(run)])
            out.append((doc, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def run(spark, df, fanout=2, slots=16):
    docs = df.select("doc_id", "source", "lang", "n_chars", "text")
    more = F.col("n_chars") + 1
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select("doc_id", "lang", M.leaf(*[F.col(c) for c in docs.columns]).alias("leaf"), F.when(
        touched, M.leaf(*[more if c == "n_chars" else F.col(c) for c in docs.columns])).alias("tampered"))
    found = M.manifest(rows, "lang", ["doc_id"], ["tampered"], fanout, slots)
    out = found.withColumn("f", M.folded(F.coalesce("tampered", "leaf"), F.col("path"))).select(
        "doc_id", "leaf", "subroot", "root", M.proof(F.col("path")), "f", F.col("f") == F.col("root"))
    return sorted(map(tuple, out.collect()), key=str)


def test_whole_table(spark, small_docs):
    got = sorted(map(tuple, M.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()), key=str)
    want = brute(rows_of(small_docs))
    assert got == want and 0 < sum(not r[-1] for r in got) < len(got)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("counts", [(1,), (2,), (16,), (17,), (1, 1, 3), (16, 33, 1, 2), (257, 5), (31, 32, 48, 1, 9)])
def test_tree_shapes(spark, counts):
    langs = [None, "", "Z", "a", "é", "😀"]
    rows = [(i * 3 - 5, "s", langs[k], i, f"t{i}") for k, n in enumerate(counts) for i in range(n)]
    assert run(spark, spark.createDataFrame(rows, DOCS)) == brute(rows)


@pytest.mark.parametrize("fanout,slots", [(3, 9), (3, 16), (4, 4), (5, 2), (2, 2)])
def test_other_fanouts(spark, fanout, slots):
    rows = [(i, None, "ab"[i % 3 == 0], i, "x") for i in range(60)]
    assert run(spark, spark.createDataFrame(rows, DOCS), fanout, slots) == brute(rows, fanout)


def test_nulls_ties_long_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", None, None, "t"), (3, "-", "-", None, "1:a"), (3, "", "", 7, ""),
            (7, "s", "en", 2**63 - 1, "y"), (9, "s", "en", 1, "long " * 200_000), (9, "s", "en", 1, "other")]
    rows += [(11, "s", "en", 5, "same")] * 40
    assert run(spark, spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.col("n_chars").cast("decimal(38,0)"))) \
        == brute(rows)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], DOCS)) == []
    rows = [(i, "s", "en", i, "t") for i in range(20)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("leaf", "pos", "hash", "block", "_group", "root", "path"):
        df = df.withColumn(c, F.lit(1))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, M.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


def test_any_names_of_group_and_columns(spark):
    rows = spark.createDataFrame([(h(str(i)), i, i % 2, i) for i in range(9)],
                                 "leaf string, pos int, path int, hash int")
    got = M.manifest(rows, "path", ["pos"], ["hash"]).collect()
    assert got[0].__fields__ == ["path", "pos", "hash", "leaf", "subroot", "root", "path"]
    assert sorted(r[1] for r in got) == list(range(9)) and {(r[0], r["leaf"]) for r in got} == {
        (i % 2, h(str(i))) for i in range(9)}


def test_a_change_anywhere_shows(spark):
    rows = [(i, "s", "en", i, "t") for i in range(40)]
    roots = set()
    for change in (None, (5, 4, "u"), (5, 1, None), (5, 2, "fr")):
        new = [list(r) for r in rows]
        if change:
            new[change[0]][change[1]] = change[2]
        roots.add(run(spark, spark.createDataFrame([tuple(r) for r in new], DOCS))[0][3])
    assert len(roots) == 4


def test_plan_has_no_python_and_few_shuffles(spark, small_docs):
    rows = small_docs.select("doc_id", "lang", F.lit("x").alias("leaf"))
    plan = M.manifest(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
