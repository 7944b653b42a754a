import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *([1] * len(extra))) for r in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", {c} int" for c in extra))
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def shuffles(spark):
    """Plain shuffled joins over 16 tasks: no broadcast, no adaptive split of hot keys."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
