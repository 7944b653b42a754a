"""Longer randomized check of the custom operators against brute force.

Usage: python tools/fuzz.py [examples per property]   (default 40)
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wellspring.operators import not_in, row_number_within, skew_join  # noqa: E402
from wellspring.plans import profile  # noqa: E402
from wellspring.session import build_session  # noqa: E402

spark = build_session("local[4]", shuffle_partitions=4)
N = int(sys.argv[1]) if len(sys.argv) > 1 else 40
S = settings(max_examples=N, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 5))

def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)

@S
@given(st.lists(keys, max_size=15), st.lists(keys, max_size=8))
def f_not_in(l, r):
    L = spark.createDataFrame([(i, k) for i, k in enumerate(l)], "id long, k long")
    R = spark.createDataFrame([(k,) for k in r], "k long")
    L.createOrReplaceTempView("fl"); R.createOrReplaceTempView("fr")
    assert rows(not_in(L, R, "k"), ["id", "k"]) == rows(spark.sql("select id,k from fl where k not in (select k from fr)"), ["id", "k"])

@S
@given(st.lists(keys, min_size=1, max_size=50), st.lists(st.integers(0, 5), max_size=6),
       st.dictionaries(st.integers(0, 5), st.floats(0.01, 1.0), max_size=3), st.sampled_from(["inner", "left"]))
def f_skew(fk, dk, hot, how):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(fk)], "id long, k long")
    dim = spark.createDataFrame([(k, f"d{k}") for k in dk], "k long, name string")  # duplicates allowed
    assert rows(skew_join(fact, dim, "k", how, hot=hot), ["id", "k", "name"]) == rows(fact.join(dim, "k", how), ["id", "k", "name"])

@S
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=40),
       st.lists(st.integers(0, 45), max_size=8))
def f_pick(rs, picked):
    src = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rs)], "source_id long, type_of_water_source string, number_of_people_served int")
    w = Window.partitionBy("type_of_water_source").orderBy(F.desc("number_of_people_served"), F.asc("source_id"))
    want = src.withColumn("source_rank", F.row_number().over(w).cast("bigint")).filter(F.col("source_id").isin(picked))
    cols = ["source_id", "type_of_water_source", "number_of_people_served", "source_rank"]
    assert rows(profile.pick_ranked(src, picked), cols) == rows(want, cols)
    got = row_number_within(src, ["type_of_water_source"], [F.desc("number_of_people_served"), F.asc("source_id")], out="source_rank", num_partitions=3)
    want_all = src.withColumn("source_rank", F.row_number().over(w))
    assert rows(got, ["source_id", "source_rank"]) == rows(want_all, ["source_id", "source_rank"])

for f in (f_not_in, f_skew, f_pick):
    f(); print(f.__name__, "ok", flush=True)
