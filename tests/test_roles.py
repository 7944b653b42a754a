"""Role mapping helpers."""

from wellspring.plans import profile
from wellspring.sources import Tables
from wellspring.sources import roles as R


def test_counts_before_the_join_equal_counts_of_locations(spark, sf_small):
    t = Tables(spark, sf_small)
    for keys in (["town_name"], ["location_type"], ["province_name", "town_name"]):
        counted = profile.count_by(R.located_customers(t), keys, weight="sites")
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, profile.count_by(R.location(t), keys).collect()))


def test_added_files_show_in_the_next_query(spark, tmp_path):
    path = f"{tmp_path}/part.parquet"
    rows = spark.range(10).selectExpr("id p_partkey", "'n' p_name", "'b' p_brand", "'SMALL' p_type", "1 p_size",
                                      "1.0D p_retailprice")
    rows.write.parquet(path)
    assert R.water_source(Tables(spark, str(tmp_path))).count() == 10
    rows.write.mode("append").parquet(path)
    assert R.water_source(Tables(spark, str(tmp_path))).count() == 20


def test_water_quality_has_one_row_per_record(spark, sf_small):
    t = Tables(spark, sf_small)
    quality = R.water_quality(t)
    assert quality.groupBy("record_id").count().filter("count > 1").count() == 0
    assert R.visits(t).join(quality, "record_id").count() == R.visits(t).count()
