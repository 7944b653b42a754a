"""W8/W9 access by place (FIXTURES.md: homonym_towns, empty_pivot_cell)."""

from pyspark.sql import functions as F

from wellspring.plans import access

VIEW = ("source_type string, town_name string, province_name string, location_type string, "
        "people_served int, time_in_queue int, results string")


def _view(spark):
    return spark.createDataFrame([
        ("river", "Harare", "Akatsi", "Rural", 100, 10, None),
        ("tap_in_home", "Harare", "Akatsi", "Urban", 300, 0, None),
        ("tap_in_home_broken", "Harare", "Kilimani", "Urban", 50, 0, None),
        ("well", "Harare", "Kilimani", "Rural", 150, 5, "Clean"),
        ("shared_tap", "Amina", "Kilimani", "Rural", 200, 40, None),
    ], VIEW)


def test_namesake_towns_stay_apart(spark):
    got = {(r.province_name, r.town_name): r for r in access.town_share(_view(spark)).collect()}
    assert set(got) == {("Akatsi", "Harare"), ("Kilimani", "Harare"), ("Kilimani", "Amina")}
    a = got[("Akatsi", "Harare")]
    assert (a.river, a.shared_tap, a.tap_in_home, a.tap_in_home_broken, a.well) == (25, 0, 75, 0, 0)
    k = got[("Kilimani", "Harare")]
    assert (k.tap_in_home_broken, k.well) == (25, 75)


def test_province_share_rounds_half_away_from_zero(spark):
    got = {r.province_name: r for r in access.province_share(_view(spark)).collect()}
    k = got["Kilimani"]  # 50/400 = 12.5 %, 150/400 = 37.5 %
    assert (k.tap_in_home_broken, k.well, k.shared_tap) == (13.0, 38.0, 50.0)


def test_share_is_one_aggregation(spark):
    from tests.util import plan_text
    plan = plan_text(access.town_share(_view(spark)))
    assert "Join" not in plan


def test_broken_ratio_null_without_home_taps(spark):
    ratio = access.broken_tap_ratio(access.source_share(_view(spark), ["province_name", "town_name"]))
    got = {(r.province_name, r.town_name): (r.Pct_broken_taps, r.pct_home) for r in ratio.collect()}
    assert got[("Akatsi", "Harare")] == (0.0, 100.0)
    assert got[("Kilimani", "Harare")] == (100.0, 0.0)
    assert got[("Kilimani", "Amina")] == (None, None)


def test_headline_shares(spark):
    r = access.headline_shares(_view(spark)).first()
    assert r.shared_tap_pct == 25.0          # 200 / 800
    assert r.home_tap_pct == 44.0            # 350 / 800 = 43.75
    assert r.broken_within_home_pct == 14.0  # 50 / 350 = 14.29
    assert r.well_pct == 19.0                # 150 / 800 = 18.75
    assert r.clean_within_wells_pct == 100.0


def test_combined_view_keeps_non_wells_and_first_visits(spark):
    visits = spark.createDataFrame([
        (1, 10, 100, 1, 5), (2, 10, 100, 2, 7),   # second visit dropped
        (3, 11, 200, 1, 0),                       # river: no pollution row
        (4, 12, 300, 1, 9),                       # well without a pollution row
        (5, 99, 100, 1, 1),                       # unknown location: dropped
    ], "record_id long, location_id long, source_id long, visit_count int, time_in_queue int")
    location = spark.createDataFrame([
        (10, "a", "P1", "T1", "Rural"), (11, "b", "P1", "T2", "Urban"), (12, "c", "P2", "T1", "Rural"),
    ], "location_id long, address string, province_name string, town_name string, location_type string")
    sources = spark.createDataFrame([(100, "well", 50), (200, "river", 70), (300, "well", 20)],
                                    "source_id long, type_of_water_source string, number_of_people_served int")
    pollution = spark.createDataFrame([(100, "x", "Contaminated: Chemical", 0.0)],
                                      "source_id long, description string, results string, biological double")
    view = access.combined_view(visits, pollution, location, sources)
    got = sorted((r.source_type, r.town_name, r.people_served, r.results) for r in view.collect())
    assert got == [("river", "T2", 70, None), ("well", "T1", 20, None),
                   ("well", "T1", 50, "Contaminated: Chemical")]
    assert view.filter(F.col("results").isNull()).count() == 2


def test_repeated_pollution_rows_are_reported(spark):
    pollution = spark.createDataFrame([(1, "a", "Clean", 0.0), (1, "b", "Clean", 0.0), (2, "c", "Clean", 0.0)],
                                      "source_id long, description string, results string, biological double")
    assert [(r.source_id, r.rows) for r in access.repeated_sources(pollution).collect()] == [(1, 2)]


def test_role_pollution_has_one_row_per_source(spark, sf_mid):
    from wellspring.sources import Tables
    from wellspring.sources import roles as R
    assert access.repeated_sources(R.well_pollution(Tables(spark, sf_mid))).count() == 0
