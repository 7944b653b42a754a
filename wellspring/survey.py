"""One object for a survey database: its tables, and every job as a method.

    survey = Survey.from_parquet(spark, "/data/survey")         # survey tables
    survey = Survey.from_csv(spark, "/dumps/survey")            # CSV dumps, declared types
    survey = Survey.from_test_tables(spark, "/data/tpch-like")  # role mapping
    survey.town_share().show()
    survey.publish_work_orders(run_date="2024-06-30")

Each method returns a lazy DataFrame (only the writing jobs act at once).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wellspring.operators import preview
from wellspring.plans import access, audit, clean, profile, queues, workorders
from wellspring.sources import Tables
from wellspring.sources import roles as R
from wellspring.sources.schemas import SURVEY_SCHEMAS

TABLES = ["location", "visits", "water_source", "well_pollution", "employee", "auditor_report",
          "queue_log", "water_quality"]
OPTIONAL = ("queue_log", "water_quality")


# Declared columns that no job uses, so stored tables may lack them.
UNUSED = {"email", "phone_number", "description"}


def _declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` if it has the declared columns of the table (Parquet files bring their own types)."""
    schema = SURVEY_SCHEMAS.get(name)
    missing = {f.name for f in schema or []} - set(df.columns) - UNUSED
    if missing:
        raise ValueError(f"{name} lacks the columns {sorted(missing)}")
    return df


@dataclass
class Survey:
    location: DataFrame
    visits: DataFrame
    water_source: DataFrame
    well_pollution: DataFrame
    employee: DataFrame
    auditor_report: DataFrame
    queue_log: DataFrame | None = None
    water_quality: DataFrame | None = None

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Survey:
        """Survey tables stored as ``<root>/<table>`` Parquet folders
        (``water_quality`` and ``queue_log`` optional)."""
        root = root.rstrip("/")
        frames = {name: _declared(spark.read.parquet(f"{root}/{name}"), name) for name in TABLES if name not in OPTIONAL}
        for optional in OPTIONAL:
            try:
                frames[optional] = _declared(spark.read.parquet(f"{root}/{optional}"), optional)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":  # there, but unreadable
                    raise
                frames[optional] = None
        return cls(**frames)

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str) -> Survey:
        """The survey's seven tables dumped as CSV with a header,
        ``<root>/<table>.csv`` (a file or a folder of parts), read with the
        declared schemas; a malformed row fails the read. The quality score
        comes from ``water_quality``, and the queue analyses use the visits'
        own times, as in the survey."""
        root = root.rstrip("/")
        reader = spark.read.option("header", True).option("mode", "FAILFAST")
        return cls(**{name: reader.schema(schema).csv(f"{root}/{name}.csv")
                      for name, schema in SURVEY_SCHEMAS.items()})

    @classmethod
    def from_test_tables(cls, spark: SparkSession, root: str) -> Survey:
        """The survey roles derived from the TPC-H-like test tables."""
        t = Tables(spark, root)
        return cls(**{name: getattr(R, name)(t) for name in TABLES})

    def register_views(self) -> list[str]:
        """Expose the tables and the survey's two views (combined_analysis_table,
        Incorrect_records) to ``spark.sql``; returns the registered names."""
        from wellspring.plans.views import register_survey_views
        tables = {name: df for name, df in vars(self).items() if df is not None}
        return register_survey_views(self.visits.sparkSession, tables)

    def preview(self, table: str, n: int = 5, order_by: list | None = None) -> DataFrame:
        """``SELECT * FROM table LIMIT n`` (repeatable with ``order_by``)."""
        return preview(getattr(self, table), n, order_by)

    # W1, W2
    def contradictions(self) -> DataFrame:
        return clean.contradictions(self.well_pollution)

    def mislabelled(self) -> DataFrame:
        return clean.mislabelled(self.well_pollution)

    def corrected_pollution(self) -> DataFrame:
        return clean.correct(self.well_pollution)

    def cleaning_check(self) -> DataFrame:
        return clean.verification(self.well_pollution)

    def employees_with_email(self) -> DataFrame:
        return clean.with_email(self.employee)

    # W3, W4
    def people_by_type(self) -> DataFrame:
        return profile.people_by_type(self.water_source)

    def people_share_by_type(self) -> DataFrame:
        return profile.people_share_by_type(self.water_source)

    def type_ranks(self) -> DataFrame:
        return profile.rank_types_by_people(self.water_source)

    def location_type_share(self) -> DataFrame:
        return profile.share_of_summed_counts(self.location, "location_type")

    def source_ranks(self) -> DataFrame:
        return profile.ranked_sources(self.water_source)

    def ranks_of(self, source_ids) -> DataFrame:
        return profile.pick_ranked(self.water_source, source_ids)

    def top_sources(self, n: int = 10) -> DataFrame:
        return profile.top_sources_per_type(self.water_source, n)

    # W5
    def _log(self) -> DataFrame:
        return self.queue_log if self.queue_log is not None else self.visits

    def survey_span(self) -> DataFrame:
        return queues.survey_span(self._log())

    def mean_queue(self) -> DataFrame:
        return queues.mean_queue_nullif(self._log())

    def queue_by_weekday(self) -> DataFrame:
        return queues.queue_by_weekday(self._log())

    def queue_by_hour(self) -> DataFrame:
        return queues.queue_by_hour_label(self._log())

    def queue_heatmap(self) -> DataFrame:
        return queues.queue_heatmap(self._log())

    # W6, W7
    def audit_pairs(self) -> DataFrame:
        return audit.audit_pairs(self.auditor_report, self.visits, self.water_quality)

    def audit_accuracy(self) -> DataFrame:
        return audit.accuracy(self.audit_pairs())

    def incorrect_records(self) -> DataFrame:
        return audit.incorrect_records(self.auditor_report, self.visits, self.employee, self.water_quality)

    def mistakes_per_employee(self) -> DataFrame:
        return audit.mistakes_per_employee(self.auditor_report, self.visits, self.employee,
                                           self.water_quality)

    def suspects(self) -> DataFrame:
        return audit.suspects(self.mistakes_per_employee())

    def suspect_evidence(self, keyword: str = audit.KEYWORD, suspected: bool = True) -> DataFrame:
        return audit.suspect_evidence(self.auditor_report, self.visits, self.employee, keyword,
                                      self.water_quality, suspected)

    # W8, W9
    def combined_view(self, cleaned: bool = False) -> DataFrame:
        return access.combined_view(self.visits, self.well_pollution, self.location, self.water_source,
                                    cleaned)

    def province_share(self, cleaned: bool = False) -> DataFrame:
        return access.province_share(self.combined_view(cleaned))

    def town_share(self, cleaned: bool = False) -> DataFrame:
        return access.town_share(self.combined_view(cleaned))

    def broken_tap_ratio(self) -> DataFrame:
        return access.broken_tap_ratio(access.town_access_table(self.combined_view()))

    def headline_shares(self, cleaned: bool = False) -> DataFrame:
        return access.headline_shares(self.combined_view(cleaned))

    # W10, W11
    def work_orders(self, run_date: str | None = None, cleaned: bool = False) -> DataFrame:
        return workorders.work_orders(self.water_source, self.well_pollution, self.visits, self.location,
                                      run_date=run_date, cleaned=cleaned)

    def work_order_violations(self, run_date: str | None = None) -> DataFrame:
        return workorders.violations(self.work_orders(run_date), self.water_source)

    def publish_work_orders(self, run_date: str | None = None, cleaned: bool = False,
                            path: str | None = None, batch: str | None = None) -> DataFrame:
        orders = self.work_orders(run_date, cleaned)
        return workorders.publish_work_orders(orders, self.water_source, run_date, path=path, batch=batch)

    def progress(self, orders: DataFrame) -> DataFrame:
        return workorders.progress_rollup(orders)
