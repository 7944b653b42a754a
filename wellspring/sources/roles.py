"""Survey tables ("roles") derived from the driver's TPC-H-style tables.

The jobs in ``wellspring.plans`` expect the survey's own tables (location,
visits, water_source, well_pollution, employee, auditor_report, a queue log).
The test data has none of them, so each role is a projection or join of the
given tables. Every role is a lazy DataFrame: its columns are pruned and its
filters pushed into the Parquet scans by Catalyst, so a job that needs two
columns of a role reads two columns of the underlying files.

Mapping (one row of the role per row of the first table named):

=================  =========================================  ==========================================
role               built from                                 columns
=================  =========================================  ==========================================
location           orders ⋈ customer ⋈ nation ⋈ region        location_id=o_orderkey, address=c_name,
                                                              province_name=r_name,
                                                              town_name='Town_' ‖ n_nationkey % 7,
                                                              location_type=c_mktsegment
water_source       part                                       source_id=p_partkey, type from p_type,
                                                              number_of_people_served=p_size
well_pollution     part where p_type = 'ECONOMY'              results by p_size % 3, description by
                                                              p_partkey % 4, biological=(p_partkey % 10)/100
visits             lineitem                                   record_id=l_orderkey*100+l_linenumber,
                                                              location_id=l_orderkey, source_id=l_partkey,
                                                              assigned_employee_id=l_suppkey,
                                                              visit_count=l_linenumber,
                                                              time_in_queue=floor(l_quantity),
                                                              subjective_quality_score=l_linestatus
water_quality      lineitem                                   record_id as in visits,
                                                              visit_count=l_linenumber, one row per record_id,
                                                              subjective_quality_score=min(l_linestatus)
employee           supplier                                   assigned_employee_id=s_suppkey,
                                                              employee_name=s_name, town_name as above
auditor_report     orders                                     location_id=o_orderkey,
                                                              true_water_source_score=o_orderstatus,
                                                              type from o_orderpriority,
                                                              statements=o_orderpriority
queue_log          events                                     time_of_record=ts,
                                                              time_in_queue=floor(value)
staff_names        part                                       assigned_employee_id=p_partkey,
                                                              employee_name=p_name (names with spaces)
=================  =========================================  ==========================================

Town labels repeat across provinces (seven labels, five provinces), so a
town is only identified by (province_name, town_name), as in the survey.
``water_quality`` holds the visits' scores by record id, and the audit joins it on
that id as the survey does. The visit row also carries its score, for callers
without a quality table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.operators.joins import skew_join
from wellspring.sources.parquet import Tables

# ---------------------------------------------------------------------------
# Fixed values of the role mapping (must be identical in the DuckDB oracle).
# ---------------------------------------------------------------------------
# p_type word -> water source type; any other word is "other".
SOURCE_TYPE_BY_PART_TYPE = [
    ("SMALL", "river"),
    ("MEDIUM", "shared_tap"),
    ("STANDARD", "tap_in_home"),
    ("PROMO", "tap_in_home_broken"),
    ("ECONOMY", "well"),
]
UNLISTED_SOURCE_TYPE = "other"
WELL_PART_TYPE = "ECONOMY"
# p_size % 3 -> pollution result
POLLUTION_RESULT_BY_SIZE_MOD3 = ["Clean", "Contaminated: Biological", "Contaminated: Chemical"]
# p_partkey % 4 -> pollution description (0 and 1 are the two mislabels)
POLLUTION_DESCRIPTION_BY_KEY_MOD4 = [
    "Clean Bacteria: E. coli",
    "Clean Bacteria: Giardia Lamblia",
    "Parasite: Cryptosporidium",
    "Clean",
]
# o_orderpriority -> source type the auditor wrote down
AUDITOR_TYPE_BY_PRIORITY = [
    ("1-URGENT", "river"),
    ("2-HIGH", "shared_tap"),
    ("3-MEDIUM", "tap_in_home"),
    ("4-NOT SPECIFIED", "tap_in_home_broken"),
    ("5-LOW", "well"),
]
TOWN_PREFIX = "Town_"
TOWNS_PER_NATION = 7


def _lookup(c: Column, pairs, default) -> Column:
    expr = None
    for key, value in pairs:
        expr = F.when(c == key, value) if expr is None else expr.when(c == key, value)
    return expr.otherwise(default)


def _by_index(c: Column, values) -> Column:
    return _lookup(c, list(enumerate(values)), None)


def town_label(nationkey: Column) -> Column:
    return F.concat(F.lit(TOWN_PREFIX), (nationkey % TOWNS_PER_NATION).cast("string"))


def geography(t: Tables) -> DataFrame:
    """nation ⋈ region: one row per nation with its province and town label."""
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", F.col("r_name").alias("province_name"))
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select("n_nationkey", "province_name",
                    town_label(F.col("n_nationkey")).alias("town_name")))


def placed_customers(t: Tables) -> DataFrame:
    """Customers with their province, town label and segment, keyed by ``o_custkey``."""
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = geography(t)
    return (cust.join(geo, cust.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("address"),
                    "province_name", "town_name", F.col("c_mktsegment").alias("location_type")))


LOCATION_COLUMNS = ["location_id", "address", "province_name", "town_name", "location_type"]


def location(t: Tables, hot: dict | list | None = None) -> DataFrame:
    """One site per order, placed by its customer's nation and region.

    The orders-to-customer join goes through ``skew_join``: a customer with
    a large share of the orders is spread over several tasks. ``hot`` are
    the hot customers, if known (found on all orders otherwise).
    """
    orders = t.orders.select("o_orderkey", "o_custkey")
    return (skew_join(orders, placed_customers(t), "o_custkey", hot=hot)
            .select(F.col("o_orderkey").alias("location_id"), *LOCATION_COLUMNS[1:]))


def located_customers(t: Tables) -> DataFrame:
    """Customers that have orders, with their place and, as ``sites``, how many: the
    locations, counted before their join. A customer with a third of the orders
    is one row here, so counts of locations need no salt."""
    sites = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("sites"))
    return sites.join(placed_customers(t), "o_custkey")


def water_source(t: Tables) -> DataFrame:
    p = t.part
    return p.select(
        F.col("p_partkey").alias("source_id"),
        _lookup(F.col("p_type"), SOURCE_TYPE_BY_PART_TYPE, UNLISTED_SOURCE_TYPE)
        .alias("type_of_water_source"),
        F.col("p_size").alias("number_of_people_served"),
    )


def well_pollution(t: Tables) -> DataFrame:
    p = t.part.filter(F.col("p_type") == WELL_PART_TYPE)
    return p.select(
        F.col("p_partkey").alias("source_id"),
        _by_index(F.col("p_partkey") % 4, POLLUTION_DESCRIPTION_BY_KEY_MOD4).alias("description"),
        _by_index(F.col("p_size") % 3, POLLUTION_RESULT_BY_SIZE_MOD3).alias("results"),
        ((F.col("p_partkey") % 10) / 100).alias("biological"),
    )


def visits(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("record_id"),
        F.col("l_orderkey").alias("location_id"),
        F.col("l_partkey").alias("source_id"),
        F.col("l_suppkey").alias("assigned_employee_id"),
        F.col("l_linenumber").alias("visit_count"),
        F.floor("l_quantity").cast("int").alias("time_in_queue"),
        F.col("l_linestatus").alias("subjective_quality_score"),
        F.col("l_shipdate").alias("time_of_record"),
    )


def water_quality(t: Tables) -> DataFrame:
    """One score per record id, as the survey keeps it apart from the visits (the test
    data repeat some ids: the smallest score counts). The id holds the line number, which is grouped by
    as it stands, so that a filter on the visit count reaches the scan."""
    record = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("record_id")
    return (t.lineitem.groupBy(record, F.col("l_linenumber").alias("visit_count"))
            .agg(F.min("l_linestatus").alias("subjective_quality_score"))
            .select("record_id", "subjective_quality_score", "visit_count"))


def employee(t: Tables) -> DataFrame:
    s = t.supplier
    return s.select(
        F.col("s_suppkey").alias("assigned_employee_id"),
        F.col("s_name").alias("employee_name"),
        town_label(F.col("s_nationkey")).alias("town_name"),
    )


def staff_names(t: Tables) -> DataFrame:
    p = t.part
    return p.select(F.col("p_partkey").alias("assigned_employee_id"),
                    F.col("p_name").alias("employee_name"))


def auditor_report(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("location_id"),
        _lookup(F.col("o_orderpriority"), AUDITOR_TYPE_BY_PRIORITY, UNLISTED_SOURCE_TYPE)
        .alias("type_of_water_source"),
        F.col("o_orderstatus").alias("true_water_source_score"),
        F.col("o_orderpriority").alias("statements"),
    )


def queue_log(t: Tables) -> DataFrame:
    e = t.events
    return e.select(F.col("ts").alias("time_of_record"),
                    F.floor("value").cast("int").alias("time_in_queue"))


def documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")
