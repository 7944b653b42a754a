"""Independent SQL for every registered query, runnable by DuckDB.

The driver's tables are views of the same names. Each statement first
rebuilds the survey roles it needs as CTEs (the same mapping as
``wellspring.sources.roles``, written out in SQL), then answers the question
the plain relational way, deliberately unlike the Spark plan: per-group
totals joined back to the detail, a cross join with a one-row total, window
ranks over whole partitions, ``NOT IN`` subqueries. Sums are cast to BIGINT
and percents computed in DOUBLE so both engines return the same types.
"""

from __future__ import annotations

from wellspring.plans.clean import EMAIL_DOMAIN

ROLE_SQL = {
    "location": """
        SELECT o.o_orderkey AS location_id, c.c_name AS address, r.r_name AS province_name,
               'Town_' || CAST(n.n_nationkey % 7 AS VARCHAR) AS town_name,
               c.c_mktsegment AS location_type
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "water_source": """
        SELECT p_partkey AS source_id,
               CASE p_type WHEN 'SMALL' THEN 'river' WHEN 'MEDIUM' THEN 'shared_tap'
                           WHEN 'STANDARD' THEN 'tap_in_home' WHEN 'PROMO' THEN 'tap_in_home_broken'
                           WHEN 'ECONOMY' THEN 'well' ELSE 'other' END AS type_of_water_source,
               p_size AS number_of_people_served
        FROM part""",
    "well_pollution": """
        SELECT p_partkey AS source_id,
               CASE p_partkey % 4 WHEN 0 THEN 'Clean Bacteria: E. coli'
                                  WHEN 1 THEN 'Clean Bacteria: Giardia Lamblia'
                                  WHEN 2 THEN 'Parasite: Cryptosporidium'
                                  WHEN 3 THEN 'Clean' END AS description,
               CASE p_size % 3 WHEN 0 THEN 'Clean' WHEN 1 THEN 'Contaminated: Biological'
                               WHEN 2 THEN 'Contaminated: Chemical' END AS results,
               (p_partkey % 10) / 100 AS biological
        FROM part WHERE p_type = 'ECONOMY'""",
    "visits": """
        SELECT l_orderkey * 100 + l_linenumber AS record_id, l_orderkey AS location_id,
               l_partkey AS source_id, l_suppkey AS assigned_employee_id,
               l_linenumber AS visit_count, CAST(FLOOR(l_quantity) AS INTEGER) AS time_in_queue,
               l_linestatus AS subjective_quality_score, l_shipdate AS time_of_record
        FROM lineitem""",
    "water_quality": """
        SELECT l_orderkey * 100 + l_linenumber AS record_id,
               min(l_linestatus) AS subjective_quality_score, min(l_linenumber) AS visit_count
        FROM lineitem GROUP BY 1""",
    "employee": """
        SELECT s_suppkey AS assigned_employee_id, s_name AS employee_name,
               'Town_' || CAST(s_nationkey % 7 AS VARCHAR) AS town_name
        FROM supplier""",
    "staff_names": """
        SELECT p_partkey AS assigned_employee_id, p_name AS employee_name FROM part""",
    "auditor_report": """
        SELECT o_orderkey AS location_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'river' WHEN '2-HIGH' THEN 'shared_tap'
                                    WHEN '3-MEDIUM' THEN 'tap_in_home'
                                    WHEN '4-NOT SPECIFIED' THEN 'tap_in_home_broken'
                                    WHEN '5-LOW' THEN 'well' ELSE 'other' END AS type_of_water_source,
               o_orderstatus AS true_water_source_score, o_orderpriority AS statements
        FROM orders""",
    "queue_log": """
        SELECT ts AS time_of_record, CAST(FLOOR(value) AS INTEGER) AS time_in_queue FROM events""",
    "documents_text": """
        SELECT doc_id, text FROM documents""",
}

TYPES = ["river", "shared_tap", "tap_in_home", "tap_in_home_broken", "well"]
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def with_roles(roles: list[str], body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{name} as ({ROLE_SQL[name]}\n)" for name in roles]
    parts += [f"{name} as ({sql}\n)" for name, sql in (ctes or [])]
    return "with " + ",\n".join(parts) + "\n" + body.strip()


# first visits with source, place and pollution result
CV_ROLES = ["visits", "well_pollution", "location", "water_source"]
CV = """
    select ws.type_of_water_source as source_type, loc.town_name, loc.province_name,
           loc.location_type, ws.number_of_people_served as people_served,
           v.time_in_queue, wp.results
    from visits v
    join water_source ws on ws.source_id = v.source_id
    join location loc on loc.location_id = v.location_id
    left join well_pollution wp on wp.source_id = v.source_id
    where v.visit_count = 1"""


def _cv(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_roles(CV_ROLES, body, [("cv", CV)] + (extra or []))


def _type_pct(t: str, total: str) -> str:
    return (f"round(cast(sum(case when c.source_type = '{t}' then c.people_served else 0 end) as double)"
            f" * 100 / cast(nullif({total}, 0) as double), 0) as {t}")


def _share_by(keys: list[str]) -> tuple[str, str]:
    """(totals CTE, pivot select) for the percent-of-group pivot, totals joined back."""
    k = ", ".join(keys)
    on = " and ".join(f"c.{x} = g.{x}" for x in keys)
    totals = f"select {k}, cast(sum(people_served) as bigint) as grp_total from cv group by {k}"
    cols = ",\n".join(_type_pct(t, "g.grp_total") for t in TYPES)
    pivot = f"""
    select {", ".join("c." + x for x in keys)},
    {cols}
    from cv c join grp g on {on}
    group by {", ".join("c." + x for x in keys)}, g.grp_total"""
    return totals, pivot


TOWN_TOTALS, TOWN_PCT = _share_by(["province_name", "town_name"])
PROV_TOTALS, PROV_PCT = _share_by(["province_name"])

# first-visit pairs where the two scores differ, with the surveyor's name
WRONG = """
    select a.location_id, a.type_of_water_source as auditor_source, v.record_id,
           e.assigned_employee_id, e.employee_name,
           a.true_water_source_score as auditor_score,
           q.subjective_quality_score as surveyor_score, a.statements
    from auditor_report a
    join visits v on v.location_id = a.location_id and v.visit_count = 1
    join water_quality q on q.record_id = v.record_id
    join employee e on e.assigned_employee_id = v.assigned_employee_id
    where a.true_water_source_score <> q.subjective_quality_score"""
AUDIT_ROLES = ["auditor_report", "visits", "water_quality", "employee"]
PER_NAME = """
    select employee_name, cast(count(employee_name) as bigint) as number_of_mistakes
    from wrong group by employee_name"""
FLAGGED = """
    select p.employee_name, p.number_of_mistakes
    from per_name p cross join (select avg(number_of_mistakes) as m from per_name) mean
    where p.number_of_mistakes > mean.m"""

# work orders: one row per first visit of a source that needs work
ORDERS = """
    select loc.address, loc.town_name, loc.province_name,
           cast(ws.source_id as varchar) as source_id, ws.type_of_water_source,
           case when wp.results = 'Contaminated: Chemical' then 'Install RO filter'
                when wp.results = 'Contaminated: Biological' then 'Install UV filter'
                when ws.type_of_water_source = 'river' then 'Drill well'
                when ws.type_of_water_source = 'shared_tap' and v.time_in_queue >= 30
                  then concat('Install ', cast(v.time_in_queue // 30 as varchar), ' taps nearby')
                when ws.type_of_water_source = 'tap_in_home_broken' then 'Diagnose infrastructure'
                else 'Null' end as Improvement,
           case when wp.results in ('Contaminated: Chemical', 'Contaminated: Biological')
                then 'In progress' else 'Backlog' end as Source_status,
           date '2024-01-31' as Date_of_completion,
           'Monitoring required' as Comments
    from visits v
    join water_source ws on ws.source_id = v.source_id
    join location loc on loc.location_id = v.location_id
    left join well_pollution wp on wp.source_id = ws.source_id
    where v.visit_count = 1
      and (wp.results <> 'Clean'
           or ws.type_of_water_source in ('river', 'tap_in_home_broken')
           or (ws.type_of_water_source = 'shared_tap' and v.time_in_queue >= 30))"""

FIXED_POLLUTION = """
    select source_id,
           case description when 'Clean Bacteria: E. coli' then 'Bacteria: E. coli'
                            when 'Clean Bacteria: Giardia Lamblia' then 'Bacteria: Giardia Lamblia'
                            else description end as description,
           case when results = 'Clean' and biological > 0.01 then 'Contaminated: Biological'
                else results end as results,
           biological
    from well_pollution"""
BAD_ROW = "(description like 'Clean_%' or (results = 'Clean' and biological > 0.01))"

PAIRS = """
    from auditor_report a
    join visits v on v.location_id = a.location_id
    join water_quality q on q.record_id = v.record_id"""


def _numbered(where: str) -> str:
    return with_roles(["water_source"], f"""
    select source_id, type_of_water_source, number_of_people_served, source_rank
    from numbered where {where}
    order by type_of_water_source, source_rank desc""", [("numbered", """
    select source_id, type_of_water_source, number_of_people_served,
           cast(row_number() over (partition by type_of_water_source
                                   order by number_of_people_served desc, source_id) as bigint) as source_rank
    from water_source""")])


def _heatmap() -> str:
    cols = ",\n".join(
        f"round(avg(time_in_queue) filter (where dayname(time_of_record) = '{d}'), 0) as {d}" for d in DAYS)
    return with_roles(["queue_log"], f"""
    select strftime(time_of_record, '%H:00') as hour_of_day,
    {cols}
    from queue_log where time_in_queue <> 0
    group by 1 order by 1""")


def _evidence(op: str) -> str:
    return with_roles(AUDIT_ROLES, f"""
    select w.employee_name, w.location_id, w.statements
    from wrong w
    where w.employee_name {op} (select employee_name from flagged)
      and lower(w.statements) like '%urgent%'""",
                      [("wrong", WRONG), ("per_name", PER_NAME), ("flagged", FLAGGED)])


def _people(cond: str) -> str:
    return f"sum(case when {cond} then people_served else 0 end)"


def _pct(num: str, den: str, digits: int = 0) -> str:
    return f"round(cast({num} as double) * 100 / cast(nullif({den}, 0) as double), {digits})"


HOME = "source_type in ('tap_in_home', 'tap_in_home_broken')"


def _violations() -> str:
    widths = [("address", 50), ("town_name", 30), ("province_name", 30), ("source_id", 20),
              ("type_of_water_source", 50), ("Improvement", 50), ("Source_status", 50)]
    long_cols = ",\n".join(f"count(*) filter (where length(o.{c}) > {n}) as {c.lower()}_too_long"
                            for c, n in widths)
    return with_roles(CV_ROLES, f"""
    select count(*) as orders_checked,
           count(*) filter (where o.source_id is null) as null_source_id,
           count(*) filter (where o.source_id is not null and k.source_id is null) as unknown_source_id,
           count(*) filter (where coalesce(o.Source_status, 'Backlog')
                            not in ('Backlog', 'In progress', 'Complete')) as invalid_status,
    {long_cols}
    from orders o
    left join (select distinct cast(source_id as varchar) as source_id from water_source) k
      on k.source_id = o.source_id""", [("orders", ORDERS)])


ORACLE: dict[str, str] = {
    # A: scans, sources, sinks
    "scan_full": with_roles(["visits"], "select * from visits"),
    "project_cols": with_roles(["auditor_report"],
                               "select location_id, true_water_source_score from auditor_report"),
    "preview_limit": with_roles(["location"], "select * from location order by location_id limit 5"),
    "snapshot_copy": with_roles(["well_pollution"], "select * from well_pollution"),
    "correct_rows": with_roles(["well_pollution"], FIXED_POLLUTION),
    "verify_clean": with_roles(["well_pollution"], f"""
    select count(*) filter (where {BAD_ROW.replace('description', 'w.description')
                                   .replace('results', 'w.results').replace('biological', 'w.biological')})
             as violations_before,
           count(*) filter (where {BAD_ROW.replace('description', 'f.description')
                                   .replace('results', 'f.results').replace('biological', 'f.biological')})
             as violations_after
    from well_pollution w join fixed f on f.source_id = w.source_id""", [("fixed", FIXED_POLLUTION)]),
    "email_expr": with_roles(["staff_names"],
                             "select lower(replace(employee_name, ' ', '.')) as email_local from staff_names"),
    "fill_email": with_roles(["staff_names"], f"""
    select assigned_employee_id, employee_name,
           lower(replace(employee_name, ' ', '.')) || '@{EMAIL_DOMAIN}' as email
    from staff_names"""),
    "phone_length": with_roles(["documents_text"],
                               "select doc_id, cast(strlen(text) as bigint) as length_bytes from documents_text"),
    # B/C: projections and filters
    "distinct_types": with_roles(["water_source"], "select type_of_water_source from water_source group by 1"),
    "filter_gt": with_roles(["visits"], "select * from visits where time_in_queue > 49"),
    "filter_in": with_roles(["water_source"],
                            "select * from water_source where source_id in (7, 42, 99, 123, 150)"),
    "filter_and": with_roles(["water_quality"], """
    select record_id, subjective_quality_score, visit_count from water_quality
    where visit_count = 2 and subjective_quality_score = 'F'"""),
    "filter_contradiction": with_roles(["well_pollution"],
                                       "select * from well_pollution where biological > 0.01 and results = 'Clean'"),
    "filter_like_prefix": with_roles(["well_pollution"], """
    select * from well_pollution where biological > 0.01 and description like 'Clean_%'"""),
    # D/E/F: profile
    "count_by_key": with_roles(["employee"], """
    select town_name, count(*) as num_employees from employee group by 1 order by 2 desc"""),
    "count_by_town": with_roles(["location"], """
    select town_name, count(*) as record_count from location group by 1 order by 1"""),
    "count_by_location_type": with_roles(["location"], """
    select location_type, count(*) as record_count from location group by 1 order by 2 desc"""),
    "count_by_type": with_roles(["water_source"], """
    select type_of_water_source, count(*) as "count" from water_source group by 1"""),
    "count_by_two": with_roles(["location"], """
    select province_name, town_name, count(*) as records_per_town
    from location group by 1, 2 order by 1, 3 desc"""),
    "top_visitors": with_roles(["visits"], """
    select assigned_employee_id, count(visit_count) as number_of_visits
    from visits group by 1 order by 2 desc, 1 limit 3"""),
    "total_served": with_roles(["water_source"],
                               "select cast(sum(number_of_people_served) as bigint) as total from water_source"),
    "served_by_type": with_roles(["water_source"], """
    select type_of_water_source, cast(sum(number_of_people_served) as bigint) as total_people_served
    from water_source group by 1 order by 2 desc"""),
    "avg_by_type": with_roles(["water_source"], """
    select type_of_water_source, round(avg(number_of_people_served), 0) as avg_people_served
    from water_source group by 1"""),
    "rank_types": with_roles(["water_source"], """
    select t.type_of_water_source, t.total_people_served,
           cast(1 + (select count(*) from per_type u where u.total_people_served > t.total_people_served)
                as bigint) as rank_by_people_served
    from per_type t order by 2 desc""", [("per_type", """
    select type_of_water_source, cast(sum(number_of_people_served) as bigint) as total_people_served
    from water_source group by 1""")]),
    "share_window": with_roles(["location"], """
    select location_type, count(*) as record_count,
           round(cast(count(*) as double) * 100 / cast(sum(count(*)) over () as double), 2) as percentage
    from location group by 1 order by 2 desc"""),
    "share_crossjoin": with_roles(["location"], """
    select n.location_type, n.record_count,
           round(cast(n.record_count as double) * 100 / cast(t.all_rows as double), 2) as percentage
    from per_type n cross join (select sum(record_count) as all_rows from per_type) t
    order by 2 desc""", [("per_type", "select location_type, count(*) as record_count from location group by 1")]),
    "share_subquery": with_roles(["water_source"], """
    select type_of_water_source, cast(sum(number_of_people_served) as bigint) as total_people_served,
           round(cast(sum(number_of_people_served) as double) * 100
                 / (select cast(sum(number_of_people_served) as double) from water_source), 0) as percentage
    from water_source group by 1 order by 2 desc"""),
    "rank_then_filter": _numbered("source_id in (3, 58, 101, 144, 199)"),
    "top_n_per_type": _numbered("source_rank <= 10"),
    "priority_ranks": with_roles(["water_source"], """
    select ws.source_id, ws.type_of_water_source, ws.number_of_people_served, p.p_brand as brand,
           cast(rank() over (partition by ws.type_of_water_source
                             order by ws.number_of_people_served desc, ws.source_id) as bigint) as source_rank
    from water_source ws join part p on p.p_partkey = ws.source_id"""),
    # W5: queues
    "survey_span": with_roles(["queue_log"], """
    select min(time_of_record) as survey_start, max(time_of_record) as survey_end,
           cast(date_diff('day', min(time_of_record), max(time_of_record)) as bigint) as survey_duration_days,
           round(date_diff('day', min(time_of_record), max(time_of_record)) / 365, 4) as survey_duration_years
    from queue_log"""),
    "avg_queue_filter": with_roles(["queue_log"], """
    select round(avg(time_in_queue), 4) as avg_queue_time_minutes from queue_log where time_in_queue > 0"""),
    "avg_queue_nullif": with_roles(["queue_log"], """
    select round(sum(time_in_queue) filter (where time_in_queue <> 0)
                 / count(*) filter (where time_in_queue <> 0), 4) as avg_queue_time_minutes
    from queue_log"""),
    "queue_by_weekday": with_roles(["queue_log"], """
    select dayname(time_of_record) as day_of_week, round(avg(time_in_queue), 0) as avg_queue_time
    from queue_log where time_in_queue > 0 group by 1"""),
    "queue_by_hour": with_roles(["queue_log"], """
    select cast(hour(time_of_record) as bigint) as hour_of_day, round(avg(time_in_queue), 0) as avg_queue_time
    from queue_log where time_in_queue > 0 group by 1 order by 1"""),
    "queue_by_hour_label": with_roles(["queue_log"], """
    select strftime(time_of_record, '%H:00') as hour_of_day, round(avg(time_in_queue), 0) as avg_queue_time
    from queue_log where time_in_queue > 0 group by 1 order by 1"""),
    "queue_heatmap": _heatmap(),
    # J: joins
    "join_two": with_roles(["visits", "location"], """
    select loc.province_name, loc.town_name, v.visit_count, loc.location_id
    from visits v join location loc on loc.location_id = v.location_id"""),
    "join_three": with_roles(["visits", "location", "water_source"], """
    select loc.province_name, loc.town_name, v.visit_count, loc.location_id,
           ws.type_of_water_source, ws.number_of_people_served
    from visits v
    join location loc on loc.location_id = v.location_id
    join water_source ws on ws.source_id = v.source_id
    where v.visit_count = 1"""),
    "join_point_lookup": with_roles(["visits", "location", "water_source"], """
    select loc.province_name, loc.town_name, v.visit_count, loc.location_id,
           ws.type_of_water_source, ws.number_of_people_served
    from visits v
    join location loc on loc.location_id = v.location_id
    join water_source ws on ws.source_id = v.source_id
    where loc.location_id = 42"""),
    # W6/W7: audit
    "audit_match": with_roles(["auditor_report", "visits", "water_quality"], f"""
    select a.location_id, v.record_id, a.true_water_source_score as auditor_score,
           q.subjective_quality_score as surveyor_score
    {PAIRS}
    where a.true_water_source_score = q.subjective_quality_score"""),
    "audit_match_first": with_roles(["auditor_report", "visits", "water_quality"], f"""
    select a.location_id, v.record_id, a.true_water_source_score as auditor_score,
           q.subjective_quality_score as surveyor_score
    {PAIRS}
    where v.visit_count = 1 and a.true_water_source_score = q.subjective_quality_score"""),
    "audit_mismatch": with_roles(["auditor_report", "visits", "water_quality"], f"""
    select a.location_id, a.type_of_water_source as auditor_source, v.record_id,
           a.true_water_source_score as auditor_score, q.subjective_quality_score as surveyor_score
    {PAIRS}
    where v.visit_count = 1 and a.true_water_source_score <> q.subjective_quality_score"""),
    "audit_accuracy": with_roles(["auditor_report", "visits", "water_quality"], f"""
    select count(*) as audited,
           count(*) filter (where same) as agreeing,
           count(*) filter (where not same) as disagreeing,
           round(cast(count(*) filter (where same) as double) * 100
                 / cast(nullif(count(*), 0) as double), 2) as accuracy_pct
    from (select a.true_water_source_score = q.subjective_quality_score as same
          {PAIRS}
          where v.visit_count = 1) p
    where same is not null"""),
    "audit_source_compare": with_roles(["auditor_report", "visits", "water_quality", "water_source"], f"""
    select a.location_id, a.type_of_water_source as auditor_source,
           ws.type_of_water_source as survey_source, v.record_id,
           a.true_water_source_score as auditor_score, q.subjective_quality_score as surveyor_score
    {PAIRS}
    join water_source ws on ws.source_id = v.source_id
    where v.visit_count = 1 and a.true_water_source_score <> q.subjective_quality_score"""),
    "audit_by_employee": with_roles(AUDIT_ROLES, """
    select location_id, record_id, employee_name, auditor_score, surveyor_score from wrong""",
                                    [("wrong", WRONG)]),
    "incorrect_view": with_roles(AUDIT_ROLES, """
    select location_id, record_id, employee_name, auditor_score, surveyor_score, statements from wrong""",
                                 [("wrong", WRONG)]),
    "distinct_offenders": with_roles(AUDIT_ROLES, "select employee_name from wrong group by 1",
                                     [("wrong", WRONG)]),
    "mistakes_per_employee": with_roles(AUDIT_ROLES, "select * from per_name order by number_of_mistakes desc",
                                        [("wrong", WRONG), ("per_name", PER_NAME)]),
    "avg_mistakes": with_roles(AUDIT_ROLES, """
    select round(avg(number_of_mistakes), 4) as avg_error_count_per_empl from per_name""",
                               [("wrong", WRONG), ("per_name", PER_NAME)]),
    "suspect_list": with_roles(AUDIT_ROLES, "select * from flagged",
                               [("wrong", WRONG), ("per_name", PER_NAME), ("flagged", FLAGGED)]),
    "suspect_statements": _evidence("in"),
    "nonsuspect_statements": _evidence("not in"),
    # W8/W9: access
    "combined_view": _cv("select * from cv"),
    "province_source_share": _cv(PROV_PCT + "\n    order by 1", [("grp", PROV_TOTALS)]),
    "town_source_share": _cv(TOWN_PCT + "\n    order by 2", [("grp", TOWN_TOTALS)]),
    "town_access_mat": _cv("select * from town_pct", [("grp", TOWN_TOTALS), ("town_pct", TOWN_PCT)]),
    "ratio_broken": _cv("""
    select province_name, town_name,
           round(tap_in_home_broken / nullif(tap_in_home_broken + tap_in_home, 0) * 100, 0) as Pct_broken_taps,
           round(tap_in_home / nullif(tap_in_home_broken + tap_in_home, 0) * 100, 0) as pct_home
    from town_pct""", [("grp", TOWN_TOTALS), ("town_pct", TOWN_PCT)]),
    "ratio_broken_exact": _cv(f"""
    select province_name, town_name,
           round(cast({_people("source_type = 'tap_in_home_broken'")} as double)
                 / cast(nullif({_people(HOME)}, 0) as double) * 100, 0) as Pct_broken_taps,
           round(cast({_people("source_type = 'tap_in_home'")} as double)
                 / cast(nullif({_people(HOME)}, 0) as double) * 100, 0) as pct_home
    from cv group by 1, 2"""),
    "headline_shares": _cv(f"""
    select {_pct(_people("source_type = 'shared_tap'"), 'sum(people_served)')} as shared_tap_pct,
           {_pct(_people(HOME), 'sum(people_served)')} as home_tap_pct,
           {_pct(_people("source_type = 'tap_in_home_broken'"), _people(HOME))} as broken_within_home_pct,
           {_pct(_people("source_type = 'well'"), 'sum(people_served)')} as well_pct,
           {_pct(_people("source_type = 'well' and results = 'Clean'"), _people("source_type = 'well'"))}
             as clean_within_wells_pct,
           round(avg(nullif(time_in_queue, 0)), 4) as avg_queue_minutes
    from cv"""),
    # W10/W11: work orders
    "work_orders": with_roles(CV_ROLES, "select * from orders", [("orders", ORDERS)]),
    "work_orders_cleaned": with_roles(["visits", "well_pollution", "location", "water_source"],
                                      "select * from orders",
                                      [("fixed", FIXED_POLLUTION),
                                       ("orders", ORDERS.replace("left join well_pollution wp",
                                                                 "left join fixed wp"))]),
    "work_orders_violations": _violations(),
    "progress_rollup": with_roles(CV_ROLES, """
    select province_name, town_name, count(*) as work_orders,
           count(*) filter (where st = 'Complete') as complete,
           count(*) filter (where st = 'In progress') as in_progress,
           count(*) filter (where st = 'Backlog') as backlog,
           round(cast(count(*) filter (where st = 'Complete') as double) * 100
                 / cast(count(*) as double), 2) as pct_complete,
           cast(grouping(province_name, town_name) as bigint) as level
    from (select *, coalesce(Source_status, 'Backlog') as st from orders) o
    group by rollup (province_name, town_name)""", [("orders", ORDERS)]),
}

# Other plans for questions that have their SQL above.
ORACLE |= {
    "combined_view_bucketed": ORACLE["combined_view"],
    "audit_match_bucketed": ORACLE["audit_match_first"],
    "town_access_refresh": ORACLE["town_access_mat"],
    "correct_rows_partial": ORACLE["correct_rows"],
    "lookup_clustered": with_roles(["visits"], "select * from visits where location_id = 42"),
    "filter_case_blind": with_roles(["auditor_report"], """
    select location_id, type_of_water_source, statements from auditor_report
    where lower(statements) in ('1-urgent', '2-high', '5-low') or statements ilike '4-not spec%'"""),
    "join_case_blind": with_roles(["auditor_report", "water_source"], """
    select p.type_of_water_source, a.typed, a.reports, p.total_people_served
    from (select type_of_water_source, cast(sum(number_of_people_served) as bigint) as total_people_served
          from water_source group by 1) p
    join (select upper(type_of_water_source) as typed, count(*) as reports from auditor_report group by 1) a
      on lower(a.typed) = lower(p.type_of_water_source)"""),
    "group_case_blind": with_roles(["auditor_report"], """
    select min(statements) as statements, count(*) as n, count(distinct statements) as spellings
    from (select statements from auditor_report union all select lower(statements) from auditor_report) s
    group by lower(statements)"""),
}
