"""The same results as plain SQL over the test tables, for DuckDB."""

from __future__ import annotations

from lapstar.schemas import STROKE_DISTANCES
from workload.staging import AS_OF, GATES, SCD_EXISTING, SCD_FEED, STAGING_SQL

SRC = "src_order, src_line, src_part, src_supp, src_price"
PART = r"\s*[+-]?(\d+\.?\d*|\.\d+)\s*"
TIME = rf"^{PART}(:{PART}){{0,2}}$"


def _time(c: str) -> str:
    """Seconds of a time text."""
    p = [f"TRY_CAST(split_part({c}, ':', {i}) AS DOUBLE)" for i in (1, 2, 3)]
    return f"""CASE WHEN regexp_matches({c}, '{TIME}') THEN
      CASE length({c}) - length(replace({c}, ':', '')) WHEN 0 THEN {p[0]} WHEN 1 THEN {p[0]} * 60 + {p[1]}
      ELSE {p[0]} * 3600 + {p[1]} * 60 + {p[2]} END END"""


def _format(c: str) -> str:
    """Text of seconds."""
    h = f"CAST(round({c} * 100) AS BIGINT)"
    decimals = f"lpad(CAST({h} % 100 AS VARCHAR), 2, '0')"
    whole = f"CAST({h} % 6000 // 100 AS VARCHAR)"
    return f"""CASE WHEN {h} // 6000 > 0 THEN CAST({h} // 6000 AS VARCHAR) || ':' || lpad({whole}, 2, '0') || '.' || {decimals}
      ELSE {whole} || '.' || {decimals} END"""


GENDER = "CASE Gender WHEN 'Women' THEN 'F' WHEN 'Men' THEN 'M' ELSE 'U' END"
DISTANCE = r"TRY_CAST(regexp_extract(Event, '(\d+)m', 1) AS INTEGER)"
STROKE = r"regexp_replace(Event, '\d+m\s*', '', 'g')"
AGE = f"CAST(date_part('year', age(DATE '{AS_OF}', birth_date)) AS INTEGER)"
NEWEST = ", ".join(f"{c} DESC" for c in ["swum_on", "Competition_Competition_Id", *SRC.split(", ")])
STROKE_ROWS = ", ".join(f"('{stroke}', {d})" for stroke, distances in STROKE_DISTANCES.items() for d in distances)
AGE_GROUP = f"CASE WHEN {AGE} BETWEEN 12 AND 14 THEN '12-14' WHEN {AGE} BETWEEN 15 AND 17 THEN '15-17' ELSE '17+' END"

CTES = {
    "raw_results": STAGING_SQL,
    "swims": f"""SELECT *, {DISTANCE} AS distance, {STROKE} AS stroke, {_time('Time')} AS time_seconds,
        TRY_CAST(Competition_Date AS DATE) AS swum_on FROM raw_results""",
    "project_swimmers": f"""SELECT DISTINCT SwimmerId AS swimmer_id, Name AS name,
        TRY_CAST(Birth_Date AS DATE) AS birth_date, {GENDER} AS gender, Citizenship AS nationality FROM raw_results""",
    "dim_swimmer": f"""SELECT row_number() OVER (ORDER BY swimmer_id) AS swimmer_sk, *, true AS is_current,
        DATE '{AS_OF}' AS valid_from, CAST(NULL AS DATE) AS valid_to, CAST(1 AS INTEGER) AS version
        FROM project_swimmers""",
    "events": "SELECT DISTINCT distance, stroke, 'LCM' AS course FROM swims",
    "dim_event": "SELECT row_number() OVER (ORDER BY distance, stroke) AS event_sk, * FROM events",
    "dim_competition": """SELECT row_number() OVER (ORDER BY competition_id) AS competition_sk, * FROM (
        SELECT DISTINCT Competition_Competition_Id AS competition_id, swum_on AS competition_date,
        Competition_Country AS location_code, Competition_Level AS competition_name FROM swims)""",
    "performance": f"""SELECT row_number() OVER (ORDER BY c.competition_id, w.Event,
          CAST(w.Overall_Rank AS INTEGER), w.SwimmerId, {SRC}) AS performance_id,
        s.swimmer_sk, e.event_sk, c.competition_sk, w.time_seconds,
        CAST(w.Overall_Rank AS INTEGER) AS overall_rank, CAST(w.Age AS INTEGER) AS age
        FROM swims w JOIN dim_swimmer s ON w.SwimmerId = s.swimmer_id AND s.is_current
        JOIN dim_event e ON w.distance = e.distance AND w.stroke = e.stroke
        JOIN dim_competition c ON w.Competition_Competition_Id = c.competition_id""",
    "rankings": """SELECT row_number() OVER (ORDER BY swimmer_sk, event_sk) AS ranking_id, * FROM (
        SELECT swimmer_sk, event_sk, min(time_seconds) AS best_time, min(overall_rank) AS best_rank
        FROM performance GROUP BY ALL)""",
    "star": """SELECT p.*, s.name, s.nationality, s.birth_date, s.is_current, e.stroke, c.competition_date
        FROM performance p JOIN dim_swimmer s ON p.swimmer_sk = s.swimmer_sk
        JOIN dim_event e ON p.event_sk = e.event_sk JOIN dim_competition c ON p.competition_sk = c.competition_sk""",
    "placed": f"""SELECT *, CASE WHEN time_seconds IS NOT NULL THEN row_number() OVER (
        PARTITION BY Competition_Competition_Id, Event ORDER BY time_seconds NULLS LAST, SwimmerId, {SRC}) END AS place
        FROM swims""",
    "counts": """SELECT SwimmerId AS swimmer_id, stroke, """
    + ", ".join(f"count(*) FILTER (place = {k}) AS rank{k}_count" for k in range(1, 6))
    + " FROM placed WHERE place <= 5 GROUP BY ALL",
    "history": f"""SELECT *, list(time_seconds ORDER BY swum_on, Competition_Competition_Id, {SRC})
        FILTER (time_seconds IS NOT NULL) OVER (PARTITION BY SwimmerId, stroke, distance
        ORDER BY swum_on, Competition_Competition_Id, {SRC}) AS every_time FROM swims""",
    "recent": "SELECT *, coalesce(every_time[-50:], []) AS times FROM history",
    "records": f"""SELECT SwimmerId, stroke, distance, count(*) AS n,
        string_agg(CAST(CAST(round(time_seconds * 100) AS BIGINT) AS VARCHAR), ';' ORDER BY nth DESC) AS times FROM (
          SELECT *, row_number() OVER (PARTITION BY SwimmerId, stroke, distance ORDER BY {NEWEST}) AS nth
          FROM swims WHERE time_seconds IS NOT NULL) WHERE nth <= 50 GROUP BY SwimmerId, stroke, distance""",
    "grid": f"""SELECT s.swimmer_id, k.stroke, k.distance
        FROM (SELECT DISTINCT SwimmerId AS swimmer_id FROM swims) s CROSS JOIN (VALUES {STROKE_ROWS}) k(stroke, distance)
        UNION SELECT SwimmerId, stroke, distance FROM records WHERE stroke IN {tuple(STROKE_DISTANCES)}""",
    "existing": SCD_EXISTING.format(customer="customer"),
    "feed": SCD_FEED.format(customer="customer"),
    "changes": """SELECT coalesce(e.k, f.k) AS k, CASE WHEN e.k IS NULL THEN 'new' WHEN f.k IS NULL THEN 'absent'
        WHEN e.name IS DISTINCT FROM f.name OR e.nat IS DISTINCT FROM f.nat THEN 'changed' ELSE 'same' END AS change
        FROM existing e FULL JOIN feed f ON e.k = f.k""",
    "snapshot": f"""SELECT e.k, e.name, e.nat, c.change <> 'changed' AS is_current, DATE '2000-01-01' AS valid_from,
        CASE WHEN c.change = 'changed' THEN DATE '{AS_OF}' END AS valid_to, CAST(1 AS INTEGER) AS version
        FROM existing e JOIN changes c ON e.k = c.k
        UNION ALL SELECT f.k, f.name, f.nat, true, DATE '{AS_OF}', NULL,
        CAST(CASE WHEN c.change = 'changed' THEN 2 ELSE 1 END AS INTEGER)
        FROM feed f JOIN changes c ON f.k = c.k WHERE c.change IN ('changed', 'new')""",
    "cuts": f"""SELECT *, CASE WHEN best_time <= {GATES.a_cut} THEN 'A Cut' WHEN best_time <= {GATES.b_cut} THEN 'B Cut'
        ELSE 'Not Qualified' END AS olympic_cut
        FROM (SELECT name, nationality, stroke, min(time_seconds) AS best_time FROM star WHERE is_current GROUP BY ALL)""",
    "last_five": f"""SELECT * FROM (
        SELECT name, nationality, stroke, count(*) FILTER (overall_rank = 1) AS rank_1_count
        FROM (SELECT * FROM star WHERE is_current QUALIFY row_number() OVER (
              PARTITION BY swimmer_sk, stroke
              ORDER BY competition_date DESC NULLS FIRST, competition_sk, performance_id) <= {GATES.last_swims})
        GROUP BY ALL) WHERE rank_1_count >= {GATES.min_wins}""",
    "qualifications": f"""SELECT name, nationality, {AGE} AS age, {AGE_GROUP} AS age_group, stroke,
        count(DISTINCT competition_sk) AS total_competitions,
        count(DISTINCT competition_sk) FILTER (time_seconds >= {GATES.qualifying_from}
          AND time_seconds <= {GATES.qualifying_to}) AS qualifying_competitions,
        count(DISTINCT competition_sk) FILTER (overall_rank IN {tuple(range(1, GATES.top_places + 1))}) AS ranked_competitions
        FROM star WHERE is_current AND {AGE} >= {GATES.min_age}
        GROUP BY swimmer_sk, name, nationality, birth_date, stroke
        HAVING total_competitions >= {GATES.min_competitions} AND qualifying_competitions >= {GATES.min_qualifying}""",
    "qualified": """SELECT DISTINCT name, q.nationality, age, age_group, stroke, olympic_cut,
        ifnull(rank_1_count, 0) AS rank_1_count, total_competitions, qualifying_competitions
        FROM qualifications q JOIN (FROM cuts WHERE olympic_cut <> 'Not Qualified') USING (name, stroke)
        LEFT JOIN last_five USING (name, stroke)""",
}

# What each table expression reads, so that a query carries only what it needs.
USES = {
    "swims": ["raw_results"],
    "project_swimmers": ["raw_results"],
    "dim_swimmer": ["project_swimmers"],
    "events": ["swims"],
    "dim_event": ["events"],
    "dim_competition": ["swims"],
    "performance": ["swims", "dim_swimmer", "dim_event", "dim_competition"],
    "rankings": ["performance"],
    "star": ["performance"],
    "placed": ["swims"],
    "counts": ["placed"],
    "history": ["swims"],
    "recent": ["history"],
    "records": ["swims"],
    "grid": ["records"],
    "changes": ["existing", "feed"],
    "snapshot": ["changes"],
    "cuts": ["star"],
    "last_five": ["star"],
    "qualifications": ["star"],
    "qualified": ["qualifications", "cuts", "last_five"],
}


def _needed(name: str) -> set[str]:
    return {name}.union(*[_needed(used) for used in USES.get(name, [])])


def _sql(select: str, *reads: str) -> str:
    needed = set().union(*[_needed(name) for name in reads])
    ctes = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed]
    return "WITH " + ",\n".join(ctes) + "\n" + select


CLUBS = (
    "SELECT nationality AS country, 'Club data not available' AS club_name, "
    + ", ".join(
        f"count(DISTINCT swimmer_sk) FILTER (stroke = '{stroke}') AS {name}"
        for stroke, name in {
            "Butterfly": "butterfly_count",
            "Freestyle": "freestyle_count",
            "Backstroke": "back_count",
            "Breaststroke": "breast_count",
        }.items()
    )
    + " FROM star GROUP BY nationality"
)

REPLACED = """SELECT * REPLACE (CASE WHEN NOT early OR src_line <> 1 THEN Time END AS Time) FROM (
    SELECT *, coalesce(CAST(Competition_Date AS DATE) <= DATE '1998-03-31', false) AS early FROM staged)
    WHERE NOT early OR src_line % 2 = 1"""


def _sql_replaced(select: str, *reads: str) -> str:
    """As ``_sql``, over the swims that are left when the early load was replaced by less."""
    whole = _sql(select, *reads)
    head = f"raw_results AS MATERIALIZED ({CTES['raw_results']})"
    assert head in whole
    return whole.replace(head, f"staged AS MATERIALIZED ({CTES['raw_results']}),\nraw_results AS MATERIALIZED ({REPLACED})")


LINES = "SELECT src_order, CASE WHEN src_line <> 7 THEN src_line END AS src_line FROM raw_results"
BY_COMPETITION = "SELECT Competition_Competition_Id AS competition_id, count(*) AS rows FROM raw_results GROUP BY ALL"
SCANNED = """SELECT SwimmerId AS swimmer_id, Name AS name, Birth_Date AS birth_date, Gender AS gender,
    Citizenship AS citizenship, Event AS event, Time AS time, Overall_Rank AS overall_rank, Age AS age,
    Competition_Competition_Id AS competition_id, Competition_Date AS competition_date,
    Competition_Country AS competition_country, Competition_Level AS competition_level FROM raw_results"""


def _counted(value: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({condition}) AS {value} FROM raw_results"
        for name, condition in conditions.items()
    )


REQUIRED = ["SwimmerId", "Name", "Birth_Date", "Gender", "Time", "Approving_Authority"]
LIMITS = {"SwimmerId": 50, "Name": 255, "Gender": 1, "Citizenship": 3, "Event": 16, "Sponsor": 5}
WAREHOUSE_TABLES = {
    "dim_swimmer": "dim_swimmer",
    "dim_event": "dim_event",
    "dim_competition": "dim_competition",
    "fact_swimming_performance": "performance",
    "fact_rankings": "rankings",
}

ORACLE: dict[str, str] = {
    "scan_results_csv": _sql(SCANNED, "raw_results"),
    "write_results_by_competition": _sql(BY_COMPETITION, "raw_results"),
    "read_table_or_empty": _sql(
        "SELECT 'present' AS table_name, count(*) AS rows FROM raw_results UNION ALL SELECT 'missing', 0",
        "raw_results",
    ),
    "overwrite_swap": _sql(
        """SELECT Competition_Competition_Id AS competition_id, count(*) AS rows FROM raw_results
        WHERE Overall_Rank <> '1' GROUP BY ALL""",
        "raw_results",
    ),
    "append_rows": _sql("SELECT count(*) AS rows FROM raw_results", "raw_results"),
    "profile_by_file": _sql(
        """SELECT Competition_Competition_Id AS competition_id, count(*) AS rows,
        count(*) FILTER (Time IS NULL) AS null_time,
        count(*) FILTER (Approving_Authority IS NULL) AS null_authority FROM raw_results GROUP BY ALL""",
        "raw_results",
    ),
    "null_counts": _sql(_counted("nulls", {c: f"{c} IS NULL" for c in REQUIRED}), "raw_results"),
    "row_count": _sql("SELECT count(*) AS rows FROM raw_results", "raw_results"),
    "dq_primary_key": _sql(
        f"""SELECT src_order, src_line, count(*) AS n FROM ({LINES}) GROUP BY ALL
        HAVING count(*) > 1 OR src_order IS NULL OR src_line IS NULL""",
        "raw_results",
    ),
    "dq_unique": _sql(
        f"""SELECT src_order, src_line, count(*) AS n FROM ({LINES})
        WHERE src_order IS NOT NULL AND src_line IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
        "raw_results",
    ),
    "dq_varchar_len": _sql(
        _counted("violations", {c: f"length({c}) > {n}" for c, n in LIMITS.items()}), "raw_results"
    ),
    "dq_foreign_key": _sql(
        "SELECT swimmer_sk, count(*) AS n FROM star WHERE nationality = 'N07' GROUP BY swimmer_sk",
        "star",
    ),
    "project_swimmers": _sql("SELECT * FROM project_swimmers", "project_swimmers"),
    "filter_current": _sql("SELECT k AS swimmer_id, version FROM snapshot WHERE is_current", "snapshot"),
    "filter_between": _sql(
        f"""SELECT SwimmerId AS swimmer_id, Competition_Competition_Id AS competition_id, time_seconds FROM swims
        WHERE time_seconds BETWEEN {GATES.qualifying_from} AND {GATES.qualifying_to}
        AND swum_on BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
        "swims",
    ),
    "eligible_entries": _sql(
        f"""SELECT {SRC} FROM raw_results WHERE Is_Disqualified = 'False'
        AND (Citizenship = Birth_Country OR CAST(Residency_Years AS INTEGER) >= 2)
        AND (Competition_Level <> 'National' OR Vaccination_Status = 'Fully Vaccinated')""",
        "raw_results",
    ),
    "parse_results": _sql(
        f"""SELECT {SRC}, CAST(Birth_Date AS DATE) AS birth_date, CAST(Age AS INTEGER) AS age, {GENDER} AS gender,
        CAST(Overall_Rank AS INTEGER) AS overall_rank, swum_on AS competition_date FROM swims""",
        "swims",
    ),
    "parse_event": _sql("SELECT DISTINCT Event AS event, distance, stroke FROM swims", "swims"),
    "parse_time": _sql("SELECT DISTINCT Time AS time_text, time_seconds FROM swims", "swims"),
    "format_time": _sql(
        f"SELECT DISTINCT {_format('time_seconds')} AS time_text, time_seconds FROM performance", "performance"
    ),
    "age_years": _sql(f"SELECT swimmer_id, {AGE} AS age FROM project_swimmers", "project_swimmers"),
    "age_groups": _sql(
        f"SELECT {AGE_GROUP} AS age_group, count(*) AS n FROM project_swimmers GROUP BY ALL", "project_swimmers"
    ),
    "age_days365": _sql(
        f"""SELECT swimmer_id, CAST(date_diff('day', birth_date, DATE '{AS_OF}') // 365 AS INTEGER) AS age
        FROM project_swimmers""",
        "project_swimmers",
    ),
    "education_band": _sql(
        f"""SELECT swimmer_id, CASE WHEN {AGE} < 18 THEN 'High School' WHEN {AGE} < 25 THEN 'Bachelors' END AS band
        FROM project_swimmers""",
        "project_swimmers",
    ),
    "history_array": _sql(
        """SELECT SwimmerId AS swimmer_id, CAST(len(times) AS BIGINT) AS n_times, times[1] AS first_time,
        times[-1] AS last_time FROM recent""",
        "recent",
    ),
    "surrogate_keys": _sql(
        f"SELECT {SRC}, row_number() OVER (ORDER BY SwimmerId, {SRC}) AS row_key FROM raw_results", "raw_results"
    ),
    "distinct_events": _sql("SELECT * FROM events", "events"),
    "dim_event": _sql("SELECT * FROM dim_event", "dim_event"),
    "dim_competition": _sql("SELECT * FROM dim_competition", "dim_competition"),
    "dim_swimmer_initial": _sql("SELECT * FROM dim_swimmer", "dim_swimmer"),
    "scd2_changes": _sql("SELECT * FROM changes", "changes"),
    "scd2_snapshot": _sql("SELECT * FROM snapshot", "snapshot"),
    "build_performance": _sql("SELECT * FROM performance", "performance"),
    "fact_rankings": _sql("SELECT * FROM rankings", "rankings"),
    "warehouse_row_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {cte}" for name, cte in WAREHOUSE_TABLES.items()
        ),
        "rankings",
    ),
    "replaced_load_rankings": _sql_replaced(
        """SELECT s.swimmer_id, e.distance, e.stroke, r.best_time, r.best_rank FROM rankings r
        JOIN dim_swimmer s ON r.swimmer_sk = s.swimmer_sk JOIN dim_event e ON r.event_sk = e.event_sk""",
        "rankings",
    ),
    "replaced_load_cuts": _sql_replaced("SELECT * FROM cuts", "cuts"),
    "replaced_load_qualified": _sql_replaced("SELECT * FROM qualified", "qualified"),
    "repeat_older_load": _sql(
        """SELECT table_name, CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS differing FROM (
        WITH b AS (SELECT SwimmerId, coalesce(CAST(Competition_Date AS DATE) <= DATE '1998-03-31', false) AS early
          FROM raw_results)
        SELECT 'dim_swimmer' AS table_name, (SELECT count(DISTINCT SwimmerId) FROM b WHERE early)
          + (SELECT count(DISTINCT SwimmerId) FROM b WHERE NOT early) AS rows
        UNION ALL SELECT 'dim_event', count(*) FROM dim_event UNION ALL SELECT 'dim_competition', count(*) FROM dim_competition
        UNION ALL SELECT 'fact_swimming_performance', count(*) FROM performance
        UNION ALL SELECT 'fact_rankings', (SELECT count(*) FROM (
          SELECT DISTINCT SwimmerId, distance, stroke, coalesce(swum_on <= DATE '1998-03-31', false) FROM swims)))""",
        "rankings",
    ),
    "load_files_twice": _sql(
        "SELECT Competition_Competition_Id AS competition_id, count(*) AS rows FROM swims GROUP BY ALL", "swims"
    ),
    "corrected_file": _sql(
        """SELECT competition_id, count(*) AS rows, CAST(sum(CASE WHEN ym % 3 = 0 THEN h + 9 - 2 * (h % 10) ELSE h END) AS BIGINT) AS hundredths
        FROM (SELECT Competition_Competition_Id AS competition_id, CAST(substr(Competition_Competition_Id, 2) AS INTEGER) AS ym,
          CAST(round(time_seconds * 100) AS BIGINT) AS h, src_line FROM swims)
        WHERE ym % 3 <> 1 OR src_line % 2 = 1 GROUP BY ALL""",
        "swims",
    ),
    "swimmer_history": _sql(
        f"""SELECT * FROM (WITH b AS (SELECT SwimmerId AS swimmer_id, Name AS name,
          bool_or(coalesce(CAST(Competition_Date AS DATE) <= DATE '1998-03-31', false)) AS early,
          bool_or(coalesce(CAST(Competition_Date AS DATE) > DATE '1998-03-31', true)) AS late FROM raw_results GROUP BY ALL)
        SELECT swimmer_id, name, 1 AS version, NOT late AS is_current, DATE '2018-06-29' AS valid_from,
          CASE WHEN late THEN DATE '{AS_OF}' END AS valid_to FROM b WHERE early
        UNION ALL SELECT swimmer_id, name || ' II', CASE WHEN early THEN 2 ELSE 1 END, true, DATE '{AS_OF}', NULL FROM b WHERE late)""",
        "swims",
    ),
    "compacted_load": _sql(
        """SELECT * FROM (WITH x AS (SELECT *, CAST(substr(Competition_Competition_Id, 2) AS INTEGER) % 5 AS fifth FROM swims),
        y AS (SELECT * FROM x WHERE fifth <> 1 OR src_line % 2 = 1),
        best AS (SELECT SwimmerId, distance, stroke, min(CAST(Overall_Rank AS INTEGER)) AS best_rank FROM y GROUP BY ALL)
        SELECT y.Competition_Competition_Id AS competition_id, count(*) AS rows,
          CAST(sum(CAST(round(y.time_seconds * 100) AS BIGINT)) AS BIGINT) AS hundredths, min(best.best_rank) AS best_rank
        FROM y JOIN best ON y.SwimmerId = best.SwimmerId AND y.distance = best.distance AND y.stroke = best.stroke
        GROUP BY ALL)""",
        "swims",
    ),
    "reset_warehouse": _sql(
        """SELECT * FROM (WITH e AS (SELECT * FROM swims WHERE swum_on <= DATE '1998-03-31')
        SELECT table_name, rows, CAST(0 AS BIGINT) AS rows_after FROM (
        SELECT 'dim_swimmer' AS table_name, count(DISTINCT SwimmerId) AS rows FROM e
        UNION ALL SELECT 'dim_event', count(*) FROM (SELECT DISTINCT distance, stroke FROM e)
        UNION ALL SELECT 'dim_competition', count(DISTINCT Competition_Competition_Id) FROM e
        UNION ALL SELECT 'fact_swimming_performance', count(*) FROM e
        UNION ALL SELECT 'fact_rankings', count(*) FROM (SELECT DISTINCT SwimmerId, distance, stroke FROM e)))""",
        "swims",
    ),
    "find_results": _sql(
        """SELECT 'given' AS folder, true AS found, count(*) AS rows FROM raw_results
        UNION ALL SELECT 'missing', false, NULL""",
        "raw_results",
    ),
    "event_places": _sql(
        f"SELECT {SRC}, place, CASE WHEN place <= 5 THEN 'Yes' ELSE 'No' END AS top_5 FROM placed", "placed"
    ),
    "event_top5": _sql(
        """SELECT Competition_Competition_Id AS competition_id, Event AS event, place, SwimmerId AS swimmer_id
        FROM placed WHERE place <= 5""",
        "placed",
    ),
    "place_counts": _sql("SELECT * FROM counts", "counts"),
    "personal_bests": _sql(
        f"""SELECT {SRC}, best_so_far, coalesce(time_seconds = best_so_far, false) AS is_personal_best FROM (
        SELECT *, min(time_seconds) OVER (PARTITION BY SwimmerId, stroke, distance
          ORDER BY swum_on, Competition_Competition_Id, {SRC} ROWS UNBOUNDED PRECEDING) AS best_so_far FROM swims)""",
        "swims",
    ),
    "rolling_history": _sql(
        f"""SELECT {SRC}, CAST(len(times) AS BIGINT) AS n_times,
        array_to_string(list_transform(times, lambda t: {_format('t')}), ';') AS history FROM recent""",
        "recent",
    ),
    "completed_results": _sql(
        f"""SELECT {SRC}, p.place, CASE WHEN p.place <= 5 THEN 'Yes' ELSE 'No' END AS top_5,
        CASE WHEN h.time_seconds = list_min(h.every_time) THEN 'True' ELSE 'False' END AS is_best, 'True' AS is_valid,
        CAST(len(h.times) AS BIGINT) AS n_times, h.times[-1] AS last_time
        FROM recent h JOIN placed p USING ({SRC})""",
        "recent", "placed",
    ),
    "rankings_summary": _sql(
        """SELECT g.swimmer_id, g.stroke, """
        + ", ".join(f"coalesce(any_value(c.rank{k}_count), 0) AS rank{k}_count" for k in range(1, 6))
        + """, CAST(sum(coalesce(r.n, 0)) AS BIGINT) AS n_times,
        string_agg(g.distance || ':' || coalesce(r.times, ''), '|' ORDER BY g.distance) AS records
        FROM grid g LEFT JOIN records r
          ON r.SwimmerId = g.swimmer_id AND r.stroke = g.stroke AND r.distance = g.distance
        LEFT JOIN counts c ON c.swimmer_id = g.swimmer_id AND c.stroke = g.stroke
        GROUP BY g.swimmer_id, g.stroke""",
        "counts",
        "grid",
    ),
    "top_entries": _sql(
        f"""SELECT {SRC}, level, entry_no FROM (SELECT *, row_number() OVER (
          PARTITION BY Competition_Competition_Id, Event, level ORDER BY SwimmerId, {SRC}) AS entry_no
          FROM (SELECT *, CASE WHEN month(CAST(Competition_Date AS DATE)) = 5 THEN 'Club'
            WHEN month(CAST(Competition_Date AS DATE)) <> 11 THEN Competition_Level END AS level FROM raw_results))
        WHERE entry_no <= CASE level WHEN 'National' THEN 60 WHEN 'Province' THEN 45 WHEN 'Local' THEN 35
          ELSE entry_no END""",
        "raw_results",
    ),
    "swimmer_rankings": _sql(
        "SELECT name AS swimmer_name, stroke, "
        + ", ".join(f"count(*) FILTER (own_rank = {k}) AS rank_{k}_count" for k in range(1, 6))
        + """ FROM (SELECT name, stroke, rank() OVER (PARTITION BY swimmer_sk, stroke
          ORDER BY time_seconds NULLS LAST) AS own_rank FROM star) GROUP BY ALL""",
        "star",
    ),
    "club_region_performance": _sql(CLUBS, "star"),
    "replaced_load_club": _sql_replaced(CLUBS, "star"),
    "approximate_club_region": _sql(
        f"SELECT country, butterfly_count, freestyle_count, back_count, breast_count, true AS within_bound FROM ({CLUBS})", "star"
    ),
    "swimmer_demographics": _sql(
        """SELECT nationality AS swimmer_citizenship, count(*) AS total_swimmers,
        CAST(1 AS INTEGER) AS birth_countries_count, nationality AS birth_countries
        FROM dim_swimmer GROUP BY nationality""",
        "dim_swimmer",
    ),
    "olympic_cuts": _sql("SELECT * FROM cuts", "cuts"),
    "last_five_rankings": _sql("SELECT * FROM last_five", "last_five"),
    "olympic_qualifications": _sql("SELECT * FROM qualifications", "qualifications"),
    "olympic_qualified_swimmers": _sql("SELECT * FROM qualified", "qualified"),
    "qualified_summary": _sql(
        "SELECT olympic_cut, stroke, count(*) AS qualified_count FROM qualified GROUP BY ALL", "qualified"
    ),
    "olympic_cuts_order": _sql(
        """SELECT stroke, best_time, row_number() OVER (ORDER BY stroke NULLS LAST, best_time NULLS LAST) AS position
        FROM cuts""",
        "cuts",
    ),
    "qualified_order": _sql(
        """SELECT olympic_cut, stroke, rank_1_count, name, row_number() OVER (
        ORDER BY CASE olympic_cut WHEN 'A Cut' THEN 1 WHEN 'B Cut' THEN 2 ELSE 3 END, stroke, rank_1_count DESC, name)
        AS position FROM qualified""",
        "qualified",
    ),
    "club_region_order": _sql(
        """SELECT nationality AS country, row_number() OVER (ORDER BY nationality NULLS LAST) AS position
        FROM (SELECT DISTINCT nationality FROM star)""",
        "star",
    ),
    "sql_parse_time": _sql("SELECT DISTINCT Time AS time_text, time_seconds FROM swims", "swims"),
    "event_labels": _sql(
        """SELECT DISTINCT distance || 'm ' || stroke AS label,
        upper(Competition_Level[1:3]) || '_' || lpad(CAST(month(swum_on) AS VARCHAR), 3, '0') AS code,
        strftime(swum_on, '%Y%m%d') || '_' || Competition_Competition_Id || '_results.csv' AS file FROM swims""",
        "swims",
    ),
    "stream_ingest": _sql(BY_COMPETITION, "raw_results"),
    "stream_archive": _sql(BY_COMPETITION, "raw_results"),
    "stream_load_facts": _sql(
        """SELECT c.competition_id, count(*) AS rows, min(p.time_seconds) AS min_time
        FROM performance p JOIN dim_competition c ON p.competition_sk = c.competition_sk GROUP BY ALL""",
        "performance",
    ),
    "stream_rankings": _sql(
        """SELECT SwimmerId AS swimmer_id, Event AS event, min(time_seconds) AS best_time,
        min(CAST(Overall_Rank AS INTEGER)) AS best_rank FROM swims GROUP BY ALL""",
        "swims",
    ),
}
ORACLE["summary_csv"] = ORACLE["rankings_summary"]
