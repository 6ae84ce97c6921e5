"""For every query, the same question as SQL over the driver's tables."""

from __future__ import annotations

# --- Inputs in bronze, silver and staging shape ------------------------------

EVENTS_BRONZE = r"""
events_bronze AS (
  SELECT strftime(ts, '%Y-%m-%d') AS realtime_start,
         strftime(ts, '%Y-%m-%d') AS realtime_end,
         strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) < 6 THEN '.'
              WHEN CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) = 99 THEN 'n/a'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
         event_type AS series_id,
         'Series ' || event_type AS series_name,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_timestamp,
         strftime(ts, '%Y-%m-%d') AS ingest_date
  FROM events)"""

DAILY_BRONZE = """
daily_named AS (
  SELECT *, strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%Y-%m-%d') AS revised,
         CASE l_returnflag || l_linestatus
              WHEN 'AF' THEN 'GDP' WHEN 'AO' THEN 'UNRATE' WHEN 'NF' THEN 'CPIAUCSL'
              WHEN 'NO' THEN 'DFF' WHEN 'RF' THEN 'UMCSENT' WHEN 'RO' THEN 'RO' END AS series_id
  FROM lineitem),
daily_bronze AS (
  SELECT revised AS realtime_start,
         '9999-12-31' AS realtime_end,
         strftime(l_shipdate, '%Y-%m-%d') AS date,
         CASE WHEN l_quantity = 7 THEN '.' WHEN l_quantity = 23 THEN 'n/a'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS value,
         series_id,
         'Series ' || series_id AS series_name,
         revised || 'T06:00:00' AS ingestion_timestamp,
         revised AS ingest_date
  FROM daily_named)"""


def _silver(name: str) -> str:
    return f"""
{name}_silver AS (
  SELECT series_id, series_name,
         TRY_CAST(date AS DATE) AS observation_date,
         CASE WHEN value = '.' THEN NULL ELSE TRY_CAST(value AS DOUBLE) END AS value,
         value AS value_raw,
         COALESCE(value = '.', false) AS is_missing,
         CASE WHEN value = '.' THEN NULL ELSE TRY_CAST(value AS DOUBLE) END IS NOT NULL AS is_valid,
         realtime_start, realtime_end, ingestion_timestamp, date AS date_raw
  FROM {name}_bronze)"""


def _staged(name: str) -> str:
    return f"""
{name}_staged AS (
  SELECT series_id, series_name, observation_date, value,
         realtime_start AS data_as_of_date,
         CAST(ingestion_timestamp AS TIMESTAMP) AS ingested_at
  FROM {name}_silver WHERE is_valid)"""


def _current(name: str, where: str = "true") -> str:
    return f"""
{name}_current AS (
  SELECT series_id, series_name, observation_date, value, data_as_of_date, ingested_at
  FROM (SELECT *, ROW_NUMBER() OVER (
                 PARTITION BY series_id, observation_date
                 ORDER BY data_as_of_date DESC, ingested_at DESC, value DESC, series_name DESC
               ) AS age
        FROM {name}_staged WHERE {where})
  WHERE age = 1 OR observation_date IS NULL)"""


EVENTS = EVENTS_BRONZE + "," + _silver("events")
DAILY = DAILY_BRONZE + "," + _silver("daily")
EVENTS_STAGED = EVENTS + "," + _staged("events")
DAILY_STAGED = DAILY + "," + _staged("daily")
EVENTS_CURRENT = EVENTS_STAGED + "," + _current("events")
DAILY_CURRENT = DAILY_STAGED + "," + _current("daily")

MONTHLY = """
monthly_current AS (
  SELECT o_orderpriority AS series_id,
         'Priority ' || o_orderpriority AS series_name,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value,
         strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS data_as_of_date,
         MAX(o_orderdate) AS ingested_at
  FROM orders
  GROUP BY o_orderpriority, date_trunc('month', o_orderdate))"""

# --- Gold -------------------------------------------------------------------


def _fact(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT series_id AS indicator_id,
         observation_date AS date_key,
         value AS observation_value,
         previous_value,
         value_year_ago,
         CASE WHEN previous_value IS NOT NULL AND previous_value <> 0
              THEN ((value - previous_value) / previous_value) * 100 END AS period_change_pct,
         CASE WHEN value_year_ago IS NOT NULL AND value_year_ago <> 0
              THEN ((value - value_year_ago) / value_year_ago) * 100 END AS yoy_change_pct,
         data_as_of_date,
         ingested_at
  FROM (SELECT *, LAG(value, 1) OVER w AS previous_value, LAG(value, 12) OVER w AS value_year_ago
        FROM {source}
        WINDOW w AS (PARTITION BY series_id
                     ORDER BY observation_date NULLS LAST, data_as_of_date NULLS FIRST,
                              ingested_at NULLS FIRST, value)))"""


# The series catalogue as a relation, and the calendar from the parts of the date's text.
DIM_INDICATORS = """
attributes(series_id, category, frequency) AS (
  VALUES ('GDP', 'Output', 'Quarterly/Monthly'), ('UNRATE', 'Labor Market', 'Monthly'),
         ('CPIAUCSL', 'Inflation', 'Quarterly/Monthly'), ('DFF', 'Monetary Policy', 'Daily'),
         ('UMCSENT', 'Sentiment', 'Monthly')),
dim_i AS (
  SELECT s.series_id AS indicator_id, s.series_name AS indicator_name, a.category, a.frequency
  FROM (SELECT series_id, series_name FROM daily_staged GROUP BY ALL) s
  LEFT JOIN attributes a USING (series_id))"""

DIM_TIME = """
parts AS (
  SELECT d, CAST(strftime(d, '%Y') AS INTEGER) AS y, CAST(strftime(d, '%m') AS INTEGER) AS m
  FROM (SELECT observation_date AS d FROM daily_staged GROUP BY observation_date)),
dim_t AS (
  SELECT d AS date_key, d AS observation_date, y AS year,
         CAST((m + 2) // 3 AS INTEGER) AS quarter, m AS month,
         CAST(strftime(d, '%d') AS INTEGER) AS day,
         CAST(strftime(d, '%w') AS INTEGER) AS day_of_week,
         CAST(d - make_date(y, 1, 1) + 1 AS INTEGER) AS day_of_year,
         make_date(y, m, 1) AS month_start,
         make_date(y, (m - 1) // 3 * 3 + 1, 1) AS quarter_start,
         make_date(y, 1, 1) AS year_start,
         strftime(d, '%a') IN ('Sat', 'Sun') AS is_weekend
  FROM parts)"""

GOLD = ",".join(
    [
        DAILY_CURRENT,
        DIM_INDICATORS,
        DIM_TIME,
        _fact("daily_current", "fct"),
        _fact("daily_staged", "fct_all"),
    ]
)


def _star(fact: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT f.indicator_id, i.indicator_name, f.date_key, f.observation_value, f.yoy_change_pct,
         t.year, t.quarter, t.month, f.data_as_of_date, f.ingested_at
  FROM {fact} f
  JOIN dim_i i ON f.indicator_id = i.indicator_id
  JOIN dim_t t ON f.date_key = t.date_key)"""


STARS = ",".join([GOLD, _star("fct", "star"), _star("fct_all", "star_all")])
STAR_COLUMNS = (
    "indicator_id, indicator_name, date_key, observation_value, yoy_change_pct, "
    "year, quarter, month"
)

# --- Dashboard --------------------------------------------------------------

DEDUPED = """
deduped AS (
  SELECT date_key, indicator_name,
         LAST(indicator_id ORDER BY data_as_of_date, ingested_at, indicator_id, observation_value)
           FILTER (WHERE indicator_id IS NOT NULL) AS indicator_id,
         LAST(observation_value
              ORDER BY data_as_of_date, ingested_at, indicator_id, observation_value)
           FILTER (WHERE observation_value IS NOT NULL) AS observation_value,
         LAST(yoy_change_pct
              ORDER BY data_as_of_date, ingested_at, indicator_id, observation_value,
                       yoy_change_pct)
           FILTER (WHERE yoy_change_pct IS NOT NULL) AS yoy_change_pct,
         MAX(year) AS year, MAX(quarter) AS quarter, MAX(month) AS month
  FROM star_all
  WHERE date_key IS NOT NULL AND indicator_name IS NOT NULL
  GROUP BY date_key, indicator_name)"""

MONTHLY_POINTS = (
    MONTHLY
    + """,
deduped AS (
  SELECT observation_date AS date_key, series_name AS indicator_name, value AS observation_value
  FROM monthly_current)"""
)


def _pivot(columns: dict[str, str]) -> str:
    cells = ",\n".join(
        f"  MAX(CASE WHEN indicator_name = '{name}' THEN observation_value END) AS {alias}"
        for name, alias in columns.items()
    )
    return f"SELECT date_key,\n{cells}\nFROM deduped GROUP BY date_key"


CORR = """
SELECT x.indicator_name AS indicator_x, y.indicator_name AS indicator_y,
       COUNT(*) AS n_pairs,
       ROUND(CASE WHEN isnan(CORR(x.observation_value, y.observation_value)) THEN NULL
                  ELSE CORR(x.observation_value, y.observation_value) END, 6) AS r
FROM deduped x JOIN deduped y ON x.date_key = y.date_key
GROUP BY x.indicator_name, y.indicator_name"""


# The points of the sources that are finite numbers.
NON_FINITE = """
dirty AS (
  SELECT date_key, indicator_name,
         CASE WHEN indicator_name = 'Priority 1-URGENT' AND EXTRACT(MONTH FROM date_key) = 3
              THEN 'Infinity'::DOUBLE
              WHEN indicator_name = 'Priority 1-URGENT' AND EXTRACT(MONTH FROM date_key) = 5
              THEN 'NaN'::DOUBLE ELSE observation_value END AS observation_value
  FROM deduped),
finite AS (SELECT * FROM dirty WHERE isfinite(observation_value))"""

EDGES = """
edges_bronze AS (
  SELECT '2000-01-01' AS realtime_start, realtime_end,
         CASE day WHEN 1 THEN year || '-13-01' WHEN 2 THEN ''
              ELSE CASE WHEN day < 10 THEN year || '-' || month || '-' || day ELSE date END
         END AS date,
         CASE day WHEN 3 THEN 'Infinity' WHEN 4 THEN 'NaN' ELSE value END AS value,
         CASE WHEN day <> 28 THEN series_id END AS series_id,
         series_name, '2000-01-02T03:04:05' AS ingestion_timestamp
  FROM (SELECT *, date[:4] AS year, CAST(date[6:7] AS INTEGER) AS month,
               CAST(date[9:10] AS INTEGER) AS day FROM daily_bronze))"""


def _nan_apart(relation: str, *columns: str) -> str:
    flags = ", ".join(f"COALESCE(isnan({c}), false) AS {c}_is_nan" for c in columns)
    plain = ", ".join(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" for c in columns)
    return f"SELECT * REPLACE ({plain}), {flags} FROM {relation}"


FACT_DOUBLES = (
    "observation_value",
    "previous_value",
    "value_year_ago",
    "period_change_pct",
    "yoy_change_pct",
)

LATEST = """
SELECT indicator_id, indicator_name, date_key, observation_value AS latest_value,
       yoy_change_pct AS latest_yoy,
       printf('%.2f', observation_value) AS value_label,
       COALESCE(printf('%.2f%% YoY', yoy_change_pct), 'N/A') AS change_label
FROM {star}
QUALIFY ROW_NUMBER() OVER (
  PARTITION BY indicator_id
  ORDER BY date_key DESC, data_as_of_date DESC, ingested_at DESC, observation_value DESC,
           yoy_change_pct DESC) = 1"""


def _test(test: str, table: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{test}' AS test, '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST(({failures}) AS BIGINT) AS failures"
    )


def _nulls(table: str, relation: str, column: str) -> str:
    return _test(
        "not_null", table, column, f"SELECT COUNT(*) FROM {relation} WHERE {column} IS NULL"
    )


def _repeats(table: str, relation: str, column: str) -> str:
    return _test(
        "unique",
        table,
        column,
        f"SELECT COUNT(*) FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING COUNT(*) > 1)",
    )


def _broken(table: str, relation: str, column: str, parent: str, field: str) -> str:
    return _test(
        "relationships",
        table,
        column,
        f"SELECT COUNT(*) FROM {relation} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{column})",
    )


def _union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


CATALOGUE = """
catalogue AS (
  SELECT * FROM (VALUES ('GDP'), ('UNRATE'), ('CPIAUCSL'), ('DFF'), ('UMCSENT')) v(series_id))"""

SUMMARY = """
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE is_valid) AS valid_records,
       COUNT(*) FILTER (WHERE is_missing) AS missing_records,
       COUNT(*) FILTER (WHERE NOT is_valid AND NOT is_missing) AS unparseable_records,
       CAST(printf('%.2f', 100 * COUNT(*) FILTER (WHERE is_valid)
                           / CAST(COUNT(*) AS DOUBLE)) AS DOUBLE) AS valid_pct,
       CAST(printf('%.2f', 100 * COUNT(*) FILTER (WHERE is_missing)
                           / CAST(COUNT(*) AS DOUBLE)) AS DOUBLE) AS missing_pct
FROM daily_silver"""

YOY = """
SELECT c.series_id AS indicator_id, c.observation_date AS date_key,
       c.value AS observation_value, p.value AS value_12_months_ago,
       CASE WHEN p.value IS NOT NULL AND p.value <> 0
            THEN ((c.value - p.value) / p.value) * 100 END AS yoy_calendar_pct
FROM {source} c
LEFT JOIN {source} p
  ON c.series_id = p.series_id
 AND p.observation_date = CAST(c.observation_date - INTERVAL 1 YEAR AS DATE)"""

RESAMPLE = """
SELECT series_id AS indicator_id,
       CAST(date_trunc('{unit}', observation_date) AS DATE) AS period_start,
       COUNT(*) AS n_observations,
       ARG_MIN(value, observation_date) AS first_value,
       ARG_MAX(value, observation_date) AS last_value,
       MIN(value) AS min_value,
       MAX(value) AS max_value,
       ROUND(AVG(value), 6) AS mean_value
FROM daily_current
GROUP BY series_id, date_trunc('{unit}', observation_date)"""

HISTORY = """
renamed AS (
  SELECT series_id, data_as_of_date, ingested_at,
         CASE WHEN data_as_of_date >= '1998-01-01'
               AND NOT (data_as_of_date >= '2000-01-01' AND series_id IN ('GDP', 'DFF'))
              THEN series_name || ' rebased' ELSE series_name END AS name
  FROM daily_staged),
per_date AS (
  SELECT series_id, data_as_of_date, ARG_MAX(name, ingested_at) AS name
  FROM renamed GROUP BY series_id, data_as_of_date),
changes AS (
  SELECT * FROM (
    SELECT *, LAG(name) OVER (PARTITION BY series_id ORDER BY data_as_of_date) AS before
    FROM per_date)
  WHERE before IS NULL OR before <> name)"""

# The names of all as-of dates as intervals.
INTERVALS = """
intervals AS (
  SELECT series_id, name, data_as_of_date AS valid_from,
         LEAD(data_as_of_date) OVER (PARTITION BY series_id ORDER BY data_as_of_date) AS valid_to
  FROM changes)"""

# Each day of each series with the value that holds on it.
WEIGHTED = """
spine AS (
  SELECT c.series_id, c.value, c.observation_date AS since,
         UNNEST(generate_series(c.observation_date,
                COALESCE(LEAD(c.observation_date) OVER (PARTITION BY c.series_id ORDER BY c.observation_date),
                         c.observation_date + 1)::DATE - 1, INTERVAL 1 DAY))::DATE AS day
  FROM {source} c WHERE c.observation_date IS NOT NULL),
levelled AS (
  SELECT s.*, u.level, date_trunc(u.level, day)::DATE AS period_start
  FROM spine s CROSS JOIN (VALUES ('month'), ('quarter'), ('year')) u(level))
SELECT series_id AS indicator_id, level, period_start, COUNT(*) AS n_days,
       COUNT(*) FILTER (WHERE day = since) AS n_observations,
       ROUND(AVG(value), 6) AS mean_value, ARG_MAX(value, day) AS last_value
FROM levelled GROUP BY series_id, level, period_start"""

# Smoothing of monthly series, one observation after the other.
SMOOTHED = """
placed AS (
  SELECT series_id, value,
         ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY observation_date) - 1 AS place
  FROM monthly_current),
first_cycle AS (
  SELECT series_id, AVG(value) AS level, LIST(value ORDER BY place) AS cycle
  FROM placed WHERE place < 12 GROUP BY series_id HAVING COUNT(*) = 12),
smoothed AS (
  SELECT series_id, CAST(11 AS BIGINT) AS place, level, CAST(0 AS DOUBLE) AS trend,
         [v - level for v in cycle] AS season, CAST(NULL AS DOUBLE) AS forecast
  FROM first_cycle
  UNION ALL
  SELECT series_id, place, new_level, 0.05 * (new_level - level) + 0.95 * trend,
         list_append(season[2:], 0.2 * (value - new_level) + 0.8 * season[1]), forecast
  FROM (SELECT s.*, p.place AS next_place, p.value, 0.3 * (p.value - s.season[1]) + 0.7 * (s.level + s.trend) AS new_level,
               s.level + s.trend + s.season[1] AS next_forecast
        FROM smoothed s JOIN placed p ON p.series_id = s.series_id AND p.place = s.place + 1)
       t(series_id, old_place, level, trend, season, old_forecast, place, value, new_level, forecast))"""

THREE = "('GDP', 'UNRATE', 'CPIAUCSL')"

SERIES_COLUMNS = {
    "Series GDP": "gdp",
    "Series UNRATE": "unrate",
    "Series CPIAUCSL": "cpiaucsl",
    "Series DFF": "dff",
    "Series UMCSENT": "umcsent",
    "Series RO": "ro",
}
PRIORITY_COLUMNS = {
    "Priority 1-URGENT": "urgent",
    "Priority 2-HIGH": "high",
    "Priority 3-MEDIUM": "medium",
    "Priority 4-NOT SPECIFIED": "not_specified",
    "Priority 5-LOW": "low",
}

# The run stamps one ingestion time on all rows of a run date.
DAILY_RUN = ",".join(
    [
        DAILY,
        """
run_staged AS (
  SELECT series_id, series_name, observation_date, value,
         realtime_start AS data_as_of_date, TIMESTAMP '2024-02-01 06:00:00' AS ingested_at
  FROM daily_silver
  WHERE is_valid AND observation_date >= DATE '1996-01-01')""",
        _current("run"),
        _fact("run_current", "fct"),
    ]
)

EDGES_CURRENT = ",".join(
    [DAILY_BRONZE, EDGES, _silver("edges"), _staged("edges"), _current("edges")]
)

def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


FACT = "SELECT * FROM fct"


def _recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body.strip()}"


def _version(where: str) -> str:
    """The star over gold built from scratch on some of staging."""
    staged = f"v_staged AS (SELECT * FROM daily_staged WHERE NOT COALESCE({where}, false))"
    dims = [d.replace("daily_staged", "v_staged") for d in (DIM_INDICATORS, DIM_TIME)]
    parts = [DAILY_STAGED, staged, _current("v"), *dims, _fact("v_current", "fct"), _star("fct", "star")]
    return _with(",".join(parts), f"SELECT {STAR_COLUMNS} FROM star")


ARRIVING = """(series_id = 'UMCSENT' AND observation_date >= DATE '1997-06-01')
              OR (series_id = 'DFF' AND data_as_of_date >= '1998-01-01')"""
WITHDRAWN = "series_id = 'GDP' AND observation_date BETWEEN DATE '1994-03-01' AND DATE '1994-03-20'"


SQL = {
    "bronze_explode": _with(
        EVENTS_BRONZE,
        """SELECT realtime_start, realtime_end, date, value, series_id, series_name,
                  '2024-02-01T06:00:00+00:00' AS ingestion_timestamp, ingest_date
           FROM events_bronze WHERE date >= '2024-01-10'""",
    ),
    "bronze_audit": _with(
        EVENTS_BRONZE
        + """, expected AS (
  SELECT DISTINCT series_id FROM events_bronze UNION ALL SELECT 'never')""",
        """SELECT e.series_id, COUNT(b.series_id) > 0 AS found, COUNT(b.series_id) AS n_rows
           FROM expected e LEFT JOIN events_bronze b ON e.series_id = b.series_id
           GROUP BY e.series_id""",
    ),
    "bronze_audit_totals": _with(
        DAILY_BRONZE + "," + CATALOGUE,
        """SELECT COUNT(*) FILTER (WHERE n > 0) AS series_found, COUNT(*) AS series_expected,
                  CAST(SUM(n) AS BIGINT) AS total_rows
           FROM (SELECT c.series_id, COUNT(b.series_id) AS n FROM catalogue c
                 LEFT JOIN daily_bronze b ON c.series_id = b.series_id GROUP BY c.series_id)""",
    ),
    "bronze_date_range": _with(
        EVENTS_BRONZE,
        """SELECT series_id, MIN(date) AS min_date, MAX(date) AS max_date, COUNT(*) AS n_rows
           FROM events_bronze GROUP BY series_id""",
    ),
    "silver_clean": _with(DAILY, "SELECT * FROM daily_silver"),
    "silver_clean_events": _with(EVENTS, "SELECT * FROM events_silver"),
    "silver_dq_summary": _with(DAILY, SUMMARY),
    "silver_partition_roundtrip": _with(EVENTS, "SELECT * FROM events_silver"),
    "silver_clustered_roundtrip": _with(DAILY, "SELECT * FROM daily_silver"),
    "silver_stream_roundtrip": _with(EVENTS, "SELECT * FROM events_silver"),
    "stg_observations": _with(DAILY_STAGED, "SELECT * FROM daily_staged"),
    "stg_view": _with(EVENTS_STAGED, "SELECT * FROM events_staged"),
    "current_vintage": _with(DAILY_CURRENT, "SELECT * FROM daily_current"),
    "current_vintage_events": _with(EVENTS_CURRENT, "SELECT * FROM events_current"),
    "vintage_stream_roundtrip": _with(EVENTS_CURRENT, "SELECT * FROM events_current"),
    "as_of": _with(
        DAILY_STAGED + "," + _current("daily", "data_as_of_date <= '1998-06-30'"),
        "SELECT * FROM daily_current",
    ),
    "dim_indicators": _with(DAILY_STAGED + "," + DIM_INDICATORS, "SELECT * FROM dim_i"),
    "dim_time": _with(DAILY_STAGED + "," + DIM_TIME, "SELECT * FROM dim_t"),
    "fct_observations": _with(DAILY_CURRENT + "," + _fact("daily_current", "fct"), FACT),
    "fct_observations_events": _with(EVENTS_CURRENT + "," + _fact("events_current", "fct"), FACT),
    "fct_observations_monthly": _with(MONTHLY + "," + _fact("monthly_current", "fct"), FACT),
    "fct_all_vintages": _with(DAILY_STAGED + "," + _fact("daily_staged", "fct"), FACT),
    "fct_all_vintages_events": _with(EVENTS_STAGED + "," + _fact("events_staged", "fct"), FACT),
    "yoy_calendar": _with(DAILY_CURRENT, YOY.format(source="daily_current")),
    "yoy_calendar_gaps": _with(
        MONTHLY
        + """, gappy AS (
  SELECT * FROM monthly_current WHERE EXTRACT(MONTH FROM observation_date) <> 7)""",
        YOY.format(source="gappy"),
    ),
    "resample_month": _with(DAILY_CURRENT, RESAMPLE.format(unit="month")),
    "resample_year": _with(DAILY_CURRENT, RESAMPLE.format(unit="year")),
    "indicator_history": _with(
        DAILY_STAGED + "," + HISTORY,
        """SELECT series_id AS indicator_id, name AS indicator_name,
                  data_as_of_date AS valid_from,
                  LEAD(data_as_of_date) OVER w AS valid_to,
                  LEAD(data_as_of_date) OVER w IS NULL AS is_current
           FROM changes WINDOW w AS (PARTITION BY series_id ORDER BY data_as_of_date)""",
    ),
    "star_join": _with(
        STARS, f"SELECT {STAR_COLUMNS} FROM star WHERE indicator_id IN {THREE}"
    ),
    "star_join_all_vintages": _with(STARS, f"SELECT {STAR_COLUMNS} FROM star_all"),
    "indicator_list": _with(DAILY_STAGED + "," + DIM_INDICATORS, "SELECT * FROM dim_i"),
    "date_bounds": _with(
        STARS, "SELECT MIN(date_key) AS min_date, MAX(date_key) AS max_date FROM star"
    ),
    "date_range_filter": _with(
        STARS,
        f"""SELECT {STAR_COLUMNS} FROM star
            WHERE date_key >= DATE '1997-01-01' AND date_key <= DATE '1998-12-31'""",
    ),
    "latest_metrics": _with(STARS, LATEST.format(star="star")),
    "latest_metrics_all_vintages": _with(STARS, LATEST.format(star="star_all")),
    "latest_50_all_vintages": _with(
        STARS,
        """SELECT indicator_name, date_key, observation_value, yoy_change_pct FROM star_all
           ORDER BY date_key DESC, indicator_name, data_as_of_date DESC, ingested_at DESC,
                    observation_value DESC, yoy_change_pct DESC
           LIMIT 50""",
    ),
    "silver_clean_edges": _with(
        DAILY_BRONZE + "," + EDGES + "," + _silver("edges"), _nan_apart("edges_silver", "value")
    ),
    "current_vintage_edges": _with(EDGES_CURRENT, _nan_apart("edges_current", "value")),
    "fct_observations_edges": _with(
        EDGES_CURRENT + "," + _fact("edges_current", "fct"), _nan_apart("fct", *FACT_DOUBLES)
    ),
    "dq_not_null_edges": _with(
        EDGES_CURRENT,
        _union(
            _nulls("stg_observations", "edges_staged", "series_id"),
            _nulls("stg_observations", "edges_staged", "observation_date"),
        ),
    ),
    "gold_refresh": _with(STARS, f"SELECT {STAR_COLUMNS} FROM star"),
    "landing_quarantine": _with(
        """paged AS (
  SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, event_type AS series_id,
         event_id // 100 AS page, COUNT(*) AS n
  FROM events GROUP BY ALL)""",
        """SELECT ingest_date, series_id,
                  CASE page % 5 WHEN 1 THEN 'broken JSON' WHEN 2 THEN 'another shape'
                                WHEN 3 THEN 'no JSON' ELSE 'sound' END AS fate,
                  COUNT(*) AS n_documents,
                  CAST(SUM(CASE WHEN page % 5 IN (1, 2, 3) THEN 0 ELSE n END) AS BIGINT) AS n_observations
           FROM paged GROUP BY ALL""",
    ),
    "as_of_many": _with(
        DAILY_STAGED
        + """, vintage AS (
  SELECT series_id, observation_date, data_as_of_date, value FROM daily_staged
  QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id, observation_date, data_as_of_date
                             ORDER BY ingested_at DESC, value DESC) = 1),
probe AS (
  SELECT l_orderkey, l_linenumber, series_id, CAST(l_shipdate AS DATE) AS observation_date,
         strftime(CAST(l_shipdate AS DATE) + CAST(l_partkey % 12 AS INTEGER) - 2, '%Y-%m-%d') AS known_at
  FROM daily_named)""",
        """SELECT p.*, v.value, v.data_as_of_date
           FROM probe p ASOF LEFT JOIN vintage v
             ON p.series_id = v.series_id AND p.observation_date = v.observation_date
            AND p.known_at >= v.data_as_of_date""",
    ),
    "indicator_history_refreshed": _with(
        DAILY_STAGED + "," + HISTORY + "," + INTERVALS,
        """SELECT series_id AS indicator_id, name AS indicator_name, valid_from, valid_to,
                  valid_to IS NULL AS is_current FROM intervals""",
    ),
    "fact_with_names": _with(
        DAILY_STAGED + "," + HISTORY + "," + INTERVALS,
        """SELECT s.series_id AS indicator_id, s.observation_date AS date_key,
                  s.value AS observation_value, s.data_as_of_date, i.name AS indicator_name
           FROM daily_staged s LEFT JOIN intervals i
             ON s.series_id = i.series_id AND s.data_as_of_date >= i.valid_from
            AND (i.valid_to IS NULL OR s.data_as_of_date < i.valid_to)""",
    ),
    "time_weighted": _with(DAILY_CURRENT, "").rstrip() + "," + WEIGHTED.format(source="daily_current"),
    "time_weighted_gaps": _with(
        MONTHLY + """, gaps AS (
  SELECT * FROM monthly_current WHERE EXTRACT(MONTH FROM observation_date) <> 7)""", "").rstrip()
    + "," + WEIGHTED.format(source="gaps").replace("AVG(value), 6", "AVG(value), 4"),
    "rolling_anomalies": _with(
        DAILY_CURRENT
        + """, ranked AS (
  SELECT series_id, observation_date, value,
         ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY observation_date) AS place
  FROM daily_current WHERE observation_date IS NOT NULL),
before AS (
  SELECT a.series_id, a.place, COUNT(b.value) AS n, MEDIAN(b.value) AS median, MAD(b.value) AS mad
  FROM ranked a LEFT JOIN ranked b
    ON a.series_id = b.series_id AND b.place BETWEEN a.place - 30 AND a.place - 1
  GROUP BY a.series_id, a.place)""",
        """SELECT r.series_id AS indicator_id, r.observation_date AS date_key,
                  r.value AS observation_value, CAST(n AS INTEGER) AS n_before,
                  median AS median_before, mad AS deviation_before,
                  ROUND(CASE WHEN n >= 8 AND mad > 0 THEN abs(r.value - median) / (1.4826 * mad) END, 6) AS robust_score,
                  CASE WHEN n < 8 THEN false
                       WHEN mad > 0 THEN abs(r.value - median) / (1.4826 * mad) > 3.5
                       ELSE r.value <> median END AS is_anomaly
           FROM ranked r JOIN before b ON r.series_id = b.series_id AND r.place = b.place""",
    ),
    "dq_learned_ranges": _with(
        DAILY_STAGED
        + """, quantiles AS (
  SELECT series_id, QUANTILE_DISC(value, 0.3) AS lower, QUANTILE_DISC(value, 0.6) AS upper
  FROM daily_staged GROUP BY series_id),
limits AS (
  SELECT series_id, lower - 0.5 * (upper - lower) AS min_value, upper + 0.5 * (upper - lower) AS max_value
  FROM quantiles)""",
        """SELECT s.series_id, s.observation_date, s.value, s.data_as_of_date, s.ingested_at,
                  l.min_value, l.max_value
           FROM daily_staged s JOIN limits l ON s.series_id = l.series_id
           WHERE s.value < l.min_value OR s.value > l.max_value""",
    ),
    "seasonal_forecasts": _recursive(
        MONTHLY + "," + SMOOTHED,
        """SELECT p.series_id, p.place, p.value, ROUND(s.forecast, 2) AS forecast
           FROM placed p LEFT JOIN smoothed s ON p.series_id = s.series_id AND p.place = s.place
           UNION ALL
           SELECT series_id, place + step, NULL, ROUND(level + step * trend + season[(step - 1) % 12 + 1], 2)
           FROM (SELECT * FROM smoothed
                 QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY place DESC) = 1)
           CROSS JOIN (SELECT UNNEST(generate_series(1, 12)) AS step)""",
    ),
    "forecast_backtest": _recursive(
        MONTHLY + "," + SMOOTHED,
        """SELECT p.series_id, COUNT(*) AS n_forecasts, ROUND(AVG(abs(p.value - s.forecast)), 2) AS mean_error,
                  ROUND(AVG(abs(p.value - q.value)), 2) AS naive_error
           FROM smoothed s JOIN placed p ON p.series_id = s.series_id AND p.place = s.place
           JOIN placed q ON q.series_id = p.series_id AND q.place = p.place - 1
           WHERE s.forecast IS NOT NULL GROUP BY p.series_id""",
    ),
    "gold_version_refreshed": _version(WITHDRAWN),
    "gold_version_pinned": _version(ARRIVING),
    "gold_refresh_clustered": _with(STARS, f"SELECT {STAR_COLUMNS} FROM star"),
    "series_timeseries": _with(
        STARS,
        """SELECT indicator_id, indicator_name, date_key, observation_value
           FROM star WHERE indicator_id = 'DFF'""",
    ),
    "yoy_series": _with(
        STARS,
        """SELECT indicator_id, indicator_name, date_key, yoy_change_pct FROM star
           WHERE indicator_id IN ('GDP', 'UNRATE') AND yoy_change_pct IS NOT NULL""",
    ),
    "dedupe_last": _with(STARS + "," + DEDUPED, "SELECT * FROM deduped"),
    "pivot_wide": _with(STARS + "," + DEDUPED, _pivot(SERIES_COLUMNS)),
    "pivot_monthly": _with(MONTHLY_POINTS, _pivot(PRIORITY_COLUMNS)),
    "corr_matrix": _with(STARS + "," + DEDUPED, CORR),
    "corr_monthly": _with(MONTHLY_POINTS, CORR),
    "corr_non_finite": _with(
        MONTHLY_POINTS + "," + NON_FINITE, CORR.replace("deduped", "finite")
    ),
    "corr_nations": _with(
        """deduped AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date_key,
         'Nation ' || c_nationkey AS indicator_name,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS observation_value
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY date_trunc('month', o_orderdate), c_nationkey)""",
        CORR,
    ),
    "latest_50": _with(
        STARS,
        """SELECT indicator_name, date_key, observation_value, yoy_change_pct FROM star
           ORDER BY date_key DESC, indicator_name, observation_value DESC, yoy_change_pct DESC
           LIMIT 50""",
    ),
    "csv_export_roundtrip": _with(
        STARS,
        f"""SELECT {STAR_COLUMNS.replace("indicator_name,", "")},
                   '  "a", "' || indicator_name || '" ' || chr(10) || ' and more ' AS indicator_name
            FROM star WHERE indicator_id IN {THREE}""",
    ),
    "dq_suite": _with(
        GOLD,
        _union(
            _nulls("stg_observations", "daily_staged", "series_id"),
            _nulls("stg_observations", "daily_staged", "series_name"),
            _nulls("stg_observations", "daily_staged", "observation_date"),
            _nulls("stg_observations", "daily_staged", "value"),
            _nulls("dim_indicators", "dim_i", "indicator_id"),
            _repeats("dim_indicators", "dim_i", "indicator_id"),
            _nulls("dim_time", "dim_t", "date_key"),
            _repeats("dim_time", "dim_t", "date_key"),
            _nulls("fct_observations", "fct", "indicator_id"),
            _nulls("fct_observations", "fct", "date_key"),
            _nulls("fct_observations", "fct", "observation_value"),
            _broken("fct_observations", "fct", "indicator_id", "dim_i", "indicator_id"),
            _broken("fct_observations", "fct", "date_key", "dim_t", "date_key"),
        ),
    ),
    "dq_not_null": _with(
        DAILY,
        _union(
            *(
                _nulls("silver", "daily_silver", c)
                for c in ("series_id", "series_name", "observation_date", "value")
            )
        ),
    ),
    "dq_unique": _with(
        GOLD,
        _union(
            _repeats("dim_time", "dim_t", "date_key"),
            _repeats("fct_all_vintages", "fct_all", "date_key"),
            _repeats("lineitem", "lineitem", "l_orderkey"),
        ),
    ),
    "dq_relationships": _with(
        GOLD + "," + CATALOGUE,
        _union(
            _broken("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            _broken("customer", "customer", "c_custkey", "orders", "o_custkey"),
            _broken("fct_observations", "fct", "indicator_id", "catalogue", "series_id"),
        ),
    ),
    "dq_in_range": _with(
        DAILY_STAGED,
        _test(
            "in_range",
            "stg_observations",
            "value",
            """SELECT COUNT(*) FROM daily_staged
               WHERE series_id = 'GDP' AND (value < 2000 OR value > 90000)
                  OR series_id = 'DFF' AND value > 50000
                  OR series_id = 'UNRATE' AND (value < 0 OR value > 1000000)""",
        ),
    ),
    "dq_key_nulls": _with(
        EVENTS,
        """SELECT COUNT(*) AS null_count FROM events_silver
           WHERE series_id IS NULL OR value IS NULL""",
    ),
    "dq_orphans": _with(
        GOLD + "," + CATALOGUE,
        """SELECT COUNT(*) AS orphan_count FROM fct_all f
           LEFT JOIN catalogue c ON f.indicator_id = c.series_id WHERE c.series_id IS NULL""",
    ),
    "daily_run": _with(DAILY_RUN, FACT),
    "daily_versions": _with(DAILY_RUN, FACT),
}
