"""SQL texts (DuckDB dialect) that give the same rows as the queries, written independently of them.

Each text is a chain of named steps; :func:`_sql` prefixes a final select with the steps it needs.
"""

from __future__ import annotations

from ..functions import WHITESPACE

_WS = "'" + WHITESPACE + "'"


def _trim(c: str) -> str:
    return f"trim({c}, {_WS})"


def _clean(c: str) -> str:
    return f"nullif({_trim(c)}, '')"


def _timestamp(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^\\s*\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast({c} AS TIMESTAMP) END"


def _station_text(whole: str, base: int, station: str, step: int) -> str:
    return f"concat('{whole}.', lpad(CAST({base} + {station} * {step} AS VARCHAR), 4, '0'))"


_FROM, _TO, _AT = "(l_suppkey % 40)", "((l_partkey + l_suppkey) % 40)", "(user_id % 30)"
_START = "(l_shipdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 86400 AS BIGINT)))"
_END = (
    f"({_START} + to_seconds(CAST((l_partkey * 37 + l_suppkey * 11) % 7200 - 300"
    " + CASE WHEN l_partkey % 53 = 0 THEN 86400 ELSE 0 END AS BIGINT)))"
)

# Each step: name -> (steps it reads, text).
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def _step(name: str, reads: tuple[str, ...], text: str) -> None:
    _STEPS[name] = (reads, text)


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(_STEPS[name][0], seen)
            seen.append(name)
    return seen


def _sql(reads: tuple[str, ...], select: str) -> str:
    steps = ",\n".join(f"{n} AS ({_STEPS[n][1]})" for n in _needed(reads, []))
    return f"WITH {steps}\n{select}" if steps else select


_step(
    "stg",
    (),
    f"""SELECT
  CASE WHEN l_partkey % 97 = 0 THEN '  ' ELSE concat(' R', l_orderkey, '-', l_linenumber) END AS ride_id,
  CASE l_returnflag WHEN 'A' THEN 'electric_bike' WHEN 'N' THEN '' ELSE 'classic_bike' END AS rideable_type,
  CASE WHEN l_partkey % 101 = 0 THEN 'bad' ELSE concat(strftime({_START}, '%Y-%m-%d %H:%M:%S'), '.',
    lpad(CAST(l_orderkey % 1000 AS VARCHAR), 3, '0')) END AS started_at,
  concat(strftime({_END}, '%Y-%m-%d %H:%M:%S'), '.', lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')) AS ended_at,
  concat('Station ', {_FROM}) AS start_station_name,
  CASE WHEN {_FROM} = 39 THEN '' ELSE concat('S', {_FROM}) END AS start_station_id,
  concat('Station ', {_TO}) AS end_station_name,
  concat('S', {_TO}, ' ') AS end_station_id,
  {_station_text('40', 6000, _FROM, 71)} AS start_lat,
  {_station_text('-73', 8000, _FROM, 37)} AS start_lng,
  CASE WHEN l_partkey % 89 = 0 THEN '' ELSE {_station_text('40', 6000, _TO, 71)} END AS end_lat,
  {_station_text('-73', 8000, _TO, 37)} AS end_lng,
  CASE WHEN l_linestatus = 'O' THEN ' Member ' WHEN l_partkey % 83 = 0 THEN 'unknown' ELSE 'CASUAL' END
    AS member_casual,
  strftime(l_shipdate, '%Y-%m-%d') AS trip_date
FROM lineitem""",
)
_step(
    "evs",
    (),
    f"""SELECT
  CASE WHEN event_id % 211 = 0 THEN ' ' ELSE concat('X', {_AT}) END AS station_id,
  CASE WHEN event_id % 223 = 0 THEN NULL ELSE concat(' STATION ', {_AT} + 20, ' ') END AS station_name,
  CAST({_station_text('40', 6000, _AT, 71)} AS DOUBLE) AS lat,
  CAST({_station_text('-73', 8000, _AT, 37)} AS DOUBLE) AS lon,
  CAST(500 AS INTEGER) AS capacity,
  CASE WHEN event_id % 227 = 0 THEN -1 ELSE CAST(floor(value) AS INTEGER) END AS num_bikes_available,
  CAST(500 - floor(value) AS INTEGER) AS num_docks_available,
  CAST(event_id % 20 AS INTEGER) AS num_ebikes_available,
  event_type <> 'error' AS is_installed,
  event_type <> 'signup' AS is_renting,
  event_type <> 'view' AS is_returning,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(event_id * 4 AS BIGINT)) AS event_timestamp
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0) AS delivered""",
)
_step(
    "typed",
    ("stg",),
    f"""SELECT {_clean('ride_id')} AS ride_id, {_clean('rideable_type')} AS rideable_type,
  {_timestamp('started_at')} AS started_at, {_timestamp('ended_at')} AS ended_at,
  {_clean('start_station_name')} AS start_station_name, {_clean('start_station_id')} AS start_station_id,
  {_clean('end_station_name')} AS end_station_name, {_clean('end_station_id')} AS end_station_id,
  try_cast(start_lat AS DOUBLE) AS start_lat, try_cast(start_lng AS DOUBLE) AS start_lng,
  try_cast(end_lat AS DOUBLE) AS end_lat, try_cast(end_lng AS DOUBLE) AS end_lng,
  lower({_trim('member_casual')}) AS member_casual, try_cast(trip_date AS DATE) AS trip_date
FROM stg""",
)
_step(
    "enriched",
    ("typed",),
    """SELECT *,
  round(date_sub('second', started_at, ended_at) / 60.0::DOUBLE, 2) AS ride_duration_minutes,
  CAST(hour(started_at) AS INTEGER) AS ride_hour,
  dayname(started_at) AS ride_day_of_week,
  CAST(month(started_at) AS INTEGER) AS ride_month,
  CAST(year(started_at) AS INTEGER) AS ride_year,
  dayofweek(started_at) IN (0, 6) AS is_weekend,
  CASE WHEN hour(started_at) BETWEEN 5 AND 11 THEN 'Morning'
       WHEN hour(started_at) BETWEEN 12 AND 16 THEN 'Afternoon'
       WHEN hour(started_at) BETWEEN 17 AND 20 THEN 'Evening'
       ELSE 'Night' END AS time_of_day,
  CASE WHEN start_lat BETWEEN -90 AND 90 AND end_lat BETWEEN -90 AND 90
        AND start_lng BETWEEN -180 AND 180 AND end_lng BETWEEN -180 AND 180
       THEN round(2 * 6371.01 * asin(least(1.0::DOUBLE, sqrt(
         power(sin(radians(end_lat - start_lat) / 2), 2)
         + cos(radians(start_lat)) * cos(radians(end_lat)) * power(sin(radians(end_lng - start_lng) / 2), 2)))), 2)
       END AS trip_distance_km
FROM typed""",
)
_step(
    "valid_trips",
    ("enriched",),
    """SELECT * FROM enriched
WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL AND ended_at > started_at
  AND ride_duration_minutes > 0 AND ride_duration_minutes <= 1440
  AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL AND member_casual IN ('member', 'casual')""",
)
_FIRST_RIDE = """QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY started_at NULLS FIRST, ended_at NULLS FIRST,
  start_station_id NULLS FIRST, end_station_id NULLS FIRST, member_casual NULLS FIRST, rideable_type NULLS FIRST,
  end_lat NULLS FIRST, start_station_name NULLS FIRST, end_station_name NULLS FIRST, start_lat NULLS FIRST,
  start_lng NULLS FIRST, end_lng NULLS FIRST, trip_date NULLS FIRST) = 1"""
_step("trips", ("valid_trips",), f"SELECT * FROM valid_trips {_FIRST_RIDE}")
_step(
    "valid_events",
    ("evs",),
    f"""SELECT * FROM evs
WHERE station_id IS NOT NULL AND {_trim('station_id')} <> ''
  AND station_name IS NOT NULL AND {_trim('station_name')} <> ''
  AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND capacity >= 0
  AND num_bikes_available >= 0 AND num_docks_available >= 0 AND event_timestamp IS NOT NULL""",
)
_step(
    "ev",
    ("valid_events",),
    f"""SELECT DISTINCT * REPLACE ({_trim('station_id')} AS station_id, {_trim('station_name')} AS station_name)
FROM valid_events""",
)
_step(
    "batch_ref",
    ("stg",),
    """SELECT id AS batch_station_id, min(name) AS batch_station_name,
  round(avg(lat), 6) AS batch_lat, round(avg(lon), 6) AS batch_lon
FROM (
  SELECT start_station_id AS id, start_station_name AS name,
    try_cast(start_lat AS DOUBLE) AS lat, try_cast(start_lng AS DOUBLE) AS lon FROM stg
  UNION ALL
  SELECT end_station_id, end_station_name, try_cast(end_lat AS DOUBLE), try_cast(end_lng AS DOUBLE) FROM stg
) AS sides
WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY id""",
)
_REASONS = """concat_ws(', ',
  CASE WHEN station_id IS NULL OR station_id = '' THEN 'station_id is empty' END,
  CASE WHEN num_bikes_available < 0 THEN 'num_bikes_available is negative' END,
  CASE WHEN num_docks_available < 0 THEN 'num_docks_available is negative' END)"""
_step("checked", ("evs",), f"SELECT *, {_REASONS} AS reasons FROM evs")
_step(
    "stream_ref",
    ("checked",),
    """SELECT station_id AS stream_station_id, station_name AS stream_station_name,
  lat AS stream_lat, lon AS stream_lon, CAST(capacity AS BIGINT) AS capacity
FROM checked WHERE reasons = '' AND station_id IS NOT NULL AND station_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY event_timestamp DESC, station_name DESC, lat DESC, lon DESC)
  = 1""",
)
_step(
    "mapping",
    ("batch_ref", "stream_ref"),
    f"""SELECT coalesce(batch_station_id, 'NO MATCH BATCH') AS batch_station_id,
  coalesce(batch_station_name, 'NO MATCH BATCH') AS batch_station_name,
  coalesce(stream_station_id, 'NO STREAM MATCH') AS stream_station_id,
  coalesce(stream_station_name, 'NO STREAM MATCH') AS stream_station_name,
  batch_lat, batch_lon, stream_lat, stream_lon
FROM batch_ref FULL OUTER JOIN stream_ref
  ON lower({_trim('batch_station_name')}) = lower({_trim('stream_station_name')})""",
)

# Means and ratios are rounded half-up in whole hundredths.
_MEAN = (
    "(2 * CAST(sum(CAST(round(ride_duration_minutes * 100) AS BIGINT)) AS BIGINT) + count(ride_duration_minutes))"
    " // (2 * count(ride_duration_minutes)) / 100.0::DOUBLE"
)


def _percent(a: str, b: str) -> str:
    return f"(20000 * CAST({a} AS BIGINT) + CAST({b} AS BIGINT)) // (2 * CAST({b} AS BIGINT)) / 100.0::DOUBLE"


_step(
    "daily",
    ("trips",),
    f"""SELECT d.*, p.peak_hour FROM (
  SELECT trip_date, count(*) AS total_trips, {_MEAN} AS avg_ride_duration_minutes,
    count(DISTINCT start_station_id) AS active_start_station_count,
    count(DISTINCT end_station_id) AS active_end_station_count
  FROM trips GROUP BY trip_date) AS d
LEFT JOIN (
  SELECT trip_date, ride_hour AS peak_hour
  FROM (SELECT trip_date, ride_hour, count(*) AS n FROM trips GROUP BY trip_date, ride_hour) AS h
  QUALIFY row_number() OVER (PARTITION BY trip_date ORDER BY n DESC, ride_hour) = 1) AS p
ON d.trip_date = p.trip_date""",
)
_step(
    "sides",
    ("trips",),
    """SELECT start_station_id AS station_id, trip_date, ride_hour AS activity_hour, 'START' AS kind FROM trips
UNION ALL
SELECT end_station_id, trip_date, CAST(hour(ended_at) AS INTEGER), 'END' FROM trips""",
)
_step(
    "stations",
    ("sides", "mapping"),
    """SELECT s.station_id, coalesce(m.batch_station_name, m.stream_station_name) AS station_name,
  s.start_trip_count, s.end_trip_count, s.total_station_activity, s.avg_daily_activity, p.peak_hour
FROM (
  SELECT station_id, count(*) FILTER (kind = 'START') AS start_trip_count,
    count(*) FILTER (kind = 'END') AS end_trip_count, count(*) AS total_station_activity,
    (200 * count(*) + count(DISTINCT trip_date)) // (2 * count(DISTINCT trip_date)) / 100.0::DOUBLE
      AS avg_daily_activity
  FROM sides WHERE station_id IS NOT NULL GROUP BY station_id) AS s
LEFT JOIN mapping AS m ON s.station_id = m.batch_station_id
LEFT JOIN (
  SELECT station_id, activity_hour AS peak_hour
  FROM (SELECT station_id, activity_hour, count(*) AS n FROM sides WHERE station_id IS NOT NULL
        GROUP BY station_id, activity_hour) AS h
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY n DESC, activity_hour) = 1) AS p
ON s.station_id = p.station_id""",
)
_step(
    "station_users",
    ("trips",),
    f"""SELECT start_station_id AS station_id, start_station_name AS station_name,
  count(*) FILTER (member_casual = 'member') AS member_trips,
  count(*) FILTER (member_casual = 'casual') AS casual_trips,
  count(*) AS total_trips,
  {_percent("count(*) FILTER (member_casual = 'member')", 'count(*)')} AS member_percentage,
  {_percent("count(*) FILTER (member_casual = 'casual')", 'count(*)')} AS casual_percentage
FROM trips WHERE start_station_id IS NOT NULL GROUP BY start_station_id, start_station_name""",
)
_step(
    "user_types",
    ("trips",),
    f"""SELECT member_casual, count(*) AS total_trips,
  {_percent('count(*)', 'sum(count(*)) OVER ()')} AS trip_percentage, {_MEAN} AS avg_ride_duration_minutes
FROM trips WHERE member_casual IS NOT NULL GROUP BY member_casual""",
)
_step(
    "latest",
    ("ev",),
    """SELECT * FROM ev
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY event_timestamp DESC) = 1""",
)
_step(
    "monitoring",
    ("ev",),
    """SELECT *, CASE WHEN time_diff_seconds <= 60 AND bikes_difference >= 50 THEN 'ANOMALY BIKE DROPS'
  ELSE 'NORMAL' END AS anomaly_status
FROM (
  SELECT station_id, station_name, num_bikes_available, previous_bikes_available,
    previous_bikes_available - num_bikes_available AS bikes_difference,
    num_docks_available, previous_docks_available,
    previous_docks_available - num_docks_available AS docks_difference,
    date_sub('second', previous_event_timestamp, event_timestamp) AS time_diff_seconds, event_timestamp
  FROM (
    SELECT *, lag(num_bikes_available) OVER w AS previous_bikes_available,
      lag(num_docks_available) OVER w AS previous_docks_available,
      lag(event_timestamp) OVER w AS previous_event_timestamp
    FROM ev WINDOW w AS (PARTITION BY station_id ORDER BY event_timestamp)) AS h) AS c""",
)


def _json_field(name: str, value: str) -> str:
    return f"'\"{name}\":', coalesce({value}, 'null')"


def _json_text(name: str) -> str:
    return _json_field(name, f"'\"' || {name} || '\"'")


def _json_plain(name: str) -> str:
    return _json_field(name, f"CAST({name} AS VARCHAR)")


_JSON = ", ',', ".join(
    [
        _json_text("station_id"),
        _json_text("station_name"),
        *[
            _json_plain(c)
            for c in (
                "lat",
                "lon",
                "capacity",
                "num_bikes_available",
                "num_docks_available",
                "num_ebikes_available",
                "is_installed",
                "is_renting",
                "is_returning",
            )
        ],
        _json_field("event_timestamp", "'\"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || '\"'"),
    ]
)
_VALID = "SELECT * EXCLUDE (reasons) FROM checked WHERE reasons = ''"
_INVALID = (
    "SELECT station_id, reasons AS error_reason, "
    f"concat('{{', {_JSON}, '}}') AS raw_payload, event_timestamp FROM checked WHERE reasons <> ''"
)

_step(
    "feed",
    (),
    """SELECT event_id, CAST(user_id AS VARCHAR) AS station_id, s_name AS station_name, s_acctbal AS lat,
  -s_acctbal AS lon, s_nationkey AS capacity,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS num_bikes_available,
  CAST(500 - floor(value) AS INTEGER) AS num_docks_available,
  CAST(event_id % 20 AS INTEGER) AS num_ebikes_available,
  event_id % 2 = 1 AS is_installed, event_type <> 'view' AS is_renting, event_type <> 'signup' AS is_returning,
  date_trunc('millisecond', ts) AS event_timestamp
FROM events LEFT JOIN supplier ON user_id = s_suppkey""",
)
_step(
    "history",
    (),
    """SELECT *, lag(value) OVER w AS previous_value,
  lag(event_type) OVER w AS previous_event_type, lag(ts) OVER w AS previous_ts
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)


def _count_row(subject: str, source: str) -> str:
    return (
        f"SELECT 'rows' AS \"check\", '{subject}' AS subject, 'count' AS metric, count(*) AS value, "
        f"count(*) >= 1 AS passed FROM {source}"
    )


_TRIP_RULES = {
    "invalid_ride_id": "ride_id IS NULL OR ride_id = ''",
    "invalid_started_at": "started_at IS NULL",
    "invalid_ended_at": "ended_at IS NULL",
    "invalid_start_station": "start_station_id IS NULL OR start_station_id = ''",
    "invalid_end_station": "end_station_id IS NULL OR end_station_id = ''",
}
_LANDED_TIME = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
_LINE_ORDER = "l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"

# Batch and stream follow one rule for equal times: the greater remaining columns, here the event id.
_LATEST = """SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) = 1"""


def _null_profile(subject: str, source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT 'invalid values' AS \"check\", '{subject}' AS subject, '{metric}' AS metric, "
        f"count(*) FILTER ({rule}) AS value, count(*) FILTER ({rule}) = 0 AS passed FROM {source}"
        for metric, rule in _TRIP_RULES.items()
    )


ORACLES: dict[str, str] = {
    "fact_trips_cleaned": _sql(("trips",), "SELECT * FROM trips"),
    "fact_trips_one_day": _sql(
        ("valid_trips",), f"SELECT * FROM valid_trips WHERE trip_date = DATE '1996-06-15' {_FIRST_RIDE}"
    ),
    "fact_events_cleaned": _sql(("ev",), "SELECT * FROM ev"),
    "events_valid": _sql(("checked",), _VALID),
    "events_invalid": _sql(("checked",), _INVALID),
    "dim_batch_station_reference": _sql(("batch_ref",), "SELECT * FROM batch_ref"),
    "dim_stream_station_reference": _sql(("stream_ref",), "SELECT * FROM stream_ref"),
    "dim_station_mapping": _sql(("mapping",), "SELECT * FROM mapping"),
    "mart_daily_trip_summary": _sql(("daily",), "SELECT * FROM daily"),
    "mart_latest_station_status": _sql(("latest",), "SELECT * FROM latest"),
    "mart_station_anomaly": _sql(("monitoring",), "SELECT * FROM monitoring"),
    "mart_station_summary": _sql(("stations",), "SELECT * FROM stations"),
    "mart_station_user_summary": _sql(("station_users",), "SELECT * FROM station_users"),
    "mart_user_type_summary": _sql(("user_types",), "SELECT * FROM user_types"),
    "q_monthly_trend": _sql(
        ("daily",),
        "SELECT CAST(date_trunc('month', trip_date) AS DATE) AS trip_month, "
        "CAST(sum(total_trips) AS BIGINT) AS total_trips FROM daily GROUP BY 1",
    ),
    "q_top_stations": _sql(
        ("stations",), "SELECT * FROM stations ORDER BY total_station_activity DESC, station_id LIMIT 10"
    ),
    "q_bikes_available": _sql(
        ("latest",), "SELECT CAST(sum(num_bikes_available) AS BIGINT) AS bikes_available FROM latest"
    ),
    "q_active_stations": _sql(
        ("latest",),
        "SELECT count(*) FILTER (is_installed AND is_renting AND is_returning) AS active_stations FROM latest",
    ),
    "q_anomalies_by_station": _sql(
        ("monitoring",),
        "SELECT station_id, count(*) AS anomalies FROM monitoring "
        "WHERE anomaly_status = 'ANOMALY BIKE DROPS' GROUP BY station_id",
    ),
    "dq_source_rows": _count_row(
        "orders",
        "orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'",
    ),
    "dq_row_counts": _sql(
        ("stg", "evs", "trips", "ev", "mapping"),
        "\nUNION ALL ".join(
            _count_row(subject, step)
            for subject, step in (
                ("staging_trips", "stg"),
                ("staging_events", "evs"),
                ("fact_trips_cleaned", "trips"),
                ("fact_events_cleaned", "ev"),
                ("dim_station_mapping", "mapping"),
            )
        ),
    ),
    "dq_mart_counts": _sql(
        ("daily", "latest", "monitoring", "stations", "station_users", "user_types"),
        "\nUNION ALL ".join(
            _count_row(subject, step)
            for subject, step in (
                ("mart_daily_trip_summary", "daily"),
                ("mart_latest_station_status", "latest"),
                ("mart_station_anomaly", "monitoring"),
                ("mart_station_summary", "stations"),
                ("mart_station_user_summary", "station_users"),
                ("mart_user_type_summary", "user_types"),
            )
        ),
    ),
    "dq_duplicates": _sql(
        ("typed",), "SELECT ride_id, count(*) AS total FROM typed GROUP BY ride_id HAVING count(*) > 1"
    ),
    "dq_unique_ride": _sql(
        ("trips",),
        "SELECT 'duplicates' AS \"check\", 'fact_trips_cleaned' AS subject, 'ride_id' AS metric, "
        "count(*) AS value, count(*) = 0 AS passed "
        "FROM (SELECT ride_id FROM trips GROUP BY ride_id HAVING count(*) > 1) AS d",
    ),
    "dq_null_profile": _sql(("typed",), _null_profile("staging_trips", "typed")),
    "dq_fact_null_profile": _sql(("trips",), _null_profile("fact_trips_cleaned", "trips")),
    "dq_fact_duplicates": _sql(
        ("trips",), "SELECT ride_id, count(*) AS total FROM trips GROUP BY ride_id HAVING count(*) > 1"
    ),
    "blank_to_null_fold": _sql(
        ("stg",),
        f"""SELECT {_clean('ride_id')} AS ride_id, {_clean('rideable_type')} AS rideable_type,
  {_clean('start_station_id')} AS start_station_id, {_clean('end_station_id')} AS end_station_id,
  lower({_trim('member_casual')}) AS member_casual,
  coalesce({_clean('rideable_type')}, 'unspecified') AS rideable_label, trip_date FROM stg""",
    ),
    "safe_cast": _sql(
        ("stg",),
        f"""SELECT ride_id, {_timestamp('started_at')} AS started_at, {_timestamp('ended_at')} AS ended_at,
  try_cast(end_lat AS DOUBLE) AS end_lat, try_cast(rideable_type AS DOUBLE) AS not_a_number,
  try_cast(substr(trip_date, 1, 4) AS BIGINT) AS year, CAST(NULL AS BIGINT) AS not_a_long,
  try_cast(trip_date AS DATE) AS trip_date FROM stg""",
    ),
    "trip_enrich": _sql(
        ("enriched",),
        "SELECT * FROM enriched",
    ),
    "valid_trips_only": _sql(
        ("valid_trips",),
        """SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
  end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual, trip_date
FROM valid_trips""",
    ),
    "valid_events_only": _sql(("valid_events",), "SELECT * FROM valid_events"),
    "dedupe_first_line": "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY l_shipdate, l_partkey, {_LINE_ORDER}) = 1",
    "dedupe_event": _sql(("evs",), "SELECT DISTINCT * FROM evs"),
    "latest_per_user": _LATEST,
    "peak_hour_per_user": """SELECT user_id, peak_hour, n
FROM (SELECT user_id, CAST(hour(ts) AS INTEGER) AS peak_hour, count(*) AS n FROM events GROUP BY 1, 2) AS h
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, peak_hour) = 1""",
    "previous_per_user": _sql(("history",), "SELECT * FROM history"),
    "drop_per_user": _sql(
        ("history",),
        """SELECT event_id, user_id, date_sub('second', previous_ts, ts) AS time_diff_seconds,
  round(previous_value - value, 2) AS value_drop,
  CASE WHEN date_sub('second', previous_ts, ts) <= 3600 AND previous_value - value >= 50
    THEN 'ANOMALY' ELSE 'NORMAL' END AS anomaly_status
FROM history""",
    ),
    "share_of_orders": f"""SELECT o_orderstatus, count(*) AS n,
  {_percent('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM orders GROUP BY o_orderstatus""",
    "count_distinct_orders": """SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers,
  count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_orderstatus""",
    "count_if_lines": """SELECT l_returnflag, l_linestatus, count(*) FILTER (l_discount > 0.05) AS discounted,
  count(*) FILTER (l_quantity >= 30) AS bulk, count(*) FILTER (l_partkey % 2 = 1) AS odd_part
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "top_customers": """SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey
ORDER BY orders DESC, o_custkey LIMIT 10""",
    "unpivot_sides": _sql(
        ("stg",),
        """SELECT ride_id, 'START' AS activity_type, start_station_id AS station_id,
  start_station_name AS station_name FROM stg
UNION ALL SELECT ride_id, 'END', end_station_id, end_station_name FROM stg""",
    ),
    "full_outer_fold": f"""SELECT c_custkey, s_suppkey, coalesce(c_label, 'NO CUSTOMER') AS c_label,
  coalesce(s_label, 'NO SUPPLIER') AS s_label
FROM (SELECT c_custkey, concat(' Key ', c_custkey) AS c_label FROM customer) AS c
FULL OUTER JOIN (SELECT s_suppkey, concat('KEY ', s_suppkey * 20, chr(9)) AS s_label FROM supplier) AS s
ON lower({_trim('c_label')}) = lower({_trim('s_label')})""",
    "enrich_status": _sql(("feed",), "SELECT * FROM feed"),
    "inject_faults_feed": _sql(
        ("feed",),
        """SELECT * EXCLUDE (position) REPLACE (
  CASE WHEN position % 20 = 0 AND position // 20 % 3 = 0 THEN '' ELSE station_id END AS station_id,
  CASE WHEN position % 20 = 0 AND position // 20 % 3 = 1 THEN -1
       WHEN position % 20 <> 0 AND position % 15 = 0 THEN 0 ELSE num_bikes_available END AS num_bikes_available,
  CASE WHEN position % 20 = 0 AND position // 20 % 3 = 2 THEN -1 ELSE num_docks_available END
    AS num_docks_available)
FROM (SELECT *, event_id % 500 + 1 AS position FROM feed) AS p""",
    ),
    "medallion_fact_trips": _sql(("trips",), "SELECT * FROM trips"),
    "medallion_fact_events": _sql(("ev",), "SELECT * FROM ev"),
    "medallion_mapping": _sql(("mapping",), "SELECT * FROM mapping"),
    "raw_drop_load": _sql(
        ("stg",),
        f"""SELECT ride_id, CASE WHEN rideable_type <> '' THEN rideable_type END AS rideable_type, started_at, ended_at,
  start_station_name, nullif(start_station_id, '') AS start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng, member_casual
FROM (SELECT * EXCLUDE (trip_date) REPLACE (trim(ride_id) AS ride_id, {_timestamp('started_at')} AS started_at,
        {_timestamp('ended_at')} AS ended_at, try_cast(start_lat AS DOUBLE) AS start_lat,
        try_cast(start_lng AS DOUBLE) AS start_lng, try_cast(end_lat AS DOUBLE) AS end_lat,
        try_cast(end_lng AS DOUBLE) AS end_lng, trim(end_station_id) AS end_station_id,
        trim(member_casual) AS member_casual) FROM stg WHERE trim(ride_id) <> ''
  QUALIFY row_number() OVER (PARTITION BY stg.ride_id ORDER BY stg.rideable_type, stg.started_at, stg.ended_at,
    stg.start_station_name, stg.start_station_id, stg.end_station_name, stg.end_station_id, stg.start_lat,
    stg.start_lng, stg.end_lat, stg.end_lng, stg.member_casual) = 1) AS t""",
    ),
    "raw_drop_ledger": _sql(
        ("stg",),
        f"""SELECT ride_id, CASE WHEN rideable_type <> '' THEN rideable_type END AS rideable_type, started_at, ended_at,
  start_station_name, nullif(start_station_id, '') AS start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng, member_casual
FROM (SELECT * EXCLUDE (trip_date) REPLACE (trim(ride_id) AS ride_id, {_timestamp('started_at')} AS started_at,
        {_timestamp('ended_at')} AS ended_at, try_cast(start_lat AS DOUBLE) AS start_lat,
        try_cast(start_lng AS DOUBLE) AS start_lng, try_cast(end_lat AS DOUBLE) AS end_lat,
        try_cast(end_lng AS DOUBLE) AS end_lng, trim(end_station_id) AS end_station_id,
        trim(member_casual) AS member_casual) FROM stg WHERE trim(ride_id) <> ''
  QUALIFY row_number() OVER (PARTITION BY stg.ride_id ORDER BY stg.rideable_type, stg.started_at, stg.ended_at,
    stg.start_station_name, stg.start_station_id, stg.end_station_name, stg.end_station_id, stg.start_lat,
    stg.start_lng, stg.end_lat, stg.end_lng, stg.member_casual) = 1) AS t""",
    ),
    "station_feed_rows": """SELECT CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY CAST(s_suppkey AS VARCHAR))
  AS INTEGER) AS position, CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, s_acctbal AS lat, -s_acctbal AS lon,
  CAST(s_nationkey AS INTEGER) AS capacity FROM supplier""",
    "append_new_lines": f"""WITH lines AS (
  SELECT *, concat(l_orderkey, '-', l_linenumber) AS line_key FROM lineitem),
stored AS (
  SELECT * FROM lines WHERE l_partkey % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1)
SELECT * FROM stored
UNION ALL
SELECT * FROM (
  SELECT * FROM lines WHERE l_partkey % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY l_shipdate, l_partkey, {_LINE_ORDER}) = 1) AS fresh
WHERE line_key NOT IN (SELECT line_key FROM stored)""",
    "extract_range_orders": "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' "
    "AND o_orderdate < TIMESTAMP '1998-01-01' ORDER BY o_orderdate",
    "order_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' ORDER BY order_date",
    "daily_csv_roundtrip": _sql(
        ("stg",),
        f"""SELECT ride_id, rideable_type, {_LANDED_TIME.format(c='started')} AS started_at,
  coalesce({_LANDED_TIME.format(c='ended')}, '') AS ended_at,
  start_station_name, start_station_id, end_station_name, end_station_id,
  coalesce(CAST(try_cast(start_lat AS DOUBLE) AS VARCHAR), '') AS start_lat,
  coalesce(CAST(try_cast(start_lng AS DOUBLE) AS VARCHAR), '') AS start_lng,
  coalesce(CAST(try_cast(end_lat AS DOUBLE) AS VARCHAR), '') AS end_lat,
  coalesce(CAST(try_cast(end_lng AS DOUBLE) AS VARCHAR), '') AS end_lng,
  member_casual, CAST(CAST(started AS DATE) AS VARCHAR) AS trip_date
FROM (SELECT *, {_timestamp('started_at')} AS started, {_timestamp('ended_at')} AS ended FROM stg) AS raw
WHERE started IS NOT NULL""",
    ),
    "validate_reasons": _sql(
        ("evs",),
        f"""SELECT station_id, num_bikes_available, num_docks_available, event_timestamp,
  nullif({_REASONS}, '') AS error_reason
FROM (SELECT * REPLACE (trim(station_id) AS station_id,
        CASE WHEN num_ebikes_available = 7 THEN -1 ELSE num_docks_available END AS num_docks_available)
      FROM evs) AS spoiled""",
    ),
    "decode_payload": _sql(("evs",), "SELECT * FROM evs"),
    "decode_corrupt": _sql(
        ("checked",),
        f"""SELECT * FROM (
  SELECT CASE WHEN kind IN (1, 2) THEN 'payload is undecodable'
              WHEN kind = 3 THEN concat_ws(', ', nullif(reasons, ''), 'is_renting is missing')
              ELSE reasons END AS error_reason,
    CASE WHEN kind = 1 THEN substring(message, 1, 40)
         WHEN kind = 2 THEN regexp_replace(message, '"num_bikes_available":-?[0-9]+', '"num_bikes_available":"abc"')
         WHEN kind = 3 THEN regexp_replace(message, ',"is_renting":(true|false)', '')
         ELSE message END AS raw_payload
  FROM (SELECT reasons, concat('{{', {_JSON}, '}}') AS message, CAST(epoch(event_timestamp) AS BIGINT) // 4 % 10 AS kind
        FROM checked) AS m) AS s
WHERE error_reason <> ''""",
    ),
    "stream_split_valid": _sql(("checked",), _VALID),
    "stream_split_invalid": _sql(("checked",), _INVALID),
    "stream_dedupe": _sql(("evs",), "SELECT DISTINCT * FROM evs"),
    "stream_dedupe_indexed": "SELECT * FROM events",
    "stream_latest": _LATEST,
    "stream_drops": _sql(("monitoring",), "SELECT * FROM monitoring"),
    "stream_drops_late": _sql(("monitoring",), "SELECT * FROM monitoring"),
    "stream_split_compacted": _sql(("checked",), _VALID),
    "stream_quarantine_compacted": _sql(("checked",), _INVALID),
    "feed_stream_events": """WITH polled AS (
  SELECT event_id % 6 AS poll, CAST(user_id AS VARCHAR) AS station_id, user_id, max(CAST(floor(value) AS INTEGER)) AS bikes,
    count(*) AS n, sum(event_id) % 20 AS ebikes FROM events GROUP BY 1, 2, 3),
placed AS (
  SELECT *, TIMESTAMP '2024-03-01' + to_minutes(CAST(5 * poll AS INTEGER)) AS taken,
    row_number() OVER (PARTITION BY poll ORDER BY station_id) AS position FROM polled)
SELECT CASE WHEN position % 20 = 0 AND position // 20 % 3 = 0 THEN '' ELSE station_id END AS station_id,
  s_name || CASE WHEN poll > 2 THEN ' B' ELSE '' END AS station_name, s_acctbal AS lat, -s_acctbal AS lon,
  CAST(s_nationkey AS INTEGER) AS capacity,
  CAST(CASE WHEN position % 20 = 0 AND position // 20 % 3 = 1 THEN -1
       WHEN position % 20 <> 0 AND position % 15 = 0 THEN 0 ELSE bikes END AS INTEGER) AS num_bikes_available,
  CAST(CASE WHEN position % 20 = 0 AND position // 20 % 3 = 2 THEN -1
       WHEN n % 7 = 0 THEN 0 ELSE n END AS INTEGER) AS num_docks_available,
  CAST(ebikes AS INTEGER) AS num_ebikes_available, n % 2 = 1 AS is_installed, user_id % 3 <> 0 AS is_renting,
  true AS is_returning, taken AS event_timestamp
FROM placed LEFT JOIN supplier ON user_id = s_suppkey AND (poll <= 2 OR s_suppkey % 7 <> 0)""",
    "published_fact_trips": _sql(("trips",), "SELECT * FROM trips"),
    "mart_daily_incremental": _sql(("daily",), "SELECT * FROM daily"),
    "mart_station_incremental": _sql(("stations",), "SELECT * FROM stations"),
    "mart_station_user_incremental": _sql(("station_users",), "SELECT * FROM station_users"),
    "mart_user_type_incremental": _sql(("user_types",), "SELECT * FROM user_types"),
    "dq_observed": _sql(
        ("typed",), f"{_count_row('staging_trips', 'typed')}\nUNION ALL {_null_profile('staging_trips', 'typed')}"
    ),
    "distinct_stations_sketch": _sql(
        ("trips",),
        """SELECT CAST(date_trunc('month', trip_date) AS DATE) AS trip_month,
  count(DISTINCT start_station_id) AS stations, count(DISTINCT ride_id) AS rides,
  true AS stations_near, true AS rides_near
FROM trips WHERE trip_date IS NOT NULL GROUP BY 1""",
    ),
    "mart_station_anomaly_bucketed": _sql(("monitoring",), "SELECT * FROM monitoring"),
    "view_daily_trips": _sql(("daily",), "SELECT * FROM daily"),
    "stream_drops_repaired": _sql(("monitoring",), "SELECT * FROM monitoring"),
}
