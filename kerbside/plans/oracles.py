"""The same queries as DuckDB SQL over the same parquet tables."""


def _r(expression, digits):
    """Round half up on the decimal value, as Spark does."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


_EVENT_COLUMNS = """
    event_id AS row_seq,
    'TRF-' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(6, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') AS violation_id,
    CASE WHEN event_id % 101 = 0 THEN 'not-a-date' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE event_id % 10
        WHEN 0 THEN 'Speeding' WHEN 1 THEN ' speeding' WHEN 2 THEN 'RED-LIGHT' WHEN 3 THEN 'DUI'
        WHEN 4 THEN 'illegal park' WHEN 5 THEN 'Reckless' WHEN 6 THEN 'Mobile Use' WHEN 7 THEN 'No Seatbelt'
        WHEN 8 THEN 'Jaywalking' ELSE CASE WHEN event_id % 70 = 9 THEN NULL ELSE 'Speeding' END END AS violation_type,
    CASE user_id % 8
        WHEN 0 THEN 'Downtown' WHEN 1 THEN ' highway ' WHEN 2 THEN 'SCHOOL' WHEN 3 THEN 'School Zone'
        WHEN 4 THEN 'Residential' WHEN 5 THEN 'industrial' WHEN 6 THEN 'Airport'
        ELSE CASE WHEN event_id % 33 = 0 THEN NULL ELSE 'Downtown' END END AS zone,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END AS speed_kmh,
    CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 499 = 0 THEN CAST(9000 AS DOUBLE)
        ELSE CAST(75 + 25 * (event_id % 37) AS DOUBLE) END AS fine_amount,
    CASE user_id % 6 WHEN 0 THEN 'car' WHEN 1 THEN 'Truck' WHEN 2 THEN 'Motorcycle' WHEN 3 THEN ' bus'
        WHEN 4 THEN 'VAN' ELSE NULL END AS vehicle_type,
    CASE WHEN event_id % 50 = 7 THEN NULL
        ELSE 'OFF-' || lpad(CAST(user_id % 49 + 1 AS VARCHAR), 3, '0') END AS officer_id,
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(28400 + event_id % 500 AS DOUBLE) / 1000 END AS latitude,
    CAST(77000 + user_id % 400 AS DOUBLE) / 1000 AS longitude"""

_RAW = f"""raw AS (
    SELECT {_EVENT_COLUMNS} FROM events
    UNION ALL
    SELECT {_EVENT_COLUMNS} FROM events WHERE event_id % 40 = 0)"""

_TYPE = """CASE lower(trim(violation_type))
    WHEN 'speeding' THEN 'Speeding' WHEN 'red-light' THEN 'Red-Light' WHEN 'dui' THEN 'DUI'
    WHEN 'illegal park' THEN 'Illegal Park' WHEN 'reckless' THEN 'Reckless' WHEN 'mobile use' THEN 'Mobile Use'
    WHEN 'no seatbelt' THEN 'No Seatbelt' ELSE 'Unknown' END"""
_ZONE = """CASE lower(trim(zone))
    WHEN 'downtown' THEN 'Downtown' WHEN 'highway' THEN 'Highway' WHEN 'school zone' THEN 'School Zone'
    WHEN 'school' THEN 'School Zone' WHEN 'residential' THEN 'Residential' WHEN 'industrial' THEN 'Industrial'
    ELSE 'Unknown' END"""
_VEHICLE = "upper(substr(trim(vehicle_type), 1, 1)) || lower(substr(trim(vehicle_type), 2))"
_SEVERITY = """CASE
    WHEN violation_type IN ('DUI', 'Reckless', 'Red-Light') THEN 'High'
    WHEN violation_type = 'Speeding' AND speed_kmh > 30 THEN 'High'
    WHEN violation_type = 'Speeding' AND speed_kmh BETWEEN 15 AND 30 THEN 'Medium'
    WHEN violation_type = 'Mobile Use' THEN 'Medium' ELSE 'Low' END"""
_TIME = """CAST(hour("timestamp") AS INTEGER) AS hour, dayname("timestamp") AS day_of_week,
    coalesce(isodow("timestamp") >= 6, false) AS is_weekend,
    coalesce(hour("timestamp") BETWEEN 7 AND 9 OR hour("timestamp") BETWEEN 17 AND 19, false) AS is_peak"""

_PREPARED = f"""typed AS (
    SELECT row_seq, violation_id, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", {_TYPE} AS violation_type,
        {_ZONE} AS zone, speed_kmh, fine_amount, {_VEHICLE} AS vehicle_type, officer_id, latitude, longitude FROM raw),
prepared AS (SELECT *, {_TIME}, {_SEVERITY} AS severity FROM typed)"""

_CLEAN = f"""firsts AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY violation_id ORDER BY row_seq) AS rn FROM raw)
    WHERE rn = 1 AND violation_type IS NOT NULL AND zone IS NOT NULL AND "timestamp" IS NOT NULL),
rows AS (
    SELECT row_seq, violation_id, "timestamp", {_TYPE} AS violation_type, {_ZONE} AS zone, speed_kmh, fine_amount,
        {_VEHICLE} AS vehicle_type, officer_id, latitude, longitude FROM firsts),
filled AS (
    SELECT r.*, coalesce(r.fine_amount, gf.m) AS fine1, coalesce(r.speed_kmh, gs.m, 0.0) AS speed1
    FROM rows r
    LEFT JOIN (SELECT zone, violation_type, median(fine_amount) AS m FROM rows GROUP BY ALL) gf
        ON r.zone = gf.zone AND r.violation_type = gf.violation_type
    LEFT JOIN (SELECT violation_type, median(speed_kmh) AS m FROM rows GROUP BY ALL) gs
        ON r.violation_type = gs.violation_type),
vehicle AS (SELECT vehicle_type AS v FROM rows WHERE vehicle_type IS NOT NULL
    GROUP BY vehicle_type ORDER BY count(*) DESC, vehicle_type LIMIT 1),
middles AS (SELECT median(latitude) AS lat, median(longitude) AS lon FROM rows),
fines AS (SELECT median(fine1) AS m FROM filled),
capped AS (
    SELECT row_seq, violation_id, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", violation_type, zone,
        least(greatest(speed1, 0.0), 200.0) AS speed_kmh,
        least(greatest(coalesce(fine1, fines.m), 0.0), 5000.0) AS fine_amount,
        coalesce(vehicle_type, (SELECT v FROM vehicle), 'Unknown') AS vehicle_type,
        coalesce(officer_id, 'UNKNOWN') AS officer_id,
        coalesce(latitude, middles.lat) AS latitude, coalesce(longitude, middles.lon) AS longitude
    FROM filled, middles, fines),
fences AS (SELECT quantile_cont(fine_amount, 0.25) AS q1, quantile_cont(fine_amount, 0.75) AS q3 FROM capped),
clean AS (
    SELECT capped.*,
        NOT coalesce(fine_amount BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1), false) AS fine_is_outlier,
        {_TIME}, {_SEVERITY} AS severity
    FROM capped, fences)"""

_RISK = f"""ranked AS (
    SELECT *, (rank() OVER (ORDER BY fine_amount) + (count(*) OVER (PARTITION BY fine_amount) - 1) / 2.0)
            / count(fine_amount) OVER () AS pct,
        max(speed_kmh) OVER () AS top FROM clean),
scored AS (
    SELECT * EXCLUDE (pct, top),
        (speed_kmh - min(speed_kmh) OVER ()) / (max(speed_kmh) OVER () - min(speed_kmh) OVER ()) AS speed_norm,
        (fine_amount - min(fine_amount) OVER ()) / (max(fine_amount) OVER () - min(fine_amount) OVER ()) AS fine_norm,
        {_r("CASE severity WHEN 'High' THEN 50.0 WHEN 'Medium' THEN 25.0 WHEN 'Low' THEN 5.0 ELSE 0 END"
            " + speed_kmh / CASE WHEN top = 0 THEN 1 ELSE top END * 30 + pct * 20", 1)} AS risk_score
    FROM ranked)"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


_ON_RAW = _with(_RAW)
_ON_PREPARED = _with(_RAW, _PREPARED)
_ON_CLEAN = _with(_RAW, _CLEAN)
_ON_SCORED = _with(_RAW, _CLEAN, _RISK)
_ON_BOTH = _with(_RAW, _PREPARED, _CLEAN)

ORACLES = {}

# --- conform ------------------------------------------------------------------

ORACLES["drop_all_null"] = _ON_RAW + """
SELECT row_seq, speed_kmh, fine_amount, vehicle_type FROM raw
WHERE speed_kmh IS NOT NULL OR fine_amount IS NOT NULL OR vehicle_type IS NOT NULL"""

ORACLES["header_normalise"] = _ON_RAW + """
SELECT violation_id, violation_type, zone, speed_kmh, fine_amount, latitude, longitude FROM raw"""

ORACLES["cast_contract"] = _ON_RAW + """
SELECT row_seq, violation_id, "timestamp", trim(violation_type) AS violation_type, trim(zone) AS zone,
    CASE WHEN row_seq % 13 = 0 OR row_seq % 29 = 0 THEN NULL ELSE speed_kmh END AS speed_kmh,
    fine_amount, trim(vehicle_type) AS vehicle_type, CAST(NULL AS VARCHAR) AS officer_id,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM raw"""

ORACLES["provenance"] = _ON_RAW + """
SELECT violation_id, zone, '2024-01-31T00:00:00' AS ingested_at,
    substr(md5('2024-01-31T00:00:00'), 1, 8) AS pipeline_run FROM raw"""

ORACLES["union_by_name"] = _ON_RAW + """
SELECT violation_id, zone, fine_amount FROM raw UNION ALL SELECT violation_id, zone, NULL FROM raw"""

ORACLES["dedup_exact"] = _ON_RAW + "SELECT DISTINCT * FROM raw"

ORACLES["dedup_keep_first"] = _ON_RAW + """
SELECT officer_id, row_seq, violation_id, zone FROM (
    SELECT *, row_number() OVER (PARTITION BY officer_id ORDER BY row_seq, violation_id) AS rn FROM raw) WHERE rn = 1"""

ORACLES["drop_required_nulls"] = _ON_RAW + """
SELECT * FROM raw WHERE violation_type IS NOT NULL AND zone IS NOT NULL AND "timestamp" IS NOT NULL"""

ORACLES["standardise_categories"] = _ON_RAW + f"""
SELECT row_seq, {_TYPE} AS violation_type, {_ZONE} AS zone, {_VEHICLE} AS vehicle_type FROM raw"""

ORACLES["time_features"] = _ON_PREPARED + """
SELECT row_seq, "timestamp", hour, day_of_week, is_weekend, is_peak FROM prepared"""

ORACLES["json_props"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLES["partition_by_key"] = _ON_PREPARED + """
SELECT row_seq, violation_id, zone, CAST(('0x' || substr(md5(zone), 1, 8))::BIGINT % 5 AS INTEGER) AS "partition"
FROM prepared"""

# --- clean --------------------------------------------------------------------

ORACLES["derive_severity"] = _ON_PREPARED + """
SELECT row_seq, violation_type, speed_kmh, severity FROM prepared"""

ORACLES["impute_group_median"] = _ON_PREPARED + """,
g AS (SELECT p.*, coalesce(p.fine_amount, f.m) AS fine1, coalesce(p.speed_kmh, s.m, 0.0) AS speed1 FROM prepared p
    LEFT JOIN (SELECT zone, violation_type, median(fine_amount) AS m FROM prepared GROUP BY ALL) f
        ON p.zone = f.zone AND p.violation_type = f.violation_type
    LEFT JOIN (SELECT violation_type, median(speed_kmh) AS m FROM prepared GROUP BY ALL) s
        ON p.violation_type = s.violation_type)
SELECT row_seq, violation_id, zone, violation_type,
    coalesce(fine1, (SELECT median(fine1) FROM g)) AS fine_amount, speed1 AS speed_kmh FROM g"""

ORACLES["impute_mode"] = _ON_PREPARED + """
SELECT row_seq, coalesce(vehicle_type, (SELECT vehicle_type FROM prepared WHERE vehicle_type IS NOT NULL
        GROUP BY vehicle_type ORDER BY count(*) DESC, vehicle_type LIMIT 1)) AS vehicle_type,
    coalesce(officer_id, 'UNKNOWN') AS officer_id,
    coalesce(latitude, (SELECT median(latitude) FROM prepared)) AS latitude,
    coalesce(longitude, (SELECT median(longitude) FROM prepared)) AS longitude FROM prepared"""

ORACLES["cap_outliers"] = _ON_RAW + """,
c AS (SELECT row_seq, CASE WHEN speed_kmh IS NOT NULL THEN least(greatest(speed_kmh, 0.0), 200.0) END AS speed_kmh,
    CASE WHEN fine_amount IS NOT NULL THEN least(greatest(fine_amount, 0.0), 5000.0) END AS fine_amount FROM raw),
q AS (SELECT quantile_cont(fine_amount, 0.25) AS q1, quantile_cont(fine_amount, 0.75) AS q3 FROM c)
SELECT c.*, NOT coalesce(fine_amount BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1), false) AS fine_is_outlier
FROM c, q"""

ORACLES["exact_quantiles"] = _ON_PREPARED + f"""
SELECT zone, {_r('quantile_cont(fine_amount, 0.25)', 6)} AS q1, {_r('quantile_cont(fine_amount, 0.5)', 6)} AS q2,
    {_r('quantile_cont(fine_amount, 0.75)', 6)} AS q3 FROM prepared GROUP BY zone"""

ORACLES["price_quantiles"] = f"""
SELECT l_returnflag, {_r('quantile_cont(l_extendedprice, 0.1)', 4)} AS p10,
    {_r('quantile_cont(l_extendedprice, 0.5)', 4)} AS p50, {_r('quantile_cont(l_extendedprice, 0.9)', 4)} AS p90
FROM lineitem GROUP BY l_returnflag"""

ORACLES["clean_records"] = _ON_CLEAN + "SELECT * FROM clean"

# --- features -----------------------------------------------------------------

ORACLES["normalise_minmax"] = _ON_CLEAN + f"""
SELECT violation_id, speed_kmh, {_r('(speed_kmh - lo) / (hi - lo)', 6)} AS scaled
FROM clean, (SELECT min(speed_kmh) AS lo, max(speed_kmh) AS hi FROM clean)"""

ORACLES["normalise_zscore"] = _ON_CLEAN + f"""
SELECT violation_id, speed_kmh, {_r('(speed_kmh - m) / s', 6)} AS scaled
FROM clean, (SELECT avg(speed_kmh) AS m, stddev_samp(speed_kmh) AS s FROM clean)"""

ORACLES["normalise_robust"] = _ON_CLEAN + f"""
SELECT violation_id, speed_kmh, {_r('(speed_kmh - m) / (q3 - q1)', 6)} AS scaled
FROM clean, (SELECT median(speed_kmh) AS m, quantile_cont(speed_kmh, 0.25) AS q1,
    quantile_cont(speed_kmh, 0.75) AS q3 FROM clean)"""

ORACLES["risk_score"] = _ON_SCORED + """
SELECT violation_id, severity, speed_kmh, fine_amount, risk_score FROM scored"""

ORACLES["price_rank"] = f"""
SELECT o_orderkey, o_totalprice, {_r('''(rank() OVER (ORDER BY o_totalprice)
    + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0) / count(*) OVER ()''', 8)} AS pct_rank FROM orders"""

ORACLES["speed_fine_tiers"] = _ON_CLEAN + """
SELECT violation_id, violation_type, zone, severity, speed_kmh, fine_amount, hour,
    coalesce(hour BETWEEN 7 AND 9, false) OR coalesce(hour BETWEEN 17 AND 19, false) AS is_peak,
    CASE WHEN speed_kmh <= 0 THEN 'stationary' WHEN speed_kmh <= 15 THEN 'slow' WHEN speed_kmh <= 40 THEN 'moderate'
        WHEN speed_kmh <= 80 THEN 'fast' ELSE 'excessive' END AS speed_category,
    CASE WHEN fine_amount <= 100 THEN 'low' WHEN fine_amount <= 300 THEN 'medium' ELSE 'high' END AS fine_tier,
    speed_kmh / 200.0 AS speed_norm_spark
FROM clean"""

ORACLES["encode_ordinal_onehot"] = _ON_CLEAN + """
SELECT violation_id, zone, severity, is_peak, is_weekend,
    CASE severity WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS severity_code,
    CAST(is_peak AS INTEGER) AS is_peak_code, CAST(is_weekend AS INTEGER) AS is_weekend_code,
    zone = 'Downtown' AS "zone_Downtown", zone = 'Highway' AS "zone_Highway", zone = 'Industrial' AS "zone_Industrial",
    zone = 'Residential' AS "zone_Residential", zone = 'School Zone' AS "zone_School Zone",
    zone = 'Unknown' AS "zone_Unknown"
FROM clean"""

# --- analytics ----------------------------------------------------------------

ORACLES["zone_type_summary"] = _ON_CLEAN + f""",
modes AS (SELECT zone, violation_type, hour AS peak_hour FROM (
    SELECT zone, violation_type, hour, row_number() OVER (
        PARTITION BY zone, violation_type ORDER BY count(*) DESC, hour) AS rn
    FROM clean WHERE hour IS NOT NULL GROUP BY zone, violation_type, hour) WHERE rn = 1)
SELECT s.*, peak_hour FROM (
    SELECT zone, violation_type, count(violation_id) AS total_violations,
        {_r('avg(fine_amount)', 2)} AS avg_fine, {_r('max(fine_amount)', 2)} AS max_fine,
        {_r('min(fine_amount)', 2)} AS min_fine, {_r('sum(fine_amount)', 2)} AS total_revenue,
        {_r('avg(speed_kmh)', 2)} AS avg_speed,
        {_r("count(*) FILTER (severity = 'High') * 100.0 / count(violation_id)", 1)} AS pct_high_severity
    FROM clean GROUP BY zone, violation_type) s
LEFT JOIN modes USING (zone, violation_type)"""

ORACLES["hourly_summary"] = _ON_CLEAN + f"""
SELECT hour, count(*) AS count, {_r('avg(fine_amount)', 2)} AS avg_fine, {_r('avg(speed_kmh)', 2)} AS avg_speed
FROM clean WHERE hour IS NOT NULL GROUP BY hour"""

ORACLES["zone_type_report"] = _ON_CLEAN + f"""
SELECT zone, violation_type, count(*) AS total_violations, {_r('avg(fine_amount)', 2)} AS avg_fine,
    {_r('sum(fine_amount)', 2)} AS total_revenue, {_r('max(fine_amount)', 2)} AS max_fine,
    {_r('avg(speed_kmh)', 2)} AS avg_speed
FROM clean WHERE fine_amount IS NOT NULL AND zone IS NOT NULL GROUP BY zone, violation_type"""

ORACLES["hourly_trend"] = _ON_CLEAN + f"""
SELECT hour, count(*) AS violations_count, {_r('avg(fine_amount)', 2)} AS avg_fine,
    count(*) FILTER (severity = 'High') AS high_severity_count, count(*) FILTER (is_peak) AS peak_hour_count
FROM clean GROUP BY hour"""

ORACLES["severity_share"] = _ON_CLEAN + f"""
SELECT severity, count(*) AS count, {_r('avg(fine_amount)', 2)} AS avg_fine,
    {_r('count(*) * 100.0 / (SELECT count(*) FROM clean)', 1)} AS pct_share
FROM clean GROUP BY severity"""

ORACLES["zone_type_severity_summary"] = _ON_CLEAN + f"""
SELECT zone, violation_type, severity, count(*) AS count, {_r('avg(fine_amount)', 2)} AS avg_fine,
    {_r('sum(fine_amount)', 2)} AS total_revenue
FROM clean GROUP BY zone, violation_type, severity"""

ORACLES["zone_revenue_recent"] = _ON_CLEAN + """
SELECT zone, sum(fine_amount) AS total_revenue, count(*) AS violations, avg(fine_amount) AS avg_fine,
    count(*) FILTER (severity = 'High') AS high_severity
FROM clean WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-21' GROUP BY zone"""

ORACLES["hour_zone_counts"] = _ON_CLEAN + """
SELECT CAST(hour("timestamp") AS INTEGER) AS hour, zone, count(*) AS count FROM clean GROUP BY ALL"""

ORACLES["officer_top20"] = _ON_CLEAN + """
SELECT officer_id, count(*) AS total_violations, sum(fine_amount) AS revenue_generated, avg(fine_amount) AS avg_fine
FROM clean GROUP BY officer_id HAVING count(*) > 10 ORDER BY revenue_generated DESC, officer_id LIMIT 20"""

ORACLES["type_counts"] = _ON_CLEAN + """
SELECT violation_type, count(*) AS count FROM clean WHERE violation_type IS NOT NULL GROUP BY violation_type"""

ORACLES["severity_counts"] = _ON_CLEAN + """
SELECT severity, count(*) AS count FROM clean WHERE severity IS NOT NULL GROUP BY severity"""

ORACLES["kpi_cards"] = _ON_CLEAN + f"""
SELECT count(*) AS total_violations, sum(fine_amount) AS total_revenue, avg(fine_amount) AS avg_fine,
    count(*) FILTER (severity = 'High') AS high_severity,
    {_r("count(*) FILTER (severity = 'High') * 100.0 / count(*)", 1)} AS pct_high,
    count(DISTINCT officer_id) AS officers_active
FROM clean"""

ORACLES["zone_revenue"] = _ON_CLEAN + """
SELECT zone, sum(fine_amount) AS revenue FROM clean WHERE zone IS NOT NULL GROUP BY zone"""

ORACLES["day_hour_pivot"] = _ON_CLEAN + "SELECT day_of_week, " + ", ".join(
    f"count(*) FILTER (hour = {h}) AS h{h:02d}" for h in range(24)) + """
FROM clean WHERE hour IS NOT NULL GROUP BY day_of_week"""

_ZONE_WINDOWS = """
    SELECT violation_id, zone, violation_type, fine_amount, severity, hour,
        CAST(rank() OVER (PARTITION BY zone ORDER BY fine_amount DESC) AS INTEGER) AS rank_in_zone,
        CAST(dense_rank() OVER (PARTITION BY zone ORDER BY fine_amount DESC) AS INTEGER) AS dense_rank_zone,
        lag(fine_amount, 1) OVER (PARTITION BY zone ORDER BY hour NULLS FIRST, violation_id) AS prev_hour_fine,
        sum(fine_amount) OVER (PARTITION BY zone ORDER BY hour NULLS FIRST
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_revenue
    FROM clean"""
ORACLES["zone_windows"] = _ON_CLEAN + _ZONE_WINDOWS
ORACLES["top5_per_zone"] = _ON_CLEAN + f"SELECT * FROM ({_ZONE_WINDOWS}) WHERE rank_in_zone <= 5"

_HOURLY = """hourly AS (SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS count
    FROM clean WHERE "timestamp" IS NOT NULL GROUP BY 1)"""
_BY_HOUR = """hourly AS (SELECT hour, count(*) AS count FROM clean WHERE hour IS NOT NULL GROUP BY 1)"""
_ROLLED = """rolled AS (SELECT hour, count, avg(count) OVER w AS rolling_mean,
    coalesce(stddev_samp(count) OVER w, 0.0) AS rolling_std
    FROM hourly WINDOW w AS (ORDER BY hour ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING))"""
ORACLES["rolling_hourly"] = _with(_RAW, _CLEAN, _HOURLY, _ROLLED) + f"""
SELECT hour, count, {_r('rolling_mean', 6)} AS rolling_mean, {_r('rolling_std', 6)} AS rolling_std FROM rolled"""

ORACLES["zone_share"] = _ON_CLEAN + f"""
SELECT violation_id, zone, fine_amount,
    {_r('fine_amount * 100.0 / sum(fine_amount) OVER (PARTITION BY zone)', 8)} AS pct_of_zone FROM clean"""

ORACLES["raw_explorer"] = _ON_CLEAN + """
SELECT violation_id, violation_type, zone, speed_kmh, fine_amount, severity, hour, vehicle_type, officer_id
FROM clean WHERE zone = 'Downtown' AND severity = 'High' ORDER BY violation_id LIMIT 500"""

ORACLES["hash_sample"] = _ON_CLEAN + """
SELECT violation_id, zone, fine_amount FROM clean ORDER BY md5(violation_id || ':0'), violation_id LIMIT 100"""

ORACLES["hash_fraction"] = _ON_CLEAN + """
SELECT violation_id, zone FROM clean WHERE ('0x' || substr(md5(violation_id || ':0'), 1, 8))::BIGINT < 1073741824"""

# --- quality ------------------------------------------------------------------


def _checks(table, completeness, ranged, freshness):
    """One SELECT per check over ``table``, numbered in order."""
    parts = []

    def add(dimension, field, metric, threshold, ok, detail, miss="FAIL"):
        parts.append(f"""
SELECT {len(parts)} AS seq, '{dimension}' AS dimension, '{field}' AS field,
    CASE WHEN {ok} THEN 'PASS' ELSE '{miss}' END AS status, m AS metric, CAST({threshold} AS DOUBLE) AS threshold,
    {detail} AS detail FROM (SELECT {metric} AS m FROM {table})""")

    for field, need in completeness.items():
        add("completeness", field, f'1 - avg(CASE WHEN "{field}" IS NULL THEN 1.0 ELSE 0.0 END)', need, f"m >= {need}",
            f"printf('%.1f%% complete (need ≥{need * 100:.0f}%%)', m * 100)")
    for field, (low, high) in ranged.items():
        add("validity", field, f"avg(CASE WHEN {field} < {low} OR {field} > {high} THEN 1.0 ELSE 0.0 END)", 0.01,
            "m < 0.01", "printf('%.2f%% out-of-bounds (threshold: 1%%)', m * 100)")
    add("uniqueness", "violation_id", "(count(*) - count(DISTINCT violation_id)) / CAST(count(*) AS DOUBLE)", 0,
        "m = 0", "printf('%.3f%% duplicate IDs', m * 100)")
    add("consistency", "speed_kmh/violation_type",
        "coalesce(avg(CASE WHEN speed_kmh <= 0 THEN 1.0 ELSE 0.0 END) FILTER (violation_type = 'Speeding'), 0.0)",
        0.02, "m < 0.02", "printf('%.1f%% ''Speeding'' records with speed ≤ 0', m * 100)")
    if freshness:
        add("freshness", "timestamp",
            "CAST(floor(epoch(TIMESTAMP '2024-01-31' - max(\"timestamp\")) / 86400) AS DOUBLE)", 7, "m <= 7",
            "printf('Most recent record is %d days old (threshold: 7 days)', CAST(m AS BIGINT))", "WARN")
    return " UNION ALL ".join(parts)


_FULL = {"violation_type": 1.0, "zone": 1.0, "severity": 1.0, "fine_amount": 0.95, "timestamp": 0.99, "speed_kmh": 0.9}
_RANGES = {"speed_kmh": (0, 200), "fine_amount": (0, 5000), "latitude": (-90, 90), "longitude": (-180, 180),
           "hour": (0, 23)}
_DASH = {c: _FULL[c] for c in ("violation_type", "zone", "severity", "fine_amount")}
_DASH_RANGES = {c: _RANGES[c] for c in ("speed_kmh", "fine_amount")}
_DQ_PREPARED = f"checks AS ({_checks('prepared', _FULL, _RANGES, True)})"
_DQ_CLEAN = f"checks AS ({_checks('clean', _FULL, _RANGES, True)})"
_SCORE = f"""score AS (SELECT
    {_r("count(*) FILTER (status = 'PASS') * 100.0 / count(*) FILTER (status <> 'SKIP')", 1)} AS score,
    count(*) FILTER (status IN ('FAIL', 'WARN')) = 0 AS passed, count(*) FILTER (status = 'PASS') AS n_pass,
    count(*) FILTER (status IN ('FAIL', 'WARN')) AS n_fail, '2024-01-31T00:00:00' AS run_at FROM checks)"""
_CHECK_ROWS = f"SELECT * REPLACE ({_r('metric', 8)} AS metric) FROM checks"

ORACLES["dq_checks"] = _with(_RAW, _PREPARED, _DQ_PREPARED) + _CHECK_ROWS
ORACLES["dq_checks_dashboard"] = _with(
    _RAW, _CLEAN, f"checks AS ({_checks('clean', _DASH, _DASH_RANGES, False)})") + _CHECK_ROWS
ORACLES["dq_score"] = _with(_RAW, _PREPARED, _DQ_PREPARED, _SCORE) + "SELECT * FROM score"

_UNEXPECTED = """unexpected AS (
    SELECT 'violation_type' AS field, violation_type AS value, count(*) AS n FROM {t}
        WHERE violation_type NOT IN ('Speeding', 'Red-Light', 'DUI', 'Illegal Park', 'Reckless', 'Mobile Use',
            'No Seatbelt', 'Unknown') GROUP BY 2
    UNION ALL SELECT 'zone', zone, count(*) FROM {t}
        WHERE zone NOT IN ('Downtown', 'Highway', 'School Zone', 'Residential', 'Industrial', 'Unknown') GROUP BY 2)"""
_FINDINGS = _UNEXPECTED.replace("{t}", "prepared") + """,
findings AS (
    SELECT 'warning' AS level, 'nulls' AS rule, f AS field, CAST(n AS DOUBLE) AS n,
        printf('''%s'' has %d nulls', f, n) AS message
    FROM (SELECT 'violation_type' AS f, count(*) FILTER (violation_type IS NULL) AS n FROM prepared
        UNION ALL SELECT 'zone', count(*) FILTER (zone IS NULL) FROM prepared
        UNION ALL SELECT 'severity', count(*) FILTER (severity IS NULL) FROM prepared) WHERE n > 0
    UNION ALL SELECT 'error', 'bounds', f, CAST(n AS DOUBLE), printf('''%s'' has %d values outside %s', f, n, b)
    FROM (SELECT 'speed_kmh' AS f, count(*) FILTER (speed_kmh < 0 OR speed_kmh > 200) AS n, '[0, 200]' AS b FROM prepared
        UNION ALL SELECT 'fine_amount', count(*) FILTER (fine_amount < 0 OR fine_amount > 5000), '[0, 5000]' FROM prepared
        UNION ALL SELECT 'latitude', count(*) FILTER (latitude < -90 OR latitude > 90), '[-90, 90]' FROM prepared
        UNION ALL SELECT 'longitude', count(*) FILTER (longitude < -180 OR longitude > 180), '[-180, 180]' FROM prepared)
    WHERE n > 0
    UNION ALL SELECT 'warning', 'duplicates', '*', CAST(n AS DOUBLE), printf('%d duplicate rows detected', n)
    FROM (SELECT (SELECT count(*) FROM prepared) - (SELECT count(*) FROM (SELECT DISTINCT * FROM prepared)) AS n)
    WHERE n > 0
    UNION ALL SELECT 'error', 'null_rate', 'fine_amount', p,
        printf('fine_amount null rate %.1f%% exceeds 5%% threshold', p)
    FROM (SELECT avg(CASE WHEN fine_amount IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS p FROM prepared) WHERE p > 5
    UNION ALL SELECT 'warning', 'allowed_set', field, CAST(count(*) AS DOUBLE),
        printf('''%s'' contains %d unexpected values', field, count(*)) FROM unexpected GROUP BY field)"""
ORACLES["schema_report"] = _with(_RAW, _PREPARED, _FINDINGS) + f"""
SELECT level, rule, field, {_r('n', 6)} AS n, message FROM findings"""
ORACLES["schema_score"] = _with(_RAW, _PREPARED, _FINDINGS) + """
SELECT e = 0 AS passed, CAST(greatest(0.0, 100.0 - e * 10 - w * 2) AS DOUBLE) AS score, e AS errors, w AS warnings,
    (SELECT count(*) FROM prepared) AS rows, 16 AS cols
FROM (SELECT count(*) FILTER (level = 'error') AS e, count(*) FILTER (level = 'warning') AS w FROM findings)"""
ORACLES["unexpected_values"] = _with(_RAW, _UNEXPECTED.replace("{t}", "raw")) + "SELECT * FROM unexpected"

_ANOMALIES = """stats AS (SELECT avg(speed_kmh) AS m, stddev_samp(speed_kmh) AS s,
    quantile_cont(speed_kmh, 0.25) AS q1, quantile_cont(speed_kmh, 0.75) AS q3 FROM clean),
flagged AS (SELECT clean.*, abs(speed_kmh - m) / s AS z, abs(speed_kmh - m) / s > 3 AS by_z,
    speed_kmh < q1 - 1.5 * (q3 - q1) OR speed_kmh > q3 + 1.5 * (q3 - q1) AS by_iqr FROM clean, stats)"""
_ON_FLAGGED = _with(_RAW, _CLEAN, _ANOMALIES)


def _anomalies(test, reason):
    return _ON_FLAGGED + f"""
SELECT violation_id, zone, violation_type, speed_kmh, fine_amount, {reason} AS anomaly_reason,
    'speed_kmh' AS anomaly_col, speed_kmh AS anomaly_value FROM flagged WHERE {test}"""


_Z_TEXT = "printf('Z-score=%.2f; ', z)"
ORACLES["anomalies_zscore"] = _anomalies("by_z", _Z_TEXT)
ORACLES["anomalies_iqr"] = _anomalies("by_iqr", "'IQR outlier; '")
ORACLES["anomalies_combined"] = _anomalies(
    "by_z OR by_iqr",
    f"CASE WHEN by_z THEN {_Z_TEXT} ELSE '' END || CASE WHEN by_iqr THEN 'IQR outlier; ' ELSE '' END")
ORACLES["anomaly_mark"] = _ON_FLAGGED + "SELECT violation_id, speed_kmh, by_z OR by_iqr AS is_anomaly FROM flagged"
ORACLES["non_anomalous_anti"] = _ON_FLAGGED + "SELECT violation_id, zone, speed_kmh FROM flagged WHERE NOT by_iqr"
ORACLES["anomalous_semi"] = _ON_FLAGGED + "SELECT violation_id, zone, speed_kmh FROM flagged WHERE by_z"

_SPIKES = f"""
SELECT hour, count, CAST(CAST({_r('greatest(rolling_mean - rolling_std, 0)', 0)} AS BIGINT) AS VARCHAR) || '–'
    || CAST(CAST({_r('rolling_mean + rolling_std', 0)} AS BIGINT) AS VARCHAR) AS expected_range
FROM rolled WHERE count > rolling_mean + 2 * rolling_std"""
ORACLES["temporal_spikes"] = _with(_RAW, _CLEAN, _HOURLY, _ROLLED) + _SPIKES
ORACLES["temporal_spikes_by_hour"] = _with(_RAW, _CLEAN, _BY_HOUR, _ROLLED) + _SPIKES
ORACLES["temporal_spikes_neighbours"] = _with(_RAW, _CLEAN, _HOURLY, """
rolled AS (SELECT hour, count, avg(count) OVER w AS rolling_mean, coalesce(stddev_samp(count) OVER w, 0.0) AS rolling_std
    FROM hourly WINDOW w AS (ORDER BY hour ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING EXCLUDE CURRENT ROW))""") + _SPIKES

ORACLES["dq_report_rows"] = _with(_RAW, _PREPARED, _CLEAN, _DQ_PREPARED, _SCORE, _ANOMALIES) + """,
found AS (SELECT violation_id, fine_amount, CASE WHEN by_z THEN printf('Z-score=%.2f; ', z) ELSE '' END
    || CASE WHEN by_iqr THEN 'IQR outlier; ' ELSE '' END AS why FROM flagged WHERE by_z OR by_iqr),
firsts10 AS (SELECT *, row_number() OVER (ORDER BY violation_id) AS rn FROM found)
SELECT 0 AS line_no, '# Data Quality Report' AS text
UNION ALL SELECT 1, '**Run at:** ' || run_at FROM score
UNION ALL SELECT 2, printf('**Overall score:** %.1f%%  |  Passed: %d  |  Failed: %d', score, n_pass, n_fail) FROM score
UNION ALL SELECT 3, '' UNION ALL SELECT 4, '## Check Results'
UNION ALL SELECT 5, '| Dimension | Field | Status | Detail |'
UNION ALL SELECT 6, '|-----------|-------|--------|--------|'
UNION ALL SELECT 100 + seq, '| ' || dimension || ' | ' || field || ' | '
    || CASE status WHEN 'PASS' THEN '✓' WHEN 'WARN' THEN '⚠' ELSE '✗' END || ' ' || status || ' | ' || detail || ' |'
    FROM checks
UNION ALL SELECT 1000, '' UNION ALL SELECT 1001, '## Anomaly Detection'
UNION ALL SELECT 1002, printf('**Total anomalies flagged:** %d', count(*)) FROM found
UNION ALL SELECT n, t FROM (VALUES (1003, ''), (1004, '| violation_id | fine_amount | reason |'), (1005, '|---|---|---|'))
    v(n, t) WHERE (SELECT count(*) FROM found) > 0
UNION ALL SELECT CAST(1999 + rn AS INTEGER), '| ' || violation_id || ' | ' || printf('%.1f', fine_amount) || ' | '
    || trim(why) || ' |' FROM firsts10 WHERE rn <= 10"""

_FAULTS = """CASE WHEN violation_type IS NULL THEN 'violation_type missing' WHEN zone IS NULL THEN 'zone missing'
    WHEN "timestamp" IS NULL THEN 'timestamp missing'
    WHEN speed_kmh < 0 OR speed_kmh > 200 THEN 'speed_kmh out of bounds'
    WHEN fine_amount < 0 OR fine_amount > 5000 THEN 'fine_amount out of bounds'
    WHEN latitude < -90 OR latitude > 90 THEN 'latitude out of bounds'
    WHEN longitude < -180 OR longitude > 180 THEN 'longitude out of bounds' END"""
ORACLES["dq_gate_quarantine"] = _ON_PREPARED + f"""
SELECT gate_reason, count(*) AS rows FROM (SELECT {_FAULTS} AS gate_reason FROM prepared)
WHERE gate_reason IS NOT NULL GROUP BY gate_reason"""
ORACLES["dq_gate_route"] = _with(_RAW, _CLEAN, _DQ_CLEAN, _SCORE) + f""",
judged AS (SELECT {_FAULTS} AS fault, score FROM clean, score)
SELECT 'accepted' AS route, count(*) FILTER (fault IS NULL AND score >= 90) AS rows FROM judged
UNION ALL SELECT 'quarantined', count(*) FILTER (fault IS NOT NULL) FROM judged
UNION ALL SELECT 'alerts', count(*) FILTER (score < 90) FROM score"""

ORACLES["run_summary"] = _with(_RAW, _CLEAN, _DQ_CLEAN, _SCORE) + f""",
stats AS (SELECT avg(fine_amount) AS m, stddev_samp(fine_amount) AS s,
    quantile_cont(fine_amount, 0.25) AS q1, quantile_cont(fine_amount, 0.75) AS q3 FROM clean),
sizes AS (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM clean) AS c)
SELECT r AS raw_rows, c AS clean_rows, {_r('(1 - c / CAST(greatest(r, 1) AS DOUBLE)) * 100', 1)} AS drop_pct,
    score AS dq_score, (SELECT count(*) FROM clean, stats WHERE abs(fine_amount - m) / s > 3
        OR fine_amount < q1 - 1.5 * (q3 - q1) OR fine_amount > q3 + 1.5 * (q3 - q1)) AS anomalies
FROM sizes, score"""

# --- warehouse, layout --------------------------------------------------------

ORACLES["warehouse_coerce"] = _ON_CLEAN + """
SELECT violation_id, CAST("timestamp" AS VARCHAR) AS "timestamp", CAST(is_peak AS INTEGER) AS is_peak,
    CAST(fine_is_outlier AS INTEGER) AS fine_is_outlier, fine_amount FROM clean"""

_DIMS = """dim_time AS (SELECT row_number() OVER (ORDER BY hour NULLS FIRST, day_of_week NULLS FIRST, is_weekend, is_peak)
        AS time_id, * FROM (SELECT DISTINCT hour, day_of_week, is_weekend, is_peak FROM clean)),
dim_location AS (SELECT row_number() OVER (ORDER BY zone, latitude, longitude) AS loc_id, *
    FROM (SELECT DISTINCT zone, latitude, longitude FROM clean)),
dim_vehicle AS (SELECT row_number() OVER (ORDER BY vehicle_type) AS veh_id, *
    FROM (SELECT DISTINCT vehicle_type FROM clean))"""
ORACLES["star_dims"] = _with(_RAW, _CLEAN, _DIMS) + """
SELECT 'dim_time' AS "table", count(*) AS rows FROM dim_time UNION ALL SELECT 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'dim_vehicle', count(*) FROM dim_vehicle UNION ALL SELECT 'fact_violation', count(*) FROM clean"""
ORACLES["star_dim_time"] = _with(_RAW, _CLEAN, _DIMS) + "SELECT * FROM dim_time"
ORACLES["star_dim_location"] = _with(_RAW, _CLEAN, _DIMS) + "SELECT * FROM dim_location"
ORACLES["star_dim_vehicle"] = _with(_RAW, _CLEAN, _DIMS) + "SELECT * FROM dim_vehicle"
ORACLES["star_fact"] = _with(_RAW, _CLEAN, _RISK, _DIMS) + """
SELECT violation_id, violation_type, severity, fine_amount, risk_score, time_id, loc_id, veh_id FROM scored s
LEFT JOIN dim_time t ON s.hour IS NOT DISTINCT FROM t.hour AND s.day_of_week IS NOT DISTINCT FROM t.day_of_week
    AND s.is_weekend = t.is_weekend AND s.is_peak = t.is_peak
LEFT JOIN dim_location l ON s.zone = l.zone AND s.latitude = l.latitude AND s.longitude = l.longitude
LEFT JOIN dim_vehicle v ON s.vehicle_type = v.vehicle_type"""

ORACLES["prefix_filter"] = _ON_CLEAN + """
SELECT key FROM (SELECT 'raw/' || strftime("timestamp", '%Y/%m/%d') || '/' || violation_id AS key FROM clean
    WHERE "timestamp" IS NOT NULL) WHERE key LIKE 'raw/2024/01/1%'"""

_FILES = """files AS (SELECT '/docs/' || CAST(doc_id AS VARCHAR) AS path, CAST(n_chars AS BIGINT) AS size_bytes,
    greatest(1, CAST(ceil(n_chars / 1024.0) AS INTEGER)) AS blocks FROM documents)"""
ORACLES["block_layout"] = _with(_FILES) + """
SELECT path, CAST(b AS INTEGER) AS block_no, substr(md5(path || ':' || CAST(b AS VARCHAR)), 1, 12) AS block_id,
    least(1024, size_bytes - b * 1024) AS block_bytes
FROM (SELECT path, size_bytes, unnest(range(blocks)) AS b FROM files)"""
ORACLES["block_report"] = _with(_FILES) + """
SELECT count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, CAST(sum(blocks) AS BIGINT) AS blocks FROM files"""

# --- log-shaped -----------------------------------------------------------------

_PARTITION = "CAST(('0x' || substr(md5(zone), 1, 8))::BIGINT % 5 AS INTEGER)"
_LOG = f"""log AS (
    SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY row_seq) - 1 AS "offset" FROM (
        SELECT DISTINCT row_seq, violation_id, zone, {_PARTITION} AS "partition" FROM (
            SELECT row_seq, violation_id, {_ZONE} AS zone FROM raw)))"""
_ON_LOG = _with(_RAW, _LOG)
ORACLES["kafka_envelope"] = _ON_CLEAN + """
SELECT 'traffic-violations' AS topic, zone AS key, '{"violation_id":"' || violation_id || '","violation_type":"'
    || violation_type || '","zone":"' || zone || '"}' AS value FROM clean"""
ORACLES["partition_offsets"] = _ON_LOG + 'SELECT "partition", "offset", violation_id FROM log'
ORACLES["partition_distribution"] = _ON_LOG + 'SELECT "partition", count(*) AS messages FROM log GROUP BY 1'
ORACLES["consumer_lag"] = _ON_LOG + """
SELECT "partition", e AS end_offset, coalesce(c, 0) AS committed, e - coalesce(c, 0) AS lag FROM (
    SELECT "partition", max("offset") + 1 AS e,
        max("offset") FILTER (row_seq <= (SELECT max(row_seq) // 2 FROM log)) + 1 AS c FROM log GROUP BY 1)"""
ORACLES["fair_batch"] = _ON_LOG + 'SELECT "partition", "offset", violation_id FROM log WHERE "offset" < 20'

# --- streams ----------------------------------------------------------------------

_EVENTS = f"""incidents AS (SELECT {_EVENT_COLUMNS}, ts AS event_time FROM events),
stream AS (SELECT violation_id AS event_id, event_time, {_TYPE} AS violation_type, {_ZONE} AS zone, speed_kmh,
    fine_amount FROM incidents),
windowed AS (SELECT stream.*, time_bucket(INTERVAL 1 MINUTE, event_time) - i * INTERVAL 1 MINUTE AS window_start
    FROM stream, (SELECT unnest(range(5)) AS i))"""
ORACLES["stream_sliding_agg"] = _with(_EVENTS) + f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, zone, violation_type,
    count(*) AS violation_count, {_r('avg(fine_amount)', 2)} AS avg_fine, {_r('sum(fine_amount)', 2)} AS revenue,
    {_r('avg(speed_kmh)', 2)} AS avg_speed
FROM windowed GROUP BY ALL"""
ORACLES["stream_sliding_zone"] = _with(_EVENTS) + f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, zone, count(*) AS violation_count,
    {_r('avg(fine_amount)', 2)} AS avg_fine FROM windowed GROUP BY ALL"""
ORACLES["stream_alerts"] = _with(_EVENTS) + """
SELECT event_id, violation_type, zone, speed_kmh, fine_amount, event_time FROM stream
WHERE violation_type IN ('DUI', 'Reckless') OR speed_kmh > 60"""
ORACLES["stream_run_summary"] = _with(_EVENTS) + f"""
SELECT {_PARTITION} AS "partition", count(*) AS produced, count(*) AS consumed, CAST(0 AS BIGINT) AS lag
FROM stream GROUP BY 1"""
