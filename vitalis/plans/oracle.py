"""Independent DuckDB SQL for each registered query (the correctness oracle).

Every statement starts from the raw ``events`` view with the same readings
mapping written in SQL, so the oracle shares no code path with the Spark
side.  Streams are compared on closed windows only (end <= newest - delay).
"""

from __future__ import annotations

# Fixed values, stated here on their own: param, hard min, hard max, normal min, normal max, error code, message.
RANGES = [
    ("pulse", 30.0, 220.0, 60.0, 100.0, 1, "Pulse outside valid range"),
    ("systolic", 60.0, 250.0, 90.0, 140.0, 2, "Systolic pressure outside valid range"),
    ("diastolic", 40.0, 150.0, 60.0, 90.0, 3, "Diastolic pressure outside valid range"),
    ("temperature", 35.0, 42.0, 36.1, 37.2, 4, "Temperature outside valid range"),
    ("spo2", 70.0, 100.0, 95.0, 100.0, 5, "SpO2 outside valid range"),
]

R = 6  # rounding digits, as in the registry

READINGS_CTE = """
readings AS (
  SELECT event_id,
         printf('P%03d', user_id) AS patient_id,
         CASE event_type WHEN 'click' THEN 'pulse' WHEN 'view' THEN 'temperature'
                         WHEN 'signup' THEN 'spo2' WHEN 'purchase' THEN 'blood_pressure'
                         ELSE 'other' END AS sensor_type,
         CASE event_type WHEN 'click' THEN CAST(value AS DOUBLE) + CAST(25.0 AS DOUBLE)
                         WHEN 'view' THEN CAST(34.8 AS DOUBLE) + CAST(value AS DOUBLE) / CAST(40.0 AS DOUBLE)
                         WHEN 'signup' THEN CAST(101.0 AS DOUBLE) - CAST(value AS DOUBLE) / CAST(8.0 AS DOUBLE)
                         WHEN 'purchase' THEN CAST(0.0 AS DOUBLE)
                         ELSE CAST(value AS DOUBLE) END AS value,
         CASE WHEN event_type = 'purchase' THEN CAST(55.0 AS DOUBLE) + CAST(value AS DOUBLE) END AS systolic,
         CASE WHEN event_type = 'purchase' THEN CAST(38.0 AS DOUBLE) + CAST(value AS DOUBLE) * CAST(0.6 AS DOUBLE) END AS diastolic,
         CAST(ts AS TIMESTAMP) AS ts
  FROM events
)"""

DIRTY_CTE = """
dirty_readings AS (
  SELECT event_id,
         CASE WHEN event_id % 17 <> 0 THEN patient_id END AS patient_id,
         sensor_type,
         CASE WHEN event_id % 19 <> 0 THEN value END AS value,
         systolic, diastolic, ts
  FROM (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE event_id % 10 = 0)
)"""

_RANGE = {r[0]: r for r in RANGES}


def _ranges_values() -> str:
    rows = ", ".join(
        f"('{p}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), CAST({nlo} AS DOUBLE), CAST({nhi} AS DOUBLE))"
        for p, lo, hi, nlo, nhi, *_ in RANGES
    )
    return f"ranges AS (SELECT * FROM (VALUES {rows}) t(param, min, max, normal_min, normal_max))"


MEASURES_CTE = """
measures AS (
  SELECT event_id, patient_id, ts, sensor_type AS param, value AS measure FROM readings
  WHERE sensor_type <> 'blood_pressure' OR sensor_type IS NULL
  UNION ALL SELECT event_id, patient_id, ts, 'systolic', systolic FROM readings WHERE sensor_type = 'blood_pressure'
  UNION ALL SELECT event_id, patient_id, ts, 'diastolic', diastolic FROM readings WHERE sensor_type = 'blood_pressure'
)"""


def _ok(param: str, x: str) -> str:
    _, lo, hi, *_ = _RANGE[param]
    return f"({x} >= {lo} AND {x} <= {hi})"


def _normal(param: str, x: str) -> str:
    _, _, _, nlo, nhi, *_ = _RANGE[param]
    return f"({x} >= {nlo} AND {x} <= {nhi})"


def _level(param: str, x: str) -> str:
    return f"CASE WHEN {_normal(param, x)} THEN 'normal' WHEN {_ok(param, x)} THEN 'valid' WHEN {x} IS NOT NULL THEN 'invalid' END"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _rd(x: str) -> str:
    return f"ROUND({x}, {R})"


def _avg(x: str, filt: str = "", over: str = "") -> str:
    """Fixed-point average: sum in 10**-(R+3) units, exact half-up division."""
    unit, k = 10 ** (R + 3), 1000
    s = f"SUM(CAST(ROUND({x} * {unit}.0) AS HUGEINT)) {filt} {over}"
    n = f"CAST(COUNT({x}) {filt} {over} AS HUGEINT)"
    num, den = f"(2 * {s} + {n} * {k})", f"(2 * {k} * {n})"
    return f"CASE WHEN {n} > 0 THEN CAST(({num} - (({num} % {den}) + {den}) % {den}) // {den} AS DOUBLE) / {10**R}.0 END"


BASE = _with(READINGS_CTE)
BASE_DIRTY = _with(READINGS_CTE, DIRTY_CTE)
US = "epoch_us(ts)"
SECS = "(epoch_us(ts) // 1000000)"


def _scalar_valid() -> str:
    return (
        f"CASE sensor_type WHEN 'pulse' THEN {_ok('pulse', 'value')} "
        f"WHEN 'temperature' THEN {_ok('temperature', 'value')} "
        f"WHEN 'spo2' THEN {_ok('spo2', 'value')} ELSE false END"
    )


def _detail() -> str:
    def part(field: str) -> str:
        arms = []
        for s in ("pulse", "temperature", "spo2"):
            _, _, _, _, _, code, msg = _RANGE[s]
            ok = _ok(s, "value")
            val = {
                "is_valid": ok,
                "error_code": f"CASE WHEN {ok} THEN 0 WHEN NOT {ok} THEN {code} END",
                "error_message": f"CASE WHEN NOT {ok} THEN '{msg}' END",
            }[field]
            arms.append(f"WHEN sensor_type = '{s}' THEN {val}")
        so, do = _ok("systolic", "systolic"), _ok("diastolic", "diastolic")
        scode, smsg = _RANGE["systolic"][5], _RANGE["systolic"][6]
        dcode, dmsg = _RANGE["diastolic"][5], _RANGE["diastolic"][6]
        bp = {
            "is_valid": f"CASE WHEN NOT {so} THEN false WHEN NOT {do} THEN false WHEN {so} AND {do} THEN true END",
            "error_code": f"CASE WHEN NOT {so} THEN {scode} WHEN NOT {do} THEN {dcode} WHEN {so} AND {do} THEN 0 END",
            "error_message": f"CASE WHEN NOT {so} THEN '{smsg}' WHEN NOT {do} THEN '{dmsg}' END",
        }[field]
        arms.append(f"WHEN sensor_type = 'blood_pressure' THEN {bp}")
        other = {"is_valid": "false", "error_code": "0", "error_message": "CAST(NULL AS VARCHAR)"}[field]
        return "CASE " + " ".join(arms) + f" ELSE {other} END"

    return f"""{BASE}
SELECT event_id, sensor_type,
       {part('is_valid')} AS is_valid,
       CAST({part('error_code')} AS INTEGER) AS error_code,
       {part('error_message')} AS error_message
FROM readings"""


def _status() -> str:
    arms = " ".join(
        f"WHEN '{p}' THEN CASE WHEN {_normal(p, 'measure')} THEN 'normal' "
        f"WHEN {_ok(p, 'measure')} THEN 'valid' WHEN measure IS NOT NULL THEN 'invalid' END"
        for p, *_ in RANGES
    )
    return f"CASE param {arms} END"


def _quality() -> str:
    counts = [
        f"COUNT(*) FILTER (WHERE sensor_type = 'pulse' AND NOT {_ok('pulse', 'value')}) AS n_pulse",
        f"COUNT(*) FILTER (WHERE sensor_type = 'temperature' AND NOT {_ok('temperature', 'value')}) AS n_temperature",
        f"COUNT(*) FILTER (WHERE sensor_type = 'spo2' AND NOT {_ok('spo2', 'value')}) AS n_spo2",
        f"COUNT(*) FILTER (WHERE NOT {_ok('systolic', 'systolic')}) AS n_systolic",
        f"COUNT(*) FILTER (WHERE NOT {_ok('diastolic', 'diastolic')}) AS n_diastolic",
    ]
    labels = [
        ("n_pulse", "Invalid pulse readings: "),
        ("n_temperature", "Invalid temperature readings: "),
        ("n_spo2", "Invalid SpO2 readings: "),
        ("n_systolic", "Invalid systolic readings: "),
        ("n_diastolic", "Invalid diastolic readings: "),
    ]
    items = ", ".join(f"CASE WHEN {n} > 0 THEN '{t}' || CAST({n} AS VARCHAR) END" for n, t in labels)
    return f"""{BASE}, c AS (SELECT COUNT(*) AS total_records, {', '.join(counts)} FROM readings)
SELECT total_records, array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), '; ') AS issues FROM c"""


def _alerts(source: str, params: list[str]) -> str:
    plist = ", ".join(f"'{p}'" for p in params)
    return f"""{_with(READINGS_CTE, MEASURES_CTE, _ranges_values())},
s AS (SELECT param, measure FROM {source} WHERE param IN ({plist})),
c AS (SELECT s.param, COUNT(*) FILTER (WHERE measure < normal_min) AS low,
             COUNT(*) FILTER (WHERE measure > normal_max) AS high
      FROM s JOIN ranges r ON s.param = r.param GROUP BY s.param),
l AS (SELECT param, 'low' AS level, low AS n FROM c UNION ALL SELECT param, 'high', high FROM c)
SELECT param AS sensor_type, level, n,
       CASE WHEN level = 'low' THEN 'Low ' || param || ': ' || CAST(n AS VARCHAR) || ' readings below normal'
            ELSE 'High ' || param || ': ' || CAST(n AS VARCHAR) || ' readings above normal' END AS alert
FROM l WHERE n > 0"""


def _snapshot_cols(over: str) -> str:
    cols = [
        f"COUNT(*) {over} AS count",
        f"array_to_string(list_sort(list_distinct(list(COALESCE(patient_id, 'unknown')) {over})), ',') AS patient_ids",
        f"array_to_string(list_sort(list_distinct(list(COALESCE(sensor_type, 'unknown')) {over})), ',') AS sensor_types",
    ]
    for s in ("pulse", "temperature", "spo2"):
        f = f"FILTER (WHERE sensor_type = '{s}')"
        n = f"COUNT(*) {f} {over}"
        v = "COALESCE(value, CAST(0.0 AS DOUBLE))"
        cols += [
            f"{n} AS {s}_count",
            f"CASE WHEN {n} > 0 THEN {_avg(v, f, over)} END AS {s}_avg",
            f"CASE WHEN {n} > 0 THEN MIN({v}) {f} {over} END AS {s}_min",
            f"CASE WHEN {n} > 0 THEN MAX({v}) {f} {over} END AS {s}_max",
        ]
    return ",\n       ".join(cols)


TRAILING_US = 6 * 86_400_000_000
GLOBAL_US = 30 * 60 * 1_000_000
KPI_AS_OF = "2024-02-01 00:00:00"
ALL_COLS = "event_id, patient_id, sensor_type, value, systolic, diastolic, ts"


def _tumbling(where: str = "") -> str:
    return f"""{BASE}
SELECT patient_id, sensor_type, ws + INTERVAL 1 DAY AS "timestamp", ws AS window_start, ws + INTERVAL 1 DAY AS window_end,
       COUNT(*) AS count, {_avg('value')} AS avg, MIN(value) AS min, MAX(value) AS max
FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS ws FROM readings WHERE sensor_type <> 'blood_pressure')
GROUP BY patient_id, sensor_type, ws {where}"""


def _tumbling_bp(where: str = "") -> str:
    return f"""{BASE}
SELECT patient_id, sensor_type, ws + INTERVAL 1 DAY AS "timestamp", ws AS window_start, ws + INTERVAL 1 DAY AS window_end,
       COUNT(*) AS count,
       {_avg('systolic')} AS systolic_avg, MIN(systolic) AS systolic_min, MAX(systolic) AS systolic_max,
       {_avg('diastolic')} AS diastolic_avg, MIN(diastolic) AS diastolic_min, MAX(diastolic) AS diastolic_max
FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS ws FROM readings WHERE sensor_type = 'blood_pressure')
GROUP BY patient_id, sensor_type, ws {where}"""


CLOSED = "HAVING ws + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM readings WHERE sensor_type <> 'blood_pressure') - INTERVAL 1 HOUR"
CLOSED_BP = "HAVING ws + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM readings WHERE sensor_type = 'blood_pressure') - INTERVAL 1 HOUR"


def _shard() -> str:
    return "CASE sensor_type WHEN 'pulse' THEN 0 WHEN 'temperature' THEN 1 WHEN 'spo2' THEN 2 WHEN 'blood_pressure' THEN 2 END"


ORACLE: dict[str, str] = {
    "sensor_stats_sql": f"""{BASE}
SELECT sensor_type, COUNT(*) AS count, {_avg('value')} AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value
FROM readings WHERE sensor_type IS NOT NULL AND value > 0 GROUP BY sensor_type ORDER BY count DESC, sensor_type""",
    "patient_stats_sql": f"""{BASE_DIRTY}
SELECT patient_id, COUNT(*) AS readings, COUNT(DISTINCT sensor_type) AS sensors
FROM dirty_readings GROUP BY patient_id ORDER BY readings DESC, patient_id""",
    "sql_on_parquet": f"""
SELECT event_type, COUNT(*) AS count, AVG(value) AS avg_value FROM events WHERE value > 0 GROUP BY event_type""",
    "sql_validate": f"""{BASE}
SELECT event_id, sensor_type,
       CAST(CASE sensor_type
         WHEN 'pulse' THEN CASE WHEN {_ok('pulse', 'value')} THEN 0 WHEN NOT {_ok('pulse', 'value')} THEN 1 END
         WHEN 'temperature' THEN CASE WHEN {_ok('temperature', 'value')} THEN 0 WHEN NOT {_ok('temperature', 'value')} THEN 4 END
         WHEN 'spo2' THEN CASE WHEN {_ok('spo2', 'value')} THEN 0 WHEN NOT {_ok('spo2', 'value')} THEN 5 END
         WHEN 'blood_pressure' THEN CASE WHEN NOT {_ok('systolic', 'systolic')} THEN 2 WHEN NOT {_ok('diastolic', 'diastolic')} THEN 3 ELSE 0 END
         ELSE 0 END AS INTEGER) AS error_code,
       CASE sensor_type
         WHEN 'pulse' THEN {_level('pulse', 'value')}
         WHEN 'temperature' THEN {_level('temperature', 'value')}
         WHEN 'spo2' THEN {_level('spo2', 'value')}
         WHEN 'blood_pressure' THEN {_level('systolic', 'systolic')} || '/' || {_level('diastolic', 'diastolic')}
       END AS status
FROM readings""",
    "sensor_stats": f"""{BASE}
SELECT sensor_type, COUNT(*) AS count, {_avg('value')} AS avg, MIN(value) AS min, MAX(value) AS max,
       {_rd('STDDEV_SAMP(value)')} AS std
FROM readings GROUP BY sensor_type""",
    "patient_stats": f"""{BASE_DIRTY}
SELECT patient_id, COUNT(*) AS total_readings,
       COUNT(DISTINCT sensor_type) + MAX(CASE WHEN sensor_type IS NULL THEN 1 ELSE 0 END) AS sensor_types
FROM dirty_readings GROUP BY patient_id""",
    "patient_summary": f"""{BASE_DIRTY}
SELECT patient_id, COUNT(*) AS readings,
       COUNT(DISTINCT sensor_type) + MAX(CASE WHEN sensor_type IS NULL THEN 1 ELSE 0 END) AS sensors
FROM dirty_readings GROUP BY patient_id""",
    "pulse_stats": f"""{BASE}
SELECT {_avg('value')} AS avg, MIN(value) AS min, MAX(value) AS max, COUNT(*) AS count
FROM readings WHERE sensor_type = 'pulse'""",
    "patient_counts": f"""{BASE}
SELECT patient_id, COUNT(*) AS count FROM readings GROUP BY patient_id""",
    "sensor_count_avg": f"""{BASE}
SELECT sensor_type, COUNT(*) AS count, {_avg('value')} AS avg_value FROM readings GROUP BY sensor_type""",
    "value_stats": f"""{BASE}
SELECT COUNT(*) AS count, COALESCE({_avg('value')}, 0.0) AS avg, COALESCE(MIN(value), 0.0) AS min,
       COALESCE(MAX(value), 0.0) AS max
FROM readings WHERE sensor_type <> 'blood_pressure'""",
    "validated_readings": f"""{BASE}
SELECT patient_id, sensor_type, value, {SECS} AS "timestamp", {_scalar_valid()} AS is_valid
FROM readings WHERE sensor_type <> 'blood_pressure'""",
    "validated_bp": f"""{BASE}
SELECT patient_id, sensor_type, systolic, diastolic, {SECS} AS "timestamp",
       {_ok('systolic', 'systolic')} AND {_ok('diastolic', 'diastolic')} AS is_valid
FROM readings WHERE sensor_type = 'blood_pressure'""",
    "validation_detail": _detail(),
    "range_lookup": f"""{_with(READINGS_CTE, MEASURES_CTE, _ranges_values())}
SELECT m.event_id, m.param, m.measure, r.min, r.max, r.normal_min, r.normal_max
FROM measures m LEFT JOIN ranges r ON m.param = r.param""",
    "normal_status": f"""{_with(READINGS_CTE, MEASURES_CTE)}
SELECT event_id, param, measure, {_status()} AS status, COALESCE(({_status()}) = 'normal', false) AS is_normal FROM measures""",
    "quality_report": _quality(),
    "alerts": _alerts("(SELECT sensor_type AS param, value AS measure FROM readings)", ["pulse", "temperature", "spo2"]),
    "alerts_bp": _alerts("measures", ["systolic", "diastolic"]),
    "clean_strict": f"""{BASE_DIRTY}
SELECT DISTINCT ON (patient_id, ts, sensor_type) {ALL_COLS} FROM dirty_readings
WHERE event_id IS NOT NULL AND patient_id IS NOT NULL AND sensor_type IS NOT NULL AND value IS NOT NULL
  AND systolic IS NOT NULL AND diastolic IS NOT NULL AND ts IS NOT NULL""",
    "clean_required": f"""{BASE_DIRTY}
SELECT DISTINCT ON (patient_id, ts, sensor_type) {ALL_COLS} FROM dirty_readings
WHERE patient_id IS NOT NULL AND sensor_type IS NOT NULL AND ts IS NOT NULL
  AND CASE WHEN sensor_type = 'blood_pressure' THEN systolic IS NOT NULL AND diastolic IS NOT NULL
           ELSE value IS NOT NULL END""",
    "clean_then_sql": f"""{BASE_DIRTY},
cleaned AS (
  SELECT DISTINCT ON (patient_id, ts, sensor_type) {ALL_COLS} FROM dirty_readings
  WHERE patient_id IS NOT NULL AND sensor_type IS NOT NULL AND ts IS NOT NULL
    AND CASE WHEN sensor_type = 'blood_pressure' THEN systolic IS NOT NULL AND diastolic IS NOT NULL
             ELSE value IS NOT NULL END)
SELECT sensor_type, COUNT(*) AS count, {_avg('value')} AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value
FROM cleaned WHERE sensor_type IS NOT NULL AND value > 0 GROUP BY sensor_type ORDER BY count DESC, sensor_type""",
    "distinct_rows": f"""{BASE_DIRTY}
SELECT DISTINCT {ALL_COLS} FROM dirty_readings""",
    "union_wide": f"""{BASE}
SELECT patient_id, sensor_type, value, {SECS} AS "timestamp", {_scalar_valid()} AS is_valid,
       CAST(NULL AS DOUBLE) AS systolic, CAST(NULL AS DOUBLE) AS diastolic
FROM readings WHERE sensor_type <> 'blood_pressure'
UNION ALL
SELECT patient_id, sensor_type, CAST(NULL AS DOUBLE), {SECS}, {_ok('systolic', 'systolic')} AND {_ok('diastolic', 'diastolic')},
       systolic, diastolic
FROM readings WHERE sensor_type = 'blood_pressure'""",
    "sensor_distribution": f"""{BASE}
SELECT sensor_type, count, {_rd('CAST(count AS DOUBLE) * 100.0 / CAST(SUM(count) OVER () AS DOUBLE)')} AS share_pct
FROM (SELECT COALESCE(sensor_type, 'unknown') AS sensor_type, COUNT(*) AS count FROM readings GROUP BY 1)""",
    "per_clock_minute": f"""{BASE}
SELECT strftime(ts, '%H:%M') AS minute, COUNT(*) AS count FROM readings GROUP BY 1 ORDER BY 1""",
    "per_minute": f"""{BASE}
SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS count FROM readings GROUP BY 1 ORDER BY 1""",
    "histogram": f"""{BASE},
d AS (SELECT sensor_type, value FROM readings WHERE sensor_type IN ('pulse', 'temperature', 'spo2') AND value IS NOT NULL),
b AS (SELECT sensor_type, MIN(value) AS lo, MAX(value) AS hi FROM d GROUP BY sensor_type),
x AS (SELECT d.sensor_type, lo, hi,
             CAST(CASE WHEN (hi - lo) / 30.0 > 0 THEN LEAST(FLOOR((value - lo) / ((hi - lo) / 30.0)), 29) ELSE 0 END AS INTEGER) AS bin
      FROM d JOIN b ON d.sensor_type = b.sensor_type)
SELECT sensor_type, bin, {_rd('lo + bin * ((hi - lo) / 30.0)')} AS bin_start,
       {_rd('lo + (bin + 1) * ((hi - lo) / 30.0)')} AS bin_end, COUNT(*) AS count
FROM x GROUP BY sensor_type, bin, lo, hi""",
    "kpis": f"""{BASE_DIRTY}
SELECT COUNT(*) AS total_readings,
       COUNT(DISTINCT patient_id) + MAX(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END) AS patients,
       COUNT(DISTINCT sensor_type) + MAX(CASE WHEN sensor_type IS NULL THEN 1 ELSE 0 END) AS sensor_types,
       MAX(ts) AS latest,
       epoch_us(TIMESTAMP '{KPI_AS_OF}') // 1000000 - epoch_us(MAX(ts)) // 1000000 AS age_seconds
FROM dirty_readings""",
    "distinct_lists": f"""{BASE_DIRTY}
SELECT DISTINCT 'patient' AS kind, COALESCE(patient_id, 'unknown') AS value FROM dirty_readings
UNION ALL
SELECT DISTINCT 'sensor' AS kind, COALESCE(sensor_type, 'unknown') AS value FROM dirty_readings""",
    "recent_20": f"""{BASE}
SELECT {ALL_COLS} FROM readings ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "last_20": f"""{BASE}
SELECT {ALL_COLS} FROM readings ORDER BY event_id DESC LIMIT 20""",
    "sensor_series": f"""{BASE}
SELECT event_id, ts, patient_id, value, CAST(60.0 AS DOUBLE) AS normal_min, CAST(100.0 AS DOUBLE) AS normal_max
FROM readings WHERE sensor_type = 'pulse' ORDER BY ts, event_id""",
    "tumbling": _tumbling(),
    "tumbling_bp": _tumbling_bp(),
    "trailing": f"""{BASE}
SELECT event_id, patient_id, sensor_type, ts, value,
       COUNT(*) OVER w AS count, {_avg('value', over='OVER w')} AS avg, MIN(value) OVER w AS min, MAX(value) OVER w AS max
FROM (SELECT *, {US} AS us FROM readings WHERE sensor_type <> 'blood_pressure')
WINDOW w AS (PARTITION BY patient_id, sensor_type ORDER BY us RANGE BETWEEN {TRAILING_US - 1} PRECEDING AND CURRENT ROW)""",
    "trailing_current": f"""{BASE},
s AS (SELECT *, {US} AS us FROM readings WHERE sensor_type <> 'blood_pressure'),
l AS (SELECT patient_id, sensor_type, MAX(us) AS last FROM s GROUP BY patient_id, sensor_type)
SELECT s.patient_id, s.sensor_type, COUNT(*) AS count, {_avg('value')} AS avg, MIN(value) AS min,
       MAX(value) AS max, MAX(ts) AS last_ts
FROM s JOIN l ON s.patient_id = l.patient_id AND s.sensor_type = l.sensor_type
WHERE s.us > l.last - {TRAILING_US}
GROUP BY s.patient_id, s.sensor_type""",
    "global_trailing": f"""{BASE}
SELECT event_id, ts, CAST(us - MIN(us) OVER w AS DOUBLE) / 1e6 AS window_duration,
       {_snapshot_cols('OVER w')}
FROM (SELECT *, {US} AS us FROM readings)
WINDOW w AS (ORDER BY us RANGE BETWEEN {GLOBAL_US} PRECEDING AND CURRENT ROW)""",
    "window_rows": f"""{BASE}
SELECT {ALL_COLS} FROM readings WHERE {US} >= (SELECT MAX({US}) FROM readings) - {GLOBAL_US}""",
    "window_current": f"""{BASE},
w AS (SELECT * FROM readings WHERE {US} >= (SELECT MAX({US}) FROM readings) - {GLOBAL_US})
SELECT CASE WHEN COUNT(*) > 1 THEN CAST(MAX({US}) - MIN({US}) AS DOUBLE) / 1e6 ELSE 0.0 END AS window_duration,
       {_snapshot_cols('')}
FROM w""",
    "retention_24h": f"""{BASE}
SELECT {ALL_COLS} FROM readings WHERE ts > (SELECT MAX(ts) FROM readings) - INTERVAL 24 HOUR""",
    "transport_rows": f"""{BASE}
SELECT patient_id, sensor_type, value, {SECS} AS "timestamp" FROM readings""",
    "message_roundtrip": f"""{BASE}
SELECT patient_id, sensor_type, value, {SECS} AS "timestamp" FROM readings""",
    "composite_key": f"""{BASE}
SELECT event_id, patient_id || '_' || sensor_type AS key,
       regexp_extract(patient_id || '_' || sensor_type, '^(.*)_(blood_pressure|temperature|pulse|spo2)$', 1) AS patient_part,
       regexp_extract(patient_id || '_' || sensor_type, '^(.*)_(blood_pressure|temperature|pulse|spo2)$', 2) AS sensor_part
FROM readings""",
    "payload_size": f"""{BASE},
t AS (SELECT patient_id, sensor_type, value, {SECS} AS "timestamp" FROM readings)
SELECT sensor_type, COUNT(*) AS records,
       CAST(SUM(strlen(CAST(to_json(struct_pack(patient_id, sensor_type, value, "timestamp")) AS VARCHAR)) + 1) AS BIGINT) AS json_bytes,
       CAST(SUM(8 + COALESCE(strlen(patient_id), 0) + 8 + COALESCE(strlen(sensor_type), 0) + 16) AS BIGINT) AS binary_bytes,
       {_rd('CAST(SUM(strlen(CAST(to_json(struct_pack(patient_id, sensor_type, value, "timestamp")) AS VARCHAR)) + 1) AS DOUBLE) / CAST(SUM(8 + COALESCE(strlen(patient_id), 0) + 8 + COALESCE(strlen(sensor_type), 0) + 16) AS DOUBLE)')} AS ratio
FROM t GROUP BY sensor_type""",
    "shard_assignment": f"""{BASE}
SELECT {_shard()} AS shard_id, sensor_type, COUNT(*) AS count FROM readings
WHERE {_shard()} IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
    "shard_throughput": f"""{BASE}
SELECT shard_id, ws AS window_start, ws + INTERVAL 1 DAY AS window_end, COUNT(*) AS processed
FROM (SELECT {_shard()} AS shard_id, time_bucket(INTERVAL 1 DAY, ts) AS ws FROM readings)
WHERE shard_id IS NOT NULL GROUP BY shard_id, ws""",
    "output_counts": f"""{BASE},
aggs AS (
  SELECT ws + INTERVAL 1 DAY AS emitted FROM (SELECT patient_id, sensor_type, time_bucket(INTERVAL 1 DAY, ts) AS ws FROM readings) GROUP BY patient_id, sensor_type, ws
),
tagged AS (SELECT ts AS emitted, 'raw' AS kind FROM readings WHERE sensor_type IS NOT NULL UNION ALL SELECT emitted, 'agg' FROM aggs)
SELECT time_bucket(INTERVAL 1 DAY, emitted) AS window_start, time_bucket(INTERVAL 1 DAY, emitted) + INTERVAL 1 DAY AS window_end,
       kind, COUNT(*) AS count
FROM tagged GROUP BY 1, 2, 3""",
    "ingest_stats": f"""{BASE},
g AS (SELECT sensor_type, COUNT(*) AS n, CAST(MAX({US}) - MIN({US}) AS DOUBLE) / 1e6 AS d FROM readings GROUP BY sensor_type)
SELECT sensor_type, n AS num_readings, ROUND(d, 3) AS duration_seconds,
       CASE WHEN d > 0 THEN ROUND(n / d, 2) ELSE 0.0 END AS readings_per_second
FROM g""",
    "stream_tumbling": _tumbling(CLOSED),
    "stream_tumbling_bp": _tumbling_bp(CLOSED_BP),
    "stream_dedup": f"""{BASE}
SELECT DISTINCT ON (patient_id, ts, sensor_type) {ALL_COLS}
FROM (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE event_id % 10 = 0)""",
    "stream_hop": f"""{BASE},
h AS (SELECT patient_id, sensor_type, value,
             time_bucket(INTERVAL 1 DAY, ts) - to_days(CAST(k AS INTEGER)) AS ws
      FROM (SELECT *, unnest(range(0, 6)) AS k FROM readings WHERE sensor_type <> 'blood_pressure'))
SELECT patient_id, sensor_type, ws AS window_start, ws + INTERVAL 6 DAY AS window_end,
       COUNT(*) AS count, {_avg('value')} AS avg, MIN(value) AS min, MAX(value) AS max
FROM h GROUP BY patient_id, sensor_type, ws
HAVING ws + INTERVAL 6 DAY <= (SELECT MAX(ts) FROM readings WHERE sensor_type <> 'blood_pressure') - INTERVAL 1 HOUR""",
    "jsonl_roundtrip": f"""{BASE}
SELECT {ALL_COLS} FROM readings""",
    "parquet_roundtrip": f"""{BASE}
SELECT {ALL_COLS} FROM readings""",
    "named_dataset": f"""{BASE}
SELECT {ALL_COLS} FROM readings""",
}

# Same results as the batch per-key trailing window, by other means.
ORACLE["stream_trailing_exact"] = ORACLE["trailing"]

ORACLE["jsonl_reference"] = f"""{BASE}
SELECT sensor_type, COUNT(*) AS count, {_avg('value')} AS avg, MIN(value) AS min, MAX(value) AS max,
       {_rd('STDDEV_SAMP(value)')} AS std
FROM (SELECT DISTINCT ON (patient_id, ts, sensor_type) * FROM readings ORDER BY value) GROUP BY sensor_type"""
for _name in ("jsonl_or_empty", "source_preference", "record_batches", "arrow_hand_off"):
    ORACLE[_name] = ORACLE["jsonl_roundtrip"]
ORACLE["corrupt_split"] = """
SELECT CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE 'good' END AS kind, COUNT(*) AS count FROM events GROUP BY 1"""
ORACLE["dataset_list"] = "SELECT COUNT(*) AS records, TRUE AS has_bytes FROM events"
ORACLE["report_file"] = ORACLE["sensor_stats"]
ORACLE["tagged_output"] = f"""{BASE},
s AS (SELECT * FROM readings WHERE sensor_type <> 'blood_pressure')
SELECT 'RAW' AS kind, '[RAW] {{' AS start, COUNT(*) AS count FROM s
UNION ALL SELECT 'AGG', '[AGG] {{', COUNT(*) FROM (SELECT DISTINCT patient_id, sensor_type, time_bucket(INTERVAL 1 DAY, ts) FROM s)"""
ORACLE["record_texts"] = f"""{BASE}
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000000') AS iso, COALESCE(systolic, CAST(0.0 AS DOUBLE)) AS systolic FROM readings"""
ORACLE["message_arrival"] = "SELECT COUNT(*) AS messages, COUNT(*) AS stamped FROM events"
ORACLE["stream_tumbling_update"] = ORACLE["message_tumbling"] = ORACLE["tumbling"]
ORACLE["stream_snapshot"] = f"""{BASE}
SELECT ws AS window_start, ws + INTERVAL 30 MINUTE AS window_end,
       (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / CAST(1000000.0 AS DOUBLE) AS window_duration, {_snapshot_cols('')}
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS ws FROM readings) GROUP BY ws"""
for _name in ("trailing", "trailing_current"):
    _body = ORACLE[_name][len(BASE):].replace("FROM readings", "FROM dirty_readings")
    for _key in ("patient_id", "sensor_type"):
        _body = _body.replace(f"s.{_key} = l.{_key}", f"s.{_key} IS NOT DISTINCT FROM l.{_key}")
    ORACLE[f"{_name}_dirty"] = BASE_DIRTY + _body
ORACLE["stream_trailing_dirty"] = ORACLE["trailing_dirty"]
ORACLE["state_current"] = ORACLE["trailing_current"]
ORACLE["stream_global_trailing"] = f"""SELECT DISTINCT * EXCLUDE (event_id) FROM ({ORACLE["global_trailing"]})
WHERE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""
ORACLE["stream_kpis"] = f"""{BASE}
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, COUNT(*) AS total_readings,
       COUNT(DISTINCT COALESCE(patient_id, 'unknown')) AS patients, CAST(COUNT(DISTINCT COALESCE(sensor_type, 'unknown')) AS INTEGER) AS sensor_types, MAX(ts) AS latest
FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS ws FROM readings) GROUP BY ws
HAVING ws + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM readings) - INTERVAL 1 HOUR"""
ORACLE["stream_progress"] = "SELECT CAST(4 AS BIGINT) AS batches, COUNT(*) AS input_rows FROM events"
ORACLE["corrupt_rows"] = f"""{BASE}
SELECT 'good' AS kind, concat_ws('|', event_id, patient_id, sensor_type, value) AS line FROM readings WHERE event_id % 13 <> 0
UNION ALL SELECT 'bad', '{{cut ' || CAST(event_id AS VARCHAR) FROM readings WHERE event_id % 13 = 0"""
ORACLE["dataset_tickets"] = f"""{BASE}
SELECT sensor_type, CAST(COUNT(*) * puts AS BIGINT) AS rows, CAST(COUNT(*) * puts AS BIGINT) AS records, t.ticket
FROM readings JOIN (VALUES ('pulse', 'Run-1', 2), ('temperature', 'run-1', 1), ('spo2', 'run_x2d_1', 1), ('blood_pressure', 'r/ü 1', 1)) t(sensor, ticket, puts)
  ON sensor_type = t.sensor GROUP BY sensor_type, t.ticket, puts"""
ORACLE["retention_sink"] = f"""{BASE}
SELECT {ALL_COLS} FROM readings WHERE CAST(ts AS DATE) >= (SELECT CAST(MAX(ts) AS DATE) FROM readings) - 1"""
_report, _columns = _quality()[len(BASE):].rsplit("SELECT total_records", 1)
ORACLE["analysis_observed"] = f"""{BASE_DIRTY}{_report.replace("FROM readings)", "FROM dirty_readings)")},
cleaned AS (SELECT COUNT(*) AS cleaned_records FROM ({ORACLE["clean_required"][len(BASE_DIRTY):]}))
SELECT total_records{_columns.replace(" FROM c", ", cleaned_records FROM c, cleaned")}"""
ORACLE["dedup_history"] = ORACLE["clean_required"]
ORACLE["rounded_values"] = f"""{BASE}
SELECT event_id, CAST(ROUND(CAST(CAST(value AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DOUBLE) AS value FROM readings WHERE sensor_type <> 'blood_pressure'"""
ORACLE["jsonl_blank_lines"] = f"""{BASE}
SELECT event_id, patient_id, sensor_type, value FROM readings"""
ORACLE["tagged_lines"] = f"""{BASE}
SELECT 'RAW' AS kind, patient_id, sensor_type, value, CAST({_scalar_valid()} AS VARCHAR) AS is_valid,
       CAST(NULL AS DOUBLE) AS count, CAST(NULL AS DOUBLE) AS avg, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max
FROM readings WHERE sensor_type <> 'blood_pressure'
UNION ALL
SELECT 'AGG', patient_id, sensor_type, CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(COUNT(*) AS DOUBLE), {_avg('value')}, MIN(value), MAX(value)
FROM readings WHERE sensor_type <> 'blood_pressure' GROUP BY patient_id, sensor_type, time_bucket(INTERVAL 1 DAY, ts)"""
ORACLE["batch_files"] = "SELECT COUNT(*) AS rows, TRUE AS within, TRUE AS enough_files FROM events"
