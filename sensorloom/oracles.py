"""Independent SQL (DuckDB dialect) for the named queries of :mod:`sensorloom.catalog`."""

from sensorloom import catalog as C
from sensorloom.operators.features import FeatureSpec, SIGNAL_FEATURES
from sensorloom.schema import SIGNALS, TELEMETRY_COLUMNS
from sensorloom.sources.events_view import TELEMETRY_SQL

# Written out, not taken from the code under test: routes, severities and root causes of fault tags, and score limits.
DEFAULT_ROUTE = "triage"
TAG_ROUTES = {
    "bearing_wear": ("maintenance", "WARNING", "Mechanical degradation: bearing wear pattern detected"),
    "overheat_drift": ("thermal", "WARNING", "Thermal anomaly: temperature/overheat drift pattern detected"),
    "sensor_dropout": ("instrumentation", "INFO", "Instrumentation fault: sensor dropout pattern detected"),
    "power_spike": ("electrical", "CRITICAL", "Electrical fault: power/voltage spike detected"),
}
SEVERITY_SCORES = (0.11, 0.15)

COLUMNS = ", ".join(TELEMETRY_COLUMNS)
SPEC = FeatureSpec()


def grid(expr: str, places: int = 6) -> str:
    return f"round({expr} + {0.37182818 * 10.0 ** -places!r}, {places})"


def telemetry(*ctes: str) -> str:
    body = TELEMETRY_SQL.replace("{events}", "events")
    return ",\n".join([f"WITH RECURSIVE telemetry AS ({body})", *ctes]) + "\n"


TAG = "trim(coalesce(anomaly_tag, ''))"
CLEAN_TAG = f"CASE WHEN {TAG} IN ('nan', 'None', 'NULL', 'null') THEN '' ELSE {TAG} END"

TAGGED = f"""tagged AS (
  SELECT *, {CLEAN_TAG} AS tag, CAST(({CLEAN_TAG}) <> '' AS INT) AS y,
         CAST(score >= {C.THRESHOLD} AS INT) AS pred FROM telemetry)"""

W = "PARTITION BY device_id ORDER BY timestamp, event_id"

FILLED = "filled AS (SELECT *, " + ", ".join(
    f"CAST(last_value({s} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS f_{s}"
    for s in SIGNALS) + " FROM tagged)"
MEDIANS = "medians AS (SELECT " + ", ".join(f"median(f_{s}) AS m_{s}" for s in SIGNALS) + " FROM filled)"
READINGS = "readings AS (SELECT filled.*, " + ", ".join(
    f"coalesce(f_{s}, m_{s}) AS x_{s}" for s in SIGNALS) + f""",
  row_number() OVER ({W}) AS pos,
  coalesce(state <> lag(state) OVER ({W}), true) AS changed,
  coalesce(error_code, 0) <> 0 AS failed
  FROM filled, medians)"""


def _signal_columns(s: str) -> str:
    x, enough = f"x_{s}", f"pos >= {SPEC.min_rows}"
    mean, std = f"avg({x}) OVER recent", f"stddev_samp({x}) OVER recent"
    n = f"least(pos, {SPEC.window})"
    swing = f"sum(CASE WHEN pos % 2 = 0 THEN {x} ELSE -{x} END) OVER recent"
    cases = {
        "mean": mean, "std": std, "min": f"min({x}) OVER recent", "max": f"max({x}) OVER recent",
        "trend": mean, "resid": f"{x} - {mean}", "delta": f"{x} - {mean}",
        "zscore": f"({x} - {mean}) / ({std} + 1e-6)",
    }
    columns = [f"CASE WHEN {enough} THEN {e} ELSE 0.0 END AS {s}_{k}" for k, e in cases.items()]
    columns.append(f"coalesce({x} - lag({x}) OVER device, 0.0) AS {s}_diff")
    columns.append(f"""CASE WHEN pos >= {SPEC.spectral_min_rows} THEN
      ({n} * {n} * var_pop({x}) OVER recent + CASE WHEN {n} % 2 = 0 THEN pow({swing}, 2) ELSE 0 END) / 2
      ELSE 0.0 END AS {s}_fft_energy""")
    return ",\n".join(columns)


STEP = """gaps AS (SELECT epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (ORDER BY timestamp) AS gap FROM telemetry),
step AS (SELECT CAST(greatest(1, round_even(median(gap) / 1e6, 0)) AS INT) AS step_s FROM gaps)"""

FEATURES = f"""islands AS (
  SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS island FROM readings),
matrix AS (
  SELECT event_id, device_id, timestamp, y, tag, state,
  {", ".join(_signal_columns(s) for s in SIGNALS)},
  CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY device_id, island ORDER BY timestamp, event_id
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS error_streak,
  coalesce((epoch_us(timestamp) - epoch_us(max(CASE WHEN failed THEN timestamp END) OVER sofar)) / 1e6, 1e9) AS time_since_error_s,
  CAST(changed AS DOUBLE) AS state_change,
  CASE WHEN pos >= {SPEC.min_rows} THEN CAST(sum(CAST(changed AS INT)) OVER recent AS DOUBLE) ELSE 0.0 END AS state_change_count,
  coalesce((epoch_us(timestamp) - epoch_us(max(CASE WHEN changed THEN timestamp END) OVER sofar)) / 1e6, 1e9) AS time_since_state_change_s,
  sin(2 * pi() * bin / bins) AS phase_sin, cos(2 * pi() * bin / bins) AS phase_cos
  FROM (SELECT islands.*, bins, least((epoch_us(timestamp) // 1000000 % 600) // step_s, bins - 1) AS bin
        FROM islands, (SELECT step_s, greatest(1, CAST(round_even(600 / step_s, 0) AS INT)) AS bins FROM step)) q
  WINDOW device AS ({W}), sofar AS ({W} ROWS UNBOUNDED PRECEDING),
         recent AS ({W} ROWS BETWEEN {SPEC.window - 1} PRECEDING AND CURRENT ROW))"""

FEATURE_CTES = [TAGGED, FILLED, MEDIANS, READINGS, STEP, FEATURES]

DOMINANT = f"""frames AS (
  SELECT event_id, pos, {", ".join(f"list(x_{s}) OVER w AS l_{s}" for s in SIGNALS)} FROM readings
  WINDOW w AS ({W} ROWS BETWEEN {SPEC.window - 1} PRECEDING AND CURRENT ROW)),
long AS ({" UNION ALL ".join(f"SELECT event_id, '{s}' AS signal, len(l_{s}) AS n, l_{s} AS l FROM frames WHERE pos >= {SPEC.spectral_min_rows}" for s in SIGNALS)}),
points AS (SELECT event_id, signal, n, unnest(l) - list_avg(l) AS d, unnest(range(n)) AS i, list_max(l) = list_min(l) AS flat FROM long),
powers AS (
  SELECT event_id, signal, b, any_value(flat) AS flat,
         pow(sum(d * cos(2 * pi() * i * b / n)), 2) + pow(sum(d * sin(2 * pi() * i * b / n)), 2) AS p
  FROM points, range(1, 16) bins(b) WHERE b <= n // 2 GROUP BY event_id, signal, b),
best AS (SELECT *, max(p) OVER (PARTITION BY event_id, signal) AS top FROM powers),
bins AS (SELECT event_id, signal, CASE WHEN any_value(flat) THEN 1 ELSE min(b) END AS bin
         FROM best WHERE flat OR p >= top * (1 - 1e-9) GROUP BY event_id, signal),
dominant AS (
  SELECT r.event_id, {", ".join(f"coalesce(max(CASE WHEN signal = '{s}' THEN bin END), 0)::DOUBLE AS {s}_fft_dom_bin" for s in SIGNALS)}
  FROM readings r LEFT JOIN bins USING (event_id) GROUP BY r.event_id)"""


# Energy straight from the transform: the powers of the half spectrum without its constant part.
ENERGY = "energies AS (SELECT event_id, signal, sum(p) AS e FROM powers GROUP BY event_id, signal)"


def energies(signals, where: str = "true") -> str:
    columns = ", ".join(f"{grid(f'coalesce(max(CASE WHEN signal = {chr(39)}{s}{chr(39)} THEN e END), 0)', 3)} AS {s}_fft_energy" for s in signals)
    return f"SELECT r.event_id, {columns} FROM readings r LEFT JOIN energies USING (event_id) WHERE {where} GROUP BY r.event_id"


SPIKED = f"""telemetry AS (SELECT * EXCLUDE (n) REPLACE (
    CASE WHEN n = {C.SPIKE_ROW} THEN 1e9 WHEN n = {C.LOST_ROW} THEN NULL ELSE temp_c END AS temp_c)
  FROM (SELECT *, row_number() OVER ({W}) AS n FROM plain))"""


def features(*names: str, places: int = 6) -> str:
    return telemetry(*FEATURE_CTES) + "SELECT event_id, " + ", ".join(
        f"{grid(n, places)} AS {n}" for n in names) + " FROM matrix"


def per_signal(*kinds: str) -> list[str]:
    return [f"{s}_{k}" for s in SIGNALS for k in kinds]


# --- attribution -----------------------------------------------------------------

# Family and position of each explained feature, written out by hand.
FAMILIES = {"rpm_level": "RPM", "temp_c_level": "Temperature", "vibration_g_level": "Vibration",
            "current_a_level": "Current", "voltage_v_level": "Voltage", "error_level": "Error/Flags",
            "state_idle": "State", "time_hour": "Time", "phase_step": "Other"}

_RAW = {**{f"{s}_level": f"coalesce({s}, 0)::DOUBLE" for s in SIGNALS},
        "error_level": "error_code::DOUBLE", "state_idle": "(state = 'IDLE')::INT::DOUBLE",
        "time_hour": "hour(timestamp)::DOUBLE", "phase_step": "(event_id % 7)::DOUBLE"}

RAW = "raw AS (SELECT *, " + ", ".join(f"{e} AS {f}" for f, e in _RAW.items()) + " FROM tagged)"
SCALER = "scaler AS (SELECT " + ", ".join(
    f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}" for f in _RAW) + " FROM raw)"
ZED = "zed AS (SELECT raw.* EXCLUDE (" + ", ".join(_RAW) + "), " + ", ".join(
    f"({f} - m_{f}) / s_{f} AS {f}" for f in _RAW) + " FROM raw, scaler)"
SHARES = "shares AS (" + " UNION ALL ".join(
    f"SELECT event_id, {i} AS i, '{f}' AS feature, '{FAMILIES[f]}' AS family, 100 * abs({f}) / ({' + '.join(f'abs({g})' for g in _RAW)}) AS pct, pred FROM zed"
    for i, f in enumerate(_RAW)) + ")"
BY_FAMILY = "by_family AS (SELECT event_id, family, sum(pct) AS pct FROM shares WHERE pred = 1 GROUP BY event_id, family)"
ATTRIBUTION = [TAGGED, RAW, SCALER, ZED, SHARES, BY_FAMILY]


# --- alerts ----------------------------------------------------------------------

def _tag_case(column: str, position: int, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{t}' THEN '{v[position]}'" for t, v in TAG_ROUTES.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


SEVERITY = (f"CASE WHEN score >= {SEVERITY_SCORES[1]} THEN 'CRITICAL' "
            f"WHEN score >= {SEVERITY_SCORES[0]} THEN 'WARNING' ELSE 'INFO' END")

TOPS = """tops AS (SELECT event_id, arg_max(family, pct) AS top_family, count(*) AS n_families FROM by_family GROUP BY event_id)"""
RULE_LIST = """rules(ord, rule, cause, family, threshold, parts) AS (VALUES
  (0, 'two_sensors', 'Temperature and current together', 'Temperature', 20.0, 2),
  (0, 'two_sensors', 'Temperature and current together', 'Current', 20.0, 2),
  (1, 'hot', 'Temperature dominates', 'Temperature', 30.0, 1),
  (2, 'errors', 'Error codes dominate', 'Error/Flags', 40.0, 1))"""
MATCHES = """matches AS (
  SELECT f.event_id, r.ord, r.rule, r.cause, avg(least(1.0, f.pct / r.threshold)) AS conf
  FROM by_family f JOIN rules r ON f.family = r.family AND f.pct >= r.threshold
  GROUP BY f.event_id, r.ord, r.rule, r.cause, r.parts HAVING count(*) = r.parts),
matched AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY conf DESC, ord) = 1)"""
BUILT = f"""built AS (
  SELECT t.event_id AS pos, CAST(t.timestamp AS VARCHAR) AS timestamp, t.timestamp AS ts, t.device_id, t.state, t.score AS raw_score,
    coalesce({_tag_case('tag', 1)}, {SEVERITY}) AS severity, t.tag, {_tag_case('tag', 0, f"'{DEFAULT_ROUTE}'")} AS route,
    CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN concat('tag_route::', tag) ELSE coalesce(m.rule, 'fallback_top_family') END AS rule_name,
    coalesce({_tag_case('tag', 2)}, m.cause, concat('Anomaly dominated by ', top_family)) AS root_cause,
    CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN 1.0 ELSE coalesce(m.conf, 0.0) END AS conf,
    n_families
  FROM tagged t JOIN tops USING (event_id) LEFT JOIN matched m USING (event_id) WHERE t.pred = 1)"""
ALERTS = [*ATTRIBUTION, TOPS, RULE_LIST, MATCHES, BUILT]
ALERT_COLUMNS = f"""timestamp, device_id, state, {grid('raw_score')} AS score, severity, tag, route, route AS queue,
  rule_name, rule_name AS rule_id, root_cause, root_cause AS cause, {grid('conf')} AS confidence, n_families"""
ALERT_ID = "concat(rule_name, ':', device_id, ':', timestamp) AS alert_id"

# --- bursts ----------------------------------------------------------------------


def burst_ctes(where: str = "pred = 1", minutes: int = C.BURST_MINUTES, least: int = C.BURST_COUNT) -> list[str]:
    span = f"INTERVAL {minutes} MINUTES"
    return [f"anomalies AS (SELECT device_id, timestamp FROM tagged WHERE {where})",
            f"""counted AS (SELECT *, count(*) OVER w AS n_events, min(timestamp) OVER w AS window_start FROM anomalies
      WINDOW w AS (PARTITION BY device_id ORDER BY timestamp RANGE BETWEEN {span} PRECEDING AND CURRENT ROW))""",
            f"hits AS (SELECT * FROM counted WHERE n_events >= {least})",
            f"""linked AS (SELECT *, coalesce(timestamp - lag(timestamp) OVER w > {span}, true) AS starts FROM hits
      WINDOW w AS (PARTITION BY device_id ORDER BY timestamp))""",
            """grouped AS (SELECT *, sum(starts::INT) OVER (PARTITION BY device_id ORDER BY timestamp) AS island FROM linked)""",
            """bounds AS (SELECT device_id, island, min(window_start) AS burst_start, max(timestamp) AS burst_end
      FROM grouped GROUP BY device_id, island)""",
            f"""bursts AS (SELECT b.device_id, b.burst_start, b.burst_end, count(*) AS n_events
      FROM bounds b JOIN anomalies a ON a.device_id = b.device_id AND a.timestamp BETWEEN b.burst_start AND b.burst_end
      GROUP BY b.device_id, b.burst_start, b.burst_end)"""]


def cooled(minutes: int) -> str:
    return f"""ordered AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY burst_start) AS i FROM bursts),
walk AS (
  SELECT device_id, i, true AS kept, burst_end AS quiet_from FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.device_id, o.i, o.burst_start >= w.quiet_from + INTERVAL {minutes} MINUTES,
         CASE WHEN o.burst_start >= w.quiet_from + INTERVAL {minutes} MINUTES THEN o.burst_end ELSE w.quiet_from END
  FROM walk w JOIN ordered o ON o.device_id = w.device_id AND o.i = w.i + 1),
cooled AS (SELECT o.* EXCLUDE i FROM ordered o JOIN walk w USING (device_id, i) WHERE w.kept)"""


COOLED = cooled(C.COOLDOWN_MINUTES)

BURST_TEXT = f"concat(n_events, ' anomalies within {C.BURST_MINUTES:g}-minute windows') AS message"


def _evaluated() -> str:
    gate = "score >= 0.12"
    row = lambda rule, sev, route, message, conf, where: f"""
      SELECT '{'dominant_family' if rule == 'dominant-temperature' else 'tag_route'}' AS kind, '{rule}' AS rule_id, device_id, timestamp,
        CAST(NULL AS TIMESTAMP) AS burst_start, CAST(NULL AS DOUBLE) AS n_events, {grid('score')} AS score,
        '{sev}' AS severity, {route} AS route, '{message}' AS message, {conf} AS confidence
      FROM tagged WHERE pred = 1 AND {where}"""
    hot = "event_id IN (SELECT event_id FROM by_family WHERE family = 'Temperature' AND pct >= 30)"
    one = grid("1.0")
    return telemetry(*ATTRIBUTION, *burst_ctes(f"pred = 1 AND {gate}"), COOLED) + " UNION ALL ".join([
        row("dominant-temperature", "WARNING", _tag_case("tag", 0, "'triage'"), "Temperature share is high", one,
            f"{gate} AND {hot}"),
        row("bearing", "WARNING", "'maintenance'", "bearing", one, "tag = 'bearing_wear'"),
        row("overheat", "WARNING", "'thermal'", "overheat", one, "tag = 'overheat_drift'"),
        f"""SELECT 'burst', 'burst-72h', device_id, burst_end, burst_start, CAST(n_events AS DOUBLE), NULL, 'CRITICAL', 'triage',
        {BURST_TEXT.split(' AS ')[0]}, {one} FROM cooled"""])


def _burst_rules() -> str:
    rules = [("burst-72h", 72 * 60, 3, 0.12, 10 * 24 * 60, "CRITICAL", None), ("burst-24h", 24 * 60, 2, 0.14, 0, "WARNING", None),
             ("burst-7d", 7 * 24 * 60, 4, 0.13, 24 * 60, "INFO", "many in a week")]
    parts = []
    for name, minutes, least, score, quiet, severity, message in rules:
        text = f"'{message}'" if message else f"concat(n_events, ' anomalies within {minutes}-minute windows')"
        parts.append("SELECT * FROM (" + telemetry(TAGGED, *burst_ctes(f"pred = 1 AND score >= {score}", minutes, least), cooled(quiet)) + f"""
          SELECT '{name}' AS rule_id, device_id, burst_end AS timestamp, burst_start, n_events, '{severity}' AS severity, 'triage' AS route,
            {text} AS message FROM cooled)""")
    return " UNION ALL ".join(parts)


# --- evaluation ------------------------------------------------------------------

AUC = """ranked AS (SELECT y, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM tagged),
auc AS (SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS roc_auc FROM ranked)"""


def _sweep(thresholds: str) -> str:
    return telemetry(TAGGED, AUC, f"thresholds AS ({thresholds})") + f"""
      SELECT {grid('t')} AS threshold, {grid('coalesce(tp / nullif(n, 0), 0)')} AS precision, {grid('tp / p')} AS recall,
             {grid('2 * tp / (n + p)')} AS f1, {grid('roc_auc')} AS roc_auc
      FROM (SELECT t, sum(CASE WHEN score >= t AND y = 1 THEN 1.0 ELSE 0.0 END) AS tp,
                   sum(CASE WHEN score >= t THEN 1.0 ELSE 0.0 END) AS n, sum(y) AS p
            FROM tagged, thresholds GROUP BY t) q, auc"""


QUANTILES = " UNION ".join(f"SELECT quantile_cont(score, {q}) AS t FROM tagged" for q in (.90, .92, .94, .96, .98))


def _summary(key: str) -> str:
    return telemetry(*ATTRIBUTION, f"""keyed AS (SELECT z.*, {key} AS group_key FROM zed z WHERE pred = 1),
      fams AS (SELECT group_key, family, sum(f.pct) AS pct FROM keyed JOIN by_family f USING (event_id) GROUP BY ALL),
      scaled AS (SELECT *, 100 * pct / sum(pct) OVER (PARTITION BY group_key) AS share,
                 row_number() OVER (PARTITION BY group_key ORDER BY pct DESC, family) AS o FROM fams),
      tops5 AS (SELECT group_key, string_agg(family, '>' ORDER BY o) AS families, max(share) AS top_pct
                FROM scaled WHERE o <= 5 GROUP BY group_key)""") + f"""
      SELECT group_key, n_flagged, {grid('avg_score')} AS avg_score, {grid('p95')} AS p95_score,
             {grid('top_pct')} AS top_pct, families
      FROM (SELECT group_key, count(*) AS n_flagged, avg(score) AS avg_score, quantile_cont(score, 0.95) AS p95
            FROM keyed GROUP BY group_key) s JOIN tops5 USING (group_key)"""


def _aggregates(tail: str = "") -> str:
    return telemetry(TAGGED) + f"""SELECT device_id, count(*) AS n_flagged, {grid('avg(score)')} AS avg_score,
      {grid('quantile_cont(score, 0.95)')} AS p95_score FROM tagged WHERE pred = 1 GROUP BY device_id {tail}"""


def simple(select: str, *ctes: str) -> str:
    return telemetry(*ctes) + select


_OUT = {c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in TELEMETRY_COLUMNS}
_RANGES = """count(*) FILTER (rpm < 0) AS rpm_negative, count(*) FILTER (temp_c < -20 OR temp_c > 120) AS temp_out_of_bounds,
  count(*) FILTER (voltage_v < 20 OR voltage_v > 30) AS voltage_out_of_bounds"""
_LISTED = "(SELECT string_agg(concat(k, '=', n), ',' ORDER BY n DESC, k) FROM ({}))"

ORACLES = {
    "read_telemetry_csv": simple(f"SELECT {COLUMNS} FROM telemetry"),
    "ingest_telemetry": simple(f"""SELECT count(*) FILTER (timestamp < '{C.STORED_UNTIL}') AS inserted_1,
        count(*) FILTER (timestamp >= '{C.STORED_UNTIL}') AS inserted_2, 0::BIGINT AS inserted_3, count(*) AS stored FROM telemetry"""),
    "rows_to_insert": simple(f"""SELECT {COLUMNS} FROM telemetry n WHERE NOT EXISTS (SELECT 1 FROM telemetry o
        WHERE o.timestamp < '{C.STORED_UNTIL}' AND o.device_id = n.device_id AND o.timestamp = n.timestamp)"""),
    "load_telemetry": simple(f"SELECT {COLUMNS} FROM telemetry"),
    "load_telemetry_limit": simple(f"SELECT {COLUMNS} FROM telemetry ORDER BY timestamp, device_id LIMIT 500"),
    "read_alerts": simple(f"SELECT {ALERT_COLUMNS} FROM built", *ALERTS),
    "read_aggregates": _aggregates(),
    "read_alerts_document": simple(f"SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, {ALERT_COLUMNS} FROM built", *ALERTS),
    "read_aggregates_document": _aggregates(),
    "read_metrics": simple(f"SELECT {grid('avg(y)')} AS anomaly_rate, {grid('avg((error_code <> 0)::INT)')} AS error_rate FROM tagged", TAGGED),
    "read_explanations": simple(f"""SELECT event_id, device_id, CASE WHEN tag = '' THEN '(unlabeled)' ELSE tag END AS anomaly_tag,
        {grid('score')} AS score, count(*) AS n_families FROM tagged JOIN by_family USING (event_id)
        GROUP BY event_id, device_id, tag, score""", *ATTRIBUTION),
    "alert_by_id": simple(f"""SELECT {ALERT_ID}, pos, {ALERT_COLUMNS} FROM built WHERE pos = (
        SELECT min(pos) FROM built WHERE device_id = '{C.DEVICE}')""", *ALERTS),
    "aggregate_by_device": f"SELECT * FROM ({_aggregates()}) WHERE device_id = '{C.DEVICE}'",
    "device_window": simple(f"""SELECT * FROM telemetry WHERE device_id = '{C.DEVICE}'
        AND timestamp >= '{C.START}' AND timestamp < '{C.END}'"""),
    "latest_rows": simple("SELECT * FROM telemetry ORDER BY timestamp DESC, event_id LIMIT 10"),
    "latest_per_device": simple("""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY device_id
        ORDER BY timestamp DESC, event_id) AS INT) AS rank FROM telemetry) WHERE rank <= 3"""),
    "recent_device_window": simple("""SELECT t.* FROM telemetry t, (SELECT device_id AS d, timestamp AS e FROM telemetry
        ORDER BY timestamp DESC, event_id LIMIT 1) WHERE device_id = d AND timestamp < e AND timestamp >= e - INTERVAL 3 DAYS"""),
    "normalize_tag": simple("SELECT event_id, tag, y FROM tagged", TAGGED),
    "training_rows": simple("SELECT event_id, state FROM tagged WHERE state IN ('RUN', 'IDLE') AND y = 0", TAGGED),
    "flag": simple("SELECT event_id, score, pred FROM tagged", TAGGED),
    "alert_feed": simple(f"""SELECT {ALERT_ID}, pos, {ALERT_COLUMNS} FROM built WHERE lower(severity) = 'critical'
        AND lower(route) = 'electrical' AND ts >= TIMESTAMP '{C.SINCE[:10]} 00:00:00' ORDER BY ts DESC, pos LIMIT 100""", *ALERTS),
    "alert_feed_all": simple(f"SELECT {ALERT_ID}, pos, {ALERT_COLUMNS} FROM built ORDER BY ts DESC, pos LIMIT 200", *ALERTS),
    "aggregate_feed": _aggregates("ORDER BY quantile_cont(score, 0.95) DESC, device_id LIMIT 50"),
    "aggregate_feed_extra": f"""SELECT device_id, n_flagged, p95_score, 'R' || (k % 7) AS room,
        CASE k % 5 WHEN 0 THEN n_flagged::VARCHAR WHEN 1 THEN '"r' || n_flagged || '"' WHEN 2 THEN 'true' WHEN 3 THEN '{{"n":' || n_flagged || '}}' END AS load
      FROM (SELECT *, substr(device_id, 5)::INT AS k FROM ({_aggregates()}))
      ORDER BY CASE k % 5 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 0 END DESC,
        CASE k % 5 WHEN 0 THEN n_flagged WHEN 2 THEN 1 WHEN 4 THEN -1 END DESC,
        CASE k % 5 WHEN 1 THEN 'r' || n_flagged WHEN 3 THEN '{{"n":' || n_flagged || '}}' END DESC, device_id LIMIT 200""",
    "alert_feed_extra": simple(f"""SELECT {ALERT_ID}, device_id, {grid('raw_score')} AS score, pos AS ticket, true AS open FROM built
        WHERE lower(severity) = 'critical' ORDER BY ts DESC, pos LIMIT 300""", *ALERTS),
    "missing_rates": simple(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {grid(e)} AS missing_rate FROM telemetry" for c, e in _OUT.items())),
    "range_checks": simple(f"SELECT {_RANGES} FROM telemetry"),
    "validation_report": simple(f"""SELECT count(*) AS rows, true AS schema_valid, 0 AS n_missing_columns,
        {", ".join(f"{grid(e)} AS missing_{c}" for c, e in _OUT.items())}, {_RANGES} FROM telemetry"""),
    "row_count": simple("SELECT count(*) AS rows FROM telemetry"),
    "time_bounds": simple("SELECT min(timestamp) AS min_ts, max(timestamp) AS max_ts FROM telemetry"),
    "rows_per_device": simple("SELECT device_id, count(*) AS rows FROM telemetry GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "anomaly_rate": simple(f"SELECT {grid('avg(y)')} AS anomaly_rate FROM tagged", TAGGED),
    "anomalies_by_tag": simple("SELECT tag, count(*) AS rows FROM tagged WHERE y = 1 GROUP BY tag", TAGGED),
    "error_code_rate": simple(f"SELECT {grid('avg((error_code <> 0)::INT)')} AS error_rate FROM telemetry"),
    "errors_by_code": simple("SELECT error_code, count(*) AS rows FROM telemetry WHERE error_code <> 0 GROUP BY 1"),
    "ops_metrics": simple(f"""SELECT count(*) AS row_count, min(timestamp) AS min_ts, max(timestamp) AS max_ts,
        {_LISTED.format("SELECT device_id AS k, count(*) AS n FROM tagged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")} AS rows_per_device,
        {grid('avg(y)')} AS anomaly_rate,
        {_LISTED.format("SELECT tag AS k, count(*) AS n FROM tagged WHERE y = 1 GROUP BY 1")} AS by_tag,
        {grid('avg((error_code <> 0)::INT)')} AS error_rate,
        {_LISTED.format("SELECT error_code AS k, count(*) AS n FROM tagged WHERE error_code <> 0 GROUP BY 1")} AS by_code
        FROM tagged""", TAGGED),
    "label_breakdown": simple("SELECT y, count(*) AS rows FROM tagged WHERE state IN ('RUN', 'IDLE') GROUP BY y", TAGGED),
    "sample_step_seconds": simple("""SELECT step_s, (SELECT CAST(greatest(1, round_even(median(g) / 1e6, 0)) AS INT) FROM (
        SELECT epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY device_id ORDER BY timestamp) AS g FROM telemetry))
        AS device_step_s FROM step""", STEP),
    "signal_medians": simple("SELECT " + ", ".join(f"{grid(f'm_{s}')} AS {s}" for s in SIGNALS) + " FROM medians",
                             TAGGED, FILLED, MEDIANS),
    "score_quantile_thresholds": simple(f"SELECT {grid('t')} AS threshold FROM ({QUANTILES})", TAGGED),
    "threshold_sweep": _sweep(QUANTILES),
    "threshold_sweep_given": _sweep("SELECT unnest(" + str(C.SWEEP) + "::DOUBLE[]) AS t"),
    "roc_auc": simple(f"SELECT {grid('roc_auc')} AS roc_auc FROM auc", TAGGED, AUC),
    "per_tag_recall": simple(f"""SELECT tag, {grid('avg(pred)')} AS recall, sum(pred)::BIGINT AS tp, sum(1 - pred)::BIGINT AS fn
        FROM tagged WHERE y = 1 GROUP BY tag""", TAGGED),
    "aggregate_explanations": _summary("device_id"),
    "aggregate_explanations_by_tag": _summary("CASE WHEN tag = '' THEN '(unlabeled)' ELSE tag END"),
    "aggregate_explanations_fleet": _summary("'fleet'"),
    "fleet_buckets": simple(" UNION ALL ".join(f"""SELECT '{name}' AS bucket, count(DISTINCT device_id) AS devices, count(*) AS alerts,
        {grid(f"avg(CASE {SEVERITY} WHEN 'CRITICAL' THEN 30 WHEN 'WARNING' THEN 20 ELSE 10 END)")} AS avg_severity FROM tagged
        WHERE pred = 1 AND timestamp > (SELECT max(timestamp) FROM tagged WHERE pred = 1) - INTERVAL {h} HOURS
        HAVING count(*) > 0""" for name, h in (("Last 1h", 1), ("Last 24h", 24))), TAGGED),
    "anomaly_rate_over_time": simple(f"SELECT date_trunc('hour', timestamp) AS time, {grid('avg(pred)')} AS rate, count(*) AS rows FROM tagged GROUP BY 1", TAGGED),
    "alerts_by_route": simple("SELECT route, count(*) AS alerts FROM built GROUP BY route", *ALERTS),
    "ffill_signals": simple("SELECT event_id, " + ", ".join(f"f_{s} AS {s}" for s in SIGNALS) + " FROM filled", TAGGED, FILLED),
    "median_fill": simple("SELECT event_id, " + ", ".join(f"{grid(f'x_{s}')} AS {s}" for s in SIGNALS) + " FROM readings",
                          TAGGED, FILLED, MEDIANS, READINGS),
    **{f"rolling_{k}": features(*per_signal(k)) for k in ("mean", "std", "min", "max")},
    "trend_resid": features(*per_signal("trend", "resid")),
    "delta_zscore": features(*per_signal("delta", "zscore")),
    "diff": features(*per_signal("diff")),
    "fft_energy": telemetry(TAGGED, FILLED, MEDIANS, READINGS, DOMINANT, ENERGY) + energies(SIGNALS),
    "feature_matrix_spikes": telemetry(SPIKED, *FEATURE_CTES, DOMINANT, ENERGY).replace("RECURSIVE telemetry AS", "RECURSIVE plain AS", 1) + f"""
        SELECT event_id, {", ".join(f"{grid(f'temp_c_{k}')} AS temp_c_{k}" for k in ("mean", "std", "zscore"))}, e.temp_c_fft_energy
        FROM matrix JOIN ({energies(["temp_c"], f"r.pos > {C.LOST_ROW + SPEC.window}")}) e USING (event_id)""",
    "fft_dom_bin": telemetry(TAGGED, FILLED, MEDIANS, READINGS, DOMINANT) + "SELECT * FROM dominant",
    **{n: features(n) for n in ("error_streak", "time_since_error_s", "state_change", "state_change_count",
                                "time_since_state_change_s")},
    "phase": features("phase_sin", "phase_cos"),
    "feature_matrix": telemetry(*FEATURE_CTES, DOMINANT) + "SELECT event_id, device_id, timestamp, y, " + ", ".join(
        n if n.endswith("dom_bin") else f"{grid(n, 3 if n.endswith('energy') else 6)} AS {n}"
        for n in ["phase_sin", "phase_cos", *per_signal(*SIGNAL_FEATURES), "error_streak", "time_since_error_s",
                  "state_change", "state_change_count", "time_since_state_change_s"])
        + " FROM matrix JOIN dominant USING (event_id)",
    "fit_scaler": simple(" UNION ALL ".join(
        f"SELECT '{f}' AS feature, {grid(f'm_{f}')} AS mean, {grid(f's_{f}')} AS std FROM scaler" for f in _RAW), TAGGED, RAW, SCALER),
    "standardize": simple("SELECT event_id, " + ", ".join(f"{grid(f)} AS {f}" for f in _RAW) + " FROM zed", TAGGED, RAW, SCALER, ZED),
    "training_features": telemetry(TAGGED + " WHERE state IN ('RUN', 'IDLE'))", *FEATURE_CTES[1:]).replace(
        "FROM telemetry) WHERE state", "FROM telemetry WHERE state") + f"""SELECT event_id, y, {grid('temp_c_mean')} AS temp_c_mean,
        {grid('error_streak')} AS error_streak FROM matrix WHERE y = 0""",
    "contributions": simple(f"""SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY pct DESC, i) - 1 AS INT) AS ord,
        feature, {grid('pct')} AS pct FROM shares""", *ATTRIBUTION),
    "top_features": simple(f"""SELECT event_id, CAST(ord AS INT) AS ord, feature, {grid('pct')} AS pct FROM (SELECT *, row_number() OVER (
        PARTITION BY event_id ORDER BY pct DESC, i) - 1 AS ord FROM shares WHERE pred = 1) WHERE ord < 5""", *ATTRIBUTION),
    "family_totals": simple(f"SELECT event_id, family, {grid('pct')} AS pct FROM by_family", *ATTRIBUTION),
    "top_anomalies": simple("SELECT event_id, device_id, timestamp, score FROM telemetry ORDER BY score DESC, event_id LIMIT 20"),
    "explain_rows": simple(f"""SELECT t.event_id, t.device_id, t.timestamp, t.state,
        CASE WHEN tag = '' THEN '(unlabeled)' ELSE tag END AS anomaly_tag, t.pred,
        CAST(row_number() OVER (PARTITION BY t.event_id ORDER BY pct DESC, family) - 1 AS INT) AS ord, family, {grid('pct')} AS pct
        FROM tagged t JOIN by_family USING (event_id)""", *ATTRIBUTION),
    "score_severity": simple(f"SELECT event_id, {SEVERITY} AS severity FROM telemetry"),
    "tag_route": simple(f"""SELECT event_id, tag, {_tag_case('tag', 0, "'triage'")} AS route, {_tag_case('tag', 1)} AS tag_severity,
        {_tag_case('tag', 2)} AS root_cause, CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN concat('tag_route::', tag) END AS rule_name,
        CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS confidence FROM tagged""", TAGGED),
    "tag_route_table": simple(f"""SELECT event_id, tag, CASE tag WHEN 'mystery_fault' THEN 'electrical' WHEN 'bearing_wear' THEN 'workshop'
        ELSE {_tag_case('tag', 0, "'triage'")} END AS route, CASE tag WHEN 'mystery_fault' THEN NULL WHEN 'bearing_wear' THEN 'CRITICAL'
        ELSE {_tag_case('tag', 1)} END AS tag_severity FROM tagged""", TAGGED),
    "match_dominant_family": simple(f"""SELECT event_id, m.rule AS matched_rule, m.cause AS matched_cause,
        {grid('coalesce(m.conf, 0.0)')} AS match_confidence FROM tops LEFT JOIN matched m USING (event_id)""",
                                    *ATTRIBUTION, TOPS, RULE_LIST, MATCHES),
    "build_alerts": simple(f"SELECT pos, {ALERT_COLUMNS} FROM built", *ALERTS),
    "alerts_batch": simple(f"SELECT {ALERT_COLUMNS} FROM built", *ALERTS),
    "burst_alerts": simple("SELECT device_id, timestamp, 1::BIGINT AS n_rows, n_events, window_start FROM hits", TAGGED, *burst_ctes()),
    "burst_dedupe": simple(f"SELECT *, 'CRITICAL' AS severity, 'burst' AS rule_name, {BURST_TEXT} FROM bursts", TAGGED, *burst_ctes()),
    "burst_cooldown": simple(f"SELECT *, 'CRITICAL' AS severity, 'burst' AS rule_name, {BURST_TEXT} FROM cooled",
                             TAGGED, *burst_ctes(), COOLED),
    "evaluate_rules": _evaluated(),
    "evaluate_burst_rules": _burst_rules(),
    "burst_report": simple("""SELECT device_id, count(*) AS bursts, sum(n_events)::BIGINT AS anomalies, min(burst_start) AS first_start,
        max(burst_end) AS last_end FROM bursts GROUP BY device_id""", TAGGED, *burst_ctes()),
    "stream_ingest": simple(f"SELECT {COLUMNS} FROM telemetry"),
    "stream_burst": simple("SELECT * FROM bursts", TAGGED, *burst_ctes()),
    "stream_burst_cooldown": simple("SELECT * FROM cooled", TAGGED, *burst_ctes(), COOLED),
}
