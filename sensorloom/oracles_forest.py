"""SQL (DuckDB dialect) that fits, scores and explains like the forest job, level by level.

The published rules and the documented draws are written out again: which rows a tree takes, which feature and split a node
draws, how deep a reading comes. Nothing is taken from the code under test but the order of feature names.
"""

from sensorloom.operators.features import FeatureSpec, feature_names
from sensorloom.oracles import (
    ALERT_COLUMNS, DEFAULT_ROUTE, DOMINANT, FEATURE_CTES, SEVERITY, TAGGED, _tag_case, grid, telemetry)

NAMES = feature_names(FeatureSpec())
TREES, SIZE, SEED, CONTAMINATION, DEPTH, UNIT = 100, 256, 42, 0.02, 8, 2 ** 52

# Families by the beginning of a feature name, written out; all other names are of the last family.
FAMILY_STARTS = {"rpm_": "RPM", "temp_c_": "Temperature", "vibration_g_": "Vibration", "current_a_": "Current", "voltage_v_": "Voltage",
                 "error": "Error/Flags", "state": "State", "time": "Time"}
FAMILY = "CASE " + " ".join(f"WHEN starts_with(name, '{k}') THEN '{v}'" for k, v in FAMILY_STARTS.items()) + " ELSE 'Other' END"


def _matrix(where: str, keep: str) -> str:
    """Features of all rows in `f`, as trees see them in `x`."""
    tagged = TAGGED if not where else TAGGED.replace("FROM telemetry)", f"FROM telemetry WHERE {where})")
    # The sampling step, too, is that of the rows in question.
    rest = [c.replace("FROM telemetry)", "FROM tagged)") for c in FEATURE_CTES[1:]]
    values = ", ".join(f"coalesce({n}, 0)::DOUBLE" for n in NAMES)
    fine = "list_transform(f, lambda v: CASE WHEN abs(v) < 1e9 THEN floor(v * 1e6 + 0.6281718) / 1e6 ELSE v END)"
    cut = f"list_transform({fine}, lambda c: c * 8589934593.0::DOUBLE - (c * 8589934593.0::DOUBLE - c))"
    return telemetry(tagged, *rest, DOMINANT) + (
        f"SELECT *, {cut} AS x FROM (SELECT {keep}, [{values}] AS f FROM matrix JOIN dominant USING (event_id))")


def _uniform(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT)"


JUMP = f"least(1 + floor(ln(({{h}} + 0.5) / {float(UNIT)!r}) / ln(1 - chance)), {TREES})::INT"

SAMPLE = f"""learned AS MATERIALIZED ({_matrix("state IN ('RUN', 'IDLE')", "event_id, device_id, timestamp, y").replace("matrix JOIN dominant USING (event_id))", "matrix JOIN dominant USING (event_id) WHERE y = 0)")}),
chances AS (SELECT count(*) AS total, least(1.0, ({SIZE} + 8 * sqrt({SIZE}) + 32) / count(*)) AS chance FROM learned),
keyed AS MATERIALIZED (SELECT event_id, device_id, timestamp, x, chance,
  md5(device_id || '|' || epoch_us(timestamp) || '|' || event_id || '|{SEED}') AS key FROM learned, chances),
jumps AS (
  SELECT event_id, key, chance, 0 AS k, {JUMP.format(h="(('0x' || substr(key, 1, 13))::BIGINT)")} - 1 AS spot FROM keyed
  UNION ALL SELECT event_id, key, chance, k + 1, spot + {JUMP.format(h=_uniform("key || ':' || (k + 1)"))} FROM jumps WHERE spot < {TREES}),
drawn AS (SELECT event_id, spot AS tree FROM jumps WHERE spot < {TREES} AND chance < 1
  UNION ALL SELECT event_id, t AS tree FROM keyed, range({TREES}) r(t) WHERE chance >= 1),
a0 AS MATERIALIZED (SELECT tree, 1 AS node, x FROM drawn JOIN keyed USING (event_id)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY md5(key || ':t' || tree), device_id, timestamp, event_id) <= {SIZE})"""


def _level(d: int) -> str:
    own = f"('{SEED}:' || tree || ':' || node || ':{{}}')"
    feature, split = (f"{_uniform(own.format(w))} / {float(UNIT)!r}" for w in ("feature", "split"))
    return f"""n{d} AS MATERIALIZED (SELECT tree, node, count(*)::INT AS size FROM a{d} GROUP BY tree, node),
v{d} AS MATERIALIZED (SELECT tree, node, list({{'i': i, 'low': low, 'high': high}} ORDER BY i) AS varying FROM (
  SELECT tree, node, i, min(v) AS low, max(v) AS high FROM (SELECT tree, node, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{d})
  GROUP BY tree, node, i HAVING max(v) > min(v)) GROUP BY tree, node),
d{d} AS (SELECT tree, node, varying[1 + floor({feature} * len(varying))::INT] AS e, {split} AS u FROM v{d} JOIN n{d} USING (tree, node) WHERE size > 1),
c{d} AS MATERIALIZED (SELECT tree, node, e.i AS i, least(e.low + u * (e.high - e.low), nextafter(e.high, '-infinity'::DOUBLE)) AS split FROM d{d}),
a{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + (x[i] > split)::INT AS node, x FROM a{d} JOIN c{d} USING (tree, node))"""


def _leaf(source: str, d: int) -> str:
    return f"SELECT tree, node, 0 AS i, 0.0::DOUBLE AS split, size, {d} AS depth FROM {source}"


NODES = "nodes AS MATERIALIZED (" + " UNION ALL ".join(
    [f"SELECT tree, node, i, split, size, {d} AS depth FROM c{d} JOIN n{d} USING (tree, node) UNION ALL "
     + _leaf(f"n{d} ANTI JOIN c{d} USING (tree, node)", d) for d in range(DEPTH)]
    + [_leaf(f"(SELECT tree, node, count(*)::INT AS size FROM a{DEPTH} GROUP BY tree, node)", DEPTH)]) + ")"

FOREST = [SAMPLE, *[_level(d) for d in range(DEPTH)], NODES]


def _mean_path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649) - 2 * ({n} - 1) / {n} END"


def _scores(name: str, rows: str) -> str:
    """`name`: event_id and score before the offset, for all `rows`."""
    steps = [f"{name}0 AS (SELECT event_id, x, tree, 1 AS node FROM {rows}, range({TREES}) r(tree))"]
    for d in range(DEPTH):
        steps.append(f"{name}{d + 1} AS (SELECT event_id, x, tree, CASE WHEN i = 0 THEN node ELSE 2 * node + (x[i] > split)::INT END AS node "
                     f"FROM {name}{d} JOIN nodes USING (tree, node))")
    size = f"(SELECT least({SIZE}, total)::DOUBLE FROM chances)"
    steps.append(f"{name} AS MATERIALIZED (SELECT event_id, pow(2, -(sum(depth + {_mean_path('size::DOUBLE')}) / {TREES}) / ({_mean_path(size)})) AS s "
                 f"FROM {name}{DEPTH} JOIN nodes USING (tree, node) GROUP BY event_id)")
    return ",\n".join(steps)


ROWS = [f"""seen AS MATERIALIZED ({_matrix("", "event_id, device_id, timestamp, state, tag, y")})""", _scores("own", "learned"), _scores("raw", "seen"),
        f"limits AS (SELECT quantile_cont(s, {1 - CONTAMINATION}) AS q FROM own)",
        "scored AS MATERIALIZED (SELECT event_id, s - q AS score FROM raw, limits)"]

SWEPT = """best AS (
  SELECT t FROM (SELECT DISTINCT unnest(q) AS t FROM (SELECT quantile_cont(score, [0.90, 0.92, 0.94, 0.96, 0.98]) AS q FROM scored)),
    scored JOIN seen USING (event_id)
  GROUP BY t ORDER BY sum(y) FILTER (WHERE score >= t) DESC, avg(y) FILTER (WHERE score >= t) DESC, t LIMIT 1),
flagged AS (SELECT event_id, device_id, timestamp, state, tag, f, score FROM scored JOIN seen USING (event_id), best WHERE score >= t)"""


def _alerts(top: str) -> str:
    return f"""names(i, name) AS (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(NAMES, 1))}),
scale AS (SELECT i, avg(v) AS mean, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS sd
  FROM (SELECT unnest(f) AS v, generate_subscripts(f, 1) AS i FROM learned) GROUP BY i),
chosen AS ({top}),
totals AS (SELECT event_id, {FAMILY} AS family, sum(abs((v - mean) / sd)) AS z
  FROM (SELECT event_id, unnest(f) AS v, generate_subscripts(f, 1) AS i FROM chosen) JOIN scale USING (i) JOIN names USING (i) GROUP BY ALL),
tops AS (SELECT event_id, arg_max(family, z) AS top_family, count(*) AS n_families FROM totals GROUP BY event_id),
built AS (SELECT CAST(timestamp AS VARCHAR) AS timestamp, device_id, state, score AS raw_score, coalesce({_tag_case('tag', 1)}, {SEVERITY}) AS severity,
  tag, {_tag_case('tag', 0, f"'{DEFAULT_ROUTE}'")} AS route,
  CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN concat('tag_route::', tag) ELSE 'fallback_top_family' END AS rule_name,
  coalesce({_tag_case('tag', 2)}, concat('Anomaly dominated by ', top_family)) AS root_cause,
  CASE WHEN {_tag_case('tag', 2)} IS NOT NULL THEN 1.0 ELSE 0.0 END AS conf, n_families FROM chosen JOIN tops USING (event_id))"""


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


FOREST_TABLE = _with(*FOREST) + f"""SELECT tree::INT AS tree, node::INT AS node, (i - 1)::INT AS feature, {grid('split', 4)} AS split,
  (CASE WHEN i = 0 THEN node ELSE 2 * node END)::INT AS "left", (CASE WHEN i = 0 THEN node ELSE 2 * node + 1 END)::INT AS "right",
  size, depth::INT AS depth FROM nodes"""

_JOB = [*FOREST, *ROWS, SWEPT]
ORACLES = {
    "fit_forest": FOREST_TABLE,
    "save_model": FOREST_TABLE,
    "score_forest": _with(*FOREST, *ROWS) + f"""SELECT event_id, device_id, seen.timestamp, state, anomaly_tag, y, {grid('score')} AS score
      FROM scored JOIN seen USING (event_id) JOIN ({telemetry().rstrip()} SELECT event_id, anomaly_tag FROM telemetry) USING (event_id)""",
    "scoring_alerts": _with(*_JOB, _alerts("SELECT * FROM flagged ORDER BY round(score, 12) DESC, device_id, timestamp, event_id LIMIT 20"))
    + f"SELECT {ALERT_COLUMNS} FROM built",
    "scoring_alerts_all": _with(*_JOB, _alerts("SELECT * FROM flagged")) + f"SELECT {ALERT_COLUMNS} FROM built",
}
