"""Flagged readings as routed, explained alerts."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.scalars import normalize_tag
from sensorloom.operators.bursts import BurstRule, burst_sweep
from sensorloom.operators.explain import UNLABELED
from sensorloom.operators.rules import TAG_TYPES, FamilyRule, Rule, RuleDefaults, check_rule, family_rule, read_rules
from sensorloom.schema import FAMILY_SHARE, FEATURE_SHARE

# Route, severity and root cause of each known fault tag.
TAG_ROUTES = {
    "bearing_wear": ("maintenance", "WARNING",
                     "Mechanical degradation: bearing wear pattern detected"),
    "overheat_drift": ("thermal", "WARNING",
                       "Thermal anomaly: temperature/overheat drift pattern detected"),
    "sensor_dropout": ("instrumentation", "INFO",
                       "Instrumentation fault: sensor dropout pattern detected"),
    "power_spike": ("electrical", "CRITICAL",
                    "Electrical fault: power/voltage spike detected"),
}
DEFAULT_ROUTE = "triage"

# Score from which a reading is a warning, and critical.
SEVERITY_SCORES = (0.11, 0.15)


def score_severity(score: Column, warn: float = SEVERITY_SCORES[0],
                   critical: float = SEVERITY_SCORES[1]) -> Column:
    """Severity of a score; a missing score, and NaN, is INFO."""
    known = F.when(F.isnan(score.cast("double")), None).otherwise(score.cast("double"))
    return (F.when(known >= critical, F.lit("CRITICAL"))
            .when(known >= warn, F.lit("WARNING")).otherwise(F.lit("INFO")))


# A route table is configuration; far more rows than this are a mistake.
MAX_ROUTES = 10_000


def read_routes(table: DataFrame, limit: int = MAX_ROUTES) -> dict[str, tuple[str, str | None, str | None]]:
    """Routes of a table (tag, route and, if it has them, severity, root_cause) over the fixed ones.

    Tags are normalized; rows without a tag or route are left out, and of a repeated tag the largest row counts.
    """
    optional = [F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ("severity", "root_cause")]
    rows = table.select(normalize_tag(F.col("tag")).alias("tag"), "route", *optional).where("tag <> '' AND route IS NOT NULL")
    rows = rows.groupBy("tag").agg(F.max(F.struct("route", F.upper("severity").alias("severity"), "root_cause")).alias("r"))
    found = rows.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} routes")
    return {**TAG_ROUTES, **{x.tag: (x.r.route, x.r.severity, x.r.root_cause) for x in found}}


def _tag_field(tag: Column, position: int, routes: dict) -> Column:
    """Lookup in the tag table; null for an unknown tag."""
    pairs = [x for name, values in routes.items() for x in (F.lit(name), F.lit(values[position]).cast("string"))]
    return F.try_element_at(F.create_map(*pairs), tag)


def alert_tag(tag: Column) -> Column:
    text = normalize_tag(tag)
    return F.when(text == UNLABELED, F.lit("")).otherwise(text)


def tag_route(df: DataFrame, tag: str = "anomaly_tag", routes: dict = TAG_ROUTES) -> DataFrame:
    """Route, severity, root cause and rule of a known tag; unknown tags go to triage.

    A tag that only has a route keeps the severity of its score and names no cause.
    """
    clean = alert_tag(F.col(tag))
    route, cause = _tag_field(clean, 0, routes), _tag_field(clean, 2, routes)
    return df.withColumns({
        "tag": clean,
        "route": F.coalesce(route, F.lit(DEFAULT_ROUTE)),
        "tag_severity": _tag_field(clean, 1, routes),
        "root_cause": cause,
        "rule_name": F.when(cause.isNotNull(), F.concat(F.lit("tag_route::"), clean)),
        "confidence": F.when(cause.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)),
    })


def _share_of(families: Column, family: str) -> Column:
    """Percentage of a family, the last usable entry counting; null, NaN and <= 0 do not."""
    usable = F.filter(families, lambda f: (f.family == family) & (f.pct > 0) & ~F.isnan(f.pct))
    return F.try_element_at(usable, F.lit(-1)).pct


def _confidence(families: Column, rule: FamilyRule) -> Column:
    """Mean of the capped ratios where every required family reaches the threshold, else null."""
    limit = F.lit(float(rule.min_family_percent))
    shares = [_share_of(families, f) for f in rule.required_families]
    met = reduce(lambda a, b: a & b, [F.coalesce(s >= limit, F.lit(False)) for s in shares])
    parts = reduce(add, [F.least(F.lit(1.0), s / limit) for s in shares])
    return F.when(met, parts / F.lit(float(len(shares))))


def match_dominant_family(df: DataFrame, rules: list[FamilyRule],
                          families: str = "families_sorted") -> DataFrame:
    """Append ``matched_rule``, ``matched_cause`` and ``match_confidence`` (0 if none).

    The most confident rule wins and ties go to the earlier one.  Rules are configuration
    and become one expression per row: no join.
    """
    shape = "struct<conf:double,early:int,rule:string,cause:string>"
    usable = [r for r in rules if r.required_families and (r.min_family_percent or 0) > 0]
    def candidate(i: int, r: FamilyRule) -> Column:
        conf = _confidence(F.col(families), r)
        return F.when(conf.isNotNull(), F.struct(
            conf.alias("conf"), F.lit(-i).alias("early"), F.lit(r.name or r.id or None).cast("string").alias("rule"),
            F.lit(r.root_cause or r.message or None).cast("string").alias("cause")))

    candidates = [candidate(i, r) for i, r in enumerate(usable)]
    best = F.array_max(F.array(*candidates)) if candidates else F.lit(None).cast(shape)
    return (df.withColumn("_best", best)
            .withColumns({"matched_rule": F.col("_best.rule"), "matched_cause": F.col("_best.cause"),
                          "match_confidence": F.coalesce(F.col("_best.conf"), F.lit(0.0))})
            .drop("_best"))


def build_alerts(df: DataFrame, rules: list[FamilyRule] = (), score: str = "score",
                 tag: str = "anomaly_tag", thresholds=SEVERITY_SCORES, keep=(), routes: dict = TAG_ROUTES) -> DataFrame:
    """One alert per row: a known tag first, then a family rule, then a generic message.

    ``keep`` names columns passed through in front, such as a row id.
    """
    columns = set(df.columns)
    families = (F.coalesce("families_sorted", F.array()) if "families_sorted" in columns
                else F.array()).cast(f"array<{FAMILY_SHARE.simpleString()}>")
    features = (F.coalesce("top_features", F.array()) if "top_features" in columns
                else F.array()).cast(f"array<{FEATURE_SHARE.simpleString()}>")
    rows = df if tag in columns else df.withColumn(tag, F.lit(None).cast("string"))
    rows = rows.withColumns({"families_sorted": families, "top_features": features})
    rows = match_dominant_family(tag_route(rows, tag, routes), list(rules))
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score in columns else F.lit(0.0)
    tagged, matched = F.col("root_cause").isNotNull(), F.col("match_confidence") > 0
    top = F.try_element_at("families_sorted", F.lit(1)).family
    generic = F.coalesce(F.concat(F.lit("Anomaly dominated by "), top), F.lit("Anomaly detected"))
    cause = F.coalesce("root_cause", F.when(matched, F.col("matched_cause")), generic)
    rule = F.coalesce("rule_name", F.when(matched, F.col("matched_rule")), F.lit("fallback_top_family"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select(
        *keep, text("timestamp").alias("timestamp"), text("device_id").alias("device_id"),
        text("state").alias("state"), value.alias("score"),
        F.coalesce("tag_severity", score_severity(value, *thresholds)).alias("severity"),
        "tag", "route", F.col("route").alias("queue"),
        rule.alias("rule_name"), rule.alias("rule_id"),
        cause.alias("root_cause"), cause.alias("cause"),
        F.when(tagged, F.lit(1.0)).otherwise(F.col("match_confidence")).alias("confidence"),
        F.col("families_sorted").alias("families"), "top_features",
        F.struct("tag", "route", F.col("families_sorted").alias("families"), "top_features").alias("context"))


def alerts_batch(df: DataFrame, rules: list[FamilyRule] = (), **options) -> DataFrame:
    """Alerts of flagged rows only, where rows carry a flag."""
    flagged = df.where(F.col("pred") == 1) if "pred" in df.columns else df
    return build_alerts(flagged, rules, **options)


def _row_matches(rules: list[Rule], routes: dict) -> Column:
    """Every per-row rule that fires, as an array."""
    fired = []
    for r in rules:
        gate = F.lit(True) if r.min_score is None else F.col("score") >= F.lit(r.min_score)
        if r.type == "dominant_family":
            confidence = _confidence(F.col("families_sorted"), family_rule(r))
            route = _tag_field(F.col("_tag"), 0, routes)
        else:
            confidence = F.when(F.col("_tag") == r.params["tag"], F.lit(1.0))
            route = F.lit(r.params["route"])
        fired.append(F.when(F.coalesce(gate & confidence.isNotNull(), F.lit(False)), F.struct(
            F.lit("tag_route" if r.type in TAG_TYPES else r.type).alias("kind"),
            F.lit(r.id).alias("rule_id"), F.lit(r.severity.upper()).alias("severity"),
            F.coalesce(route, F.lit(DEFAULT_ROUTE)).alias("route"),
            F.lit(r.message or r.id).alias("message"), confidence.alias("confidence"))))
    return F.array_compact(F.array(*fired))


def evaluate_rules(events: DataFrame, rules: DataFrame | list[Rule], routes: dict = TAG_ROUTES,
                   defaults: RuleDefaults = RuleDefaults()) -> DataFrame:
    """All alerts of all enabled rules: per-row rules in one pass, all burst rules in another.

    ``timestamp`` of a burst is its end; ``burst_start`` and ``n_events`` are null for rows.
    """
    checked = read_rules(rules) if isinstance(rules, DataFrame) else [
        check_rule(r, i) for i, r in enumerate(rules)]
    active = [defaults.fill(r) for r in checked if r.enabled]
    per_row = [r for r in active if r.type != "burst"]
    flagged = events.where(F.col("pred") == 1)
    ts = events.schema["timestamp"].dataType
    parts = []
    if per_row:
        rows = flagged.withColumn("_tag", alert_tag(F.col("anomaly_tag")))
        # An outer explode: a plain one lets the optimizer match every rule twice.
        fired = rows.withColumn("a", F.explode_outer(_row_matches(per_row, routes))).where("a IS NOT NULL")
        parts.append(fired.select(
            "a.kind", "a.rule_id", "device_id", "timestamp", F.lit(None).cast(ts).alias("burst_start"),
            F.lit(None).cast("bigint").alias("n_events"), F.col("score").cast("double").alias("score"),
            "a.severity", "a.route", "a.message", "a.confidence"))
    sweep = [BurstRule(float(r.params["device_window_minutes"]), int(r.params["min_anomalies"]), r.min_score,
                       float(r.params.get("cooldown_minutes") or 0), r.severity, r.id, r.message)
             for r in active if r.type == "burst"]
    if sweep:
        parts.append(burst_sweep(flagged, sweep).select(
            F.lit("burst").alias("kind"), F.col("rule_name").alias("rule_id"), "device_id",
            F.col("burst_end").alias("timestamp"), "burst_start", "n_events",
            F.lit(None).cast("double").alias("score"), "severity",
            F.lit(DEFAULT_ROUTE).alias("route"), "message", F.lit(1.0).alias("confidence")))
    if not parts:
        shape = evaluate_rules(events, [Rule("none", "burst", params={
            "device_window_minutes": 1, "min_anomalies": 1})])
        return shape.limit(0)
    return reduce(DataFrame.unionByName, parts)
