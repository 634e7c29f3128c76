import pytest
from pyspark.sql import functions as F

from conftest import at
from sensorloom.operators.alerts import (
    alerts_batch, build_alerts, evaluate_rules, match_dominant_family, score_severity, tag_route)
from sensorloom.operators.metrics import alerts_by_route, fleet_buckets
from sensorloom.operators.rules import FamilyRule, Rule, RuleDefaults, check_rule, read_rules, rules_table

VOLTAGE = [("Voltage", 48.0), ("Temperature", 20.0), ("Current", 15.0), ("RPM", 10.0), ("Vibration", 7.0)]
WEAR = [("Vibration", 30.0), ("RPM", 25.0), ("Temperature", 20.0), ("Current", 15.0), ("Voltage", 10.0)]
BALANCED = [("Voltage", 22.0), ("Temperature", 21.0), ("Current", 20.0), ("RPM", 19.0), ("Vibration", 18.0)]
ELECTRICAL = FamilyRule("electrical", "Supply fault", ("Voltage",), 45.0)
MECHANICAL = FamilyRule("mechanical", "Wear", ("Vibration", "RPM"), 25.0)


@pytest.fixture
def match(events):
    def run(families, *rules):
        row = match_dominant_family(events([dict(minutes=0, families_sorted=families)]), list(rules)).first()
        return row.matched_rule, row.match_confidence
    return run


@pytest.mark.parametrize("families,rules,expected", [
    (VOLTAGE, [ELECTRICAL], ("electrical", 1.0)),
    ([("Voltage", 45.0)], [ELECTRICAL], ("electrical", 1.0)),           # inclusive
    ([("Voltage", 44.999)], [ELECTRICAL], (None, 0.0)),
    ([("Voltage", 90.0)], [ELECTRICAL], ("electrical", 1.0)),           # capped
    (WEAR, [MECHANICAL], ("mechanical", 1.0)),
    ([("Vibration", 60.0)], [MECHANICAL], (None, 0.0)),                 # all families are needed
    (BALANCED, [ELECTRICAL, MECHANICAL], (None, 0.0)),
    ([], [ELECTRICAL], (None, 0.0)),
    (VOLTAGE, [], (None, 0.0)),
    (VOLTAGE, [FamilyRule("late", "", ("Voltage",), 10.0), ELECTRICAL], ("late", 1.0)),  # ties keep the earlier
    (VOLTAGE, [FamilyRule("none", "", (), 10.0), FamilyRule("zero", "", ("Voltage",), 0.0)], (None, 0.0)),
    ([("Voltage", float("nan"))], [ELECTRICAL], (None, 0.0)),
    ([("Voltage", None), ("Voltage", 50.0)], [ELECTRICAL], ("electrical", 1.0)),
    ([("Voltage", 50.0), ("Voltage", 20.0)], [ELECTRICAL], (None, 0.0)),  # the later entry counts
    ([("Voltage", 50.0), ("Voltage", -1.0)], [ELECTRICAL], ("electrical", 1.0)),
    ([("voltage", 50.0)], [ELECTRICAL], (None, 0.0)),
])
def test_dominant_family(match, families, rules, expected):
    assert match(families, *rules) == expected


@pytest.mark.parametrize("tag,route,severity,rule", [
    ("bearing_wear", "maintenance", "WARNING", "tag_route::bearing_wear"),
    (" overheat_drift ", "thermal", "WARNING", "tag_route::overheat_drift"),
    ("sensor_dropout", "instrumentation", "INFO", "tag_route::sensor_dropout"),
    ("power_spike", "electrical", "CRITICAL", "tag_route::power_spike"),
    ("BEARING_WEAR", "triage", "CRITICAL", "fallback_top_family"),
    ("bering_wear", "triage", "CRITICAL", "fallback_top_family"),
    ("12345", "triage", "CRITICAL", "fallback_top_family"),
    ("x" * 650, "triage", "CRITICAL", "fallback_top_family"),
    ("", "triage", "CRITICAL", "fallback_top_family"),
    (None, "triage", "CRITICAL", "fallback_top_family"),
    ("(unlabeled)", "triage", "CRITICAL", "fallback_top_family"),
])
def test_routing(events, tag, route, severity, rule):
    row = build_alerts(events([dict(minutes=0, anomaly_tag=tag, score=0.18, families_sorted=VOLTAGE)])).first()
    assert (row.route, row.queue, row.severity, row.rule_name, row.rule_id) == (route, route, severity, rule, rule)
    assert row.tag == ("" if tag in (None, "(unlabeled)") else tag.strip()) and row.cause == row.root_cause
    assert row.confidence == (1.0 if rule.startswith("tag") else 0.0)
    assert row.context.route == route and row.context.families == row.families


def test_precedence_tag_then_rule_then_generic(events):
    rows = [dict(minutes=0, anomaly_tag="bearing_wear", families_sorted=VOLTAGE),
            dict(minutes=1, families_sorted=VOLTAGE, score=0.08), dict(minutes=2, families_sorted=BALANCED),
            dict(minutes=3)]
    got = build_alerts(events(rows), [ELECTRICAL]).orderBy("timestamp").collect()
    assert [r.rule_name for r in got] == ["tag_route::bearing_wear", "electrical", "fallback_top_family", "fallback_top_family"]
    assert [r.root_cause for r in got][1:] == ["Supply fault", "Anomaly dominated by Voltage", "Anomaly detected"]
    assert got[1].severity == "INFO" and got[1].route == "triage"
    assert got[0].timestamp == "2026-01-01 10:00:00"


def test_rule_without_texts_falls_back(events):
    row = build_alerts(events([dict(minutes=0, families_sorted=VOLTAGE)]), [FamilyRule("", "", ("Voltage",), 45.0)]).first()
    assert (row.rule_name, row.root_cause, row.confidence) == ("fallback_top_family", "Anomaly dominated by Voltage", 1.0)


def test_severity_bounds(spark):
    scores = [0.05, 0.11, 0.1499, 0.15, 2.0, None, float("nan")]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = [r[0] for r in df.select(score_severity(F.col("score"))).collect()]
    assert got == ["INFO", "WARNING", "WARNING", "CRITICAL", "CRITICAL", "INFO", "INFO"]


def test_batch_takes_flagged_rows(events):
    df = events([dict(minutes=0, pred=1), dict(minutes=1, pred=0)])
    assert alerts_batch(df).count() == 1 and alerts_batch(df.drop("pred")).count() == 2


def test_routes_are_counted(events):
    tags = ["bearing_wear"] * 4 + ["overheat_drift"] * 3 + ["power_spike"] * 2 + [None]
    built = build_alerts(events([dict(minutes=i, anomaly_tag=t) for i, t in enumerate(tags)]))
    assert {r.route: r.alerts for r in alerts_by_route(built).collect()} == {
        "maintenance": 4, "thermal": 3, "electrical": 2, "triage": 1}


def test_fleet_spans_are_open_at_the_old_end(events):
    df = events([dict(minutes=m, device_id=d) for d, m in (("A", 0), ("A", 24 * 60 - 60), ("B", 24 * 60 - 1), ("A", 24 * 60))])
    got = fleet_buckets(df.withColumn("severity", F.lit("warning"))).collect()
    assert [tuple(r) for r in got] == [("Last 1h", 2, 2, 20.0), ("Last 24h", 2, 3, 20.0)]


@pytest.mark.parametrize("rule", [
    Rule("a", ""), Rule("a", "unknown"), Rule("a", "burst", params={"min_anomalies": 3}),
    Rule("a", "dominant_family", params={"family": "Voltage"}), Rule("a", "tag_route", params={"tag": "x"})])
def test_bad_rules_are_named(rule):
    with pytest.raises(ValueError):
        check_rule(rule)


def test_rules_table_round_trip(spark):
    rules = [Rule("b", "burst", True, "critical", "", {"device_window_minutes": 10, "min_anomalies": 3}),
             Rule("t", "tagged_route", False, "info", "m", {"tag": "x", "route": "y"})]
    got = read_rules(rules_table(spark, rules))
    assert [(r.id, r.enabled, r.severity, r.message) for r in got] == [("b", True, "CRITICAL", ""), ("t", False, "INFO", "m")]
    assert got[0].params["min_anomalies"] == "3"


def test_evaluate_all_rules(spark, events):
    rules = [Rule("burst", "burst", severity="critical", params={
                 "device_window_minutes": 10, "min_anomalies": 3, "cooldown_minutes": 30, "min_score": 0.16}),
             Rule("volt", "dominant_family", severity="warning", params={"family": "Voltage", "min_percent": 45, "min_score": 0.16}),
             Rule("wear", "tag_route", severity="warning", params={"tag": "bearing_wear", "route": "maintenance"}),
             Rule("off", "tag_route", enabled=False, params={"tag": "bearing_wear", "route": "x"})]
    rows = [dict(minutes=m, score=0.17, families_sorted=VOLTAGE, anomaly_tag="bearing_wear") for m in (0, 5, 10, 30, 33, 36)]
    rows += [dict(minutes=50, score=0.12, families_sorted=VOLTAGE), dict(minutes=51, score=0.2, pred=0, families_sorted=VOLTAGE)]
    for given in (rules, rules_table(spark, rules)):
        got = evaluate_rules(events(rows), given).groupBy("kind", "rule_id", "severity", "route").count().collect()
        assert {tuple(r) for r in got} == {
            ("burst", "burst", "CRITICAL", "triage", 1), ("dominant_family", "volt", "WARNING", "maintenance", 6),
            ("tag_route", "wear", "WARNING", "maintenance", 6)}
    assert evaluate_rules(events(rows), []).count() == 0


def test_burst_rules_with_cooldown_run_no_python_per_chain(events):
    """Each device has a chain of its own; the choice among its bursts is one pass for all rules and devices."""
    rule = Rule("quiet", "burst", params={"device_window_minutes": 2, "min_anomalies": 2, "cooldown_minutes": 25})
    rows = events([(f"D{d}", 10 * i + j) for d in range(20) for i in range(6) for j in (0, 1)])
    got = evaluate_rules(rows, [rule])
    # Bursts are 0-1, 10-11, ..., 50-51: after the one that ends at 1 the first allowed starts at 30.
    assert sorted((r.device_id, r.burst_start, r.timestamp, r.n_events) for r in got.collect()) == sorted(
        (f"D{d}", at(m), at(m + 1), 2) for d in range(20) for m in (0, 30))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_defaults_fill_what_rules_leave_open(spark, events):
    params = {"tag": "bearing_wear", "route": "maintenance"}
    rules = [Rule("plain", "tag_route", params=params), Rule("own", "tag_route", severity="critical", params={**params, "min_score": 0.1}),
             Rule("burst", "burst", params={"device_window_minutes": 10, "min_anomalies": 2})]
    rows = events([dict(minutes=m, score=s, anomaly_tag="bearing_wear") for m, s in ((0, .12), (1, .17), (2, .18), (3, .05))])
    found = lambda given, **o: {(r.rule_id, r.severity, r["count"]) for r in evaluate_rules(rows, given, **o).groupBy("rule_id", "severity").count().collect()}
    assert found(rules) == {("plain", "INFO", 4), ("own", "CRITICAL", 3), ("burst", "INFO", 1)}
    for given in (rules, rules_table(spark, rules)):
        assert found(given, defaults=RuleDefaults(0.16, "warning")) == {("plain", "WARNING", 2), ("own", "CRITICAL", 3), ("burst", "WARNING", 1)}


def test_unknown_tag_columns_are_null(events):
    row = tag_route(events([dict(minutes=0, anomaly_tag="odd")])).first()
    assert (row.route, row.tag_severity, row.root_cause, row.rule_name) == ("triage", None, None, None)
