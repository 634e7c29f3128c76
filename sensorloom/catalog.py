"""Every operator as a named query over the provided tables.

Each query reads the ``events`` table of a scale directory as telemetry.  Doubles are
rounded on a shifted grid (:func:`grid`) so that values which lie exactly between two
rounded ones cannot fall differently in two engines.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.operators import (
    alerts as A, bursts as B, evaluate as E, explain as X, features as FT, feed, forest as FO,
    lookup as L, metrics as M, quality as Q, scaling as S, summarize as G)
from sensorloom.operators.rules import FamilyRule, Rule, RuleDefaults, rules_table
from sensorloom.functions.scalars import normalize_tag
from sensorloom.plans.scoring import run_scoring, score_telemetry
from sensorloom.plans.training import train, training_rows
from sensorloom.schema import SIGNALS, TELEMETRY_COLUMNS
from sensorloom.sources import documents, feeds, model_store, telemetry as TM
from sensorloom.sources.events_view import telemetry_view
from sensorloom.streaming.bursts import burst_stream_table
from sensorloom.streaming.ingest import ingest_stream_table
from sensorloom.workspace import fresh_path

TIES = ("event_id",)
SPEC = FT.FeatureSpec(ties=TIES)
EXACT = FT.FeatureSpec(ties=TIES, dominant_bins=False)
MATRIX_KEY = ["event_id", "device_id", "timestamp"]

# Parameters of the registered queries; the readings of a device are hours apart.
THRESHOLD = 0.11
BURST_MINUTES, BURST_COUNT, COOLDOWN_MINUTES = 72 * 60, 3, 10 * 24 * 60
DEVICE, START, END = "DEV-0003", "2024-01-05 00:00:00", "2024-01-20 00:00:00"
STORED_UNTIL = "2024-01-16 00:00:00"
SINCE = "2024-01-10T00:00:00Z"
SWEEP = [0.05, 0.08, 0.11, 0.15]

# Features of the attribution queries: plain readings under names of every family.
EXPLAINED = ["rpm_level", "temp_c_level", "vibration_g_level", "current_a_level",
             "voltage_v_level", "error_level", "state_idle", "time_hour", "phase_step"]

FAMILY_RULES = [
    FamilyRule("two_sensors", "Temperature and current together", ("Temperature", "Current"), 20.0),
    FamilyRule("hot", "Temperature dominates", ("Temperature",), 30.0),
    FamilyRule("errors", "Error codes dominate", ("Error/Flags",), 40.0),
]

RULES = [
    Rule("burst-72h", "burst", True, "critical", "", {
        "device_window_minutes": BURST_MINUTES, "min_anomalies": BURST_COUNT,
        "cooldown_minutes": COOLDOWN_MINUTES, "min_score": 0.12}),
    Rule("dominant-temperature", "dominant_family", True, "warning", "Temperature share is high", {
        "family": "Temperature", "min_percent": 30, "min_score": 0.12}),
    Rule("bearing", "tag_route", True, "warning", "", {"tag": "bearing_wear", "route": "maintenance"}),
    Rule("overheat", "tag_route", True, "warning", "", {"tag": "overheat_drift", "route": "thermal"}),
    Rule("off", "tag_route", False, "info", "", {"tag": "power_spike", "route": "electrical"}),
]

# Three burst rules at once; the second takes its severity and its least score from the defaults.
BURST_RULES = [
    RULES[0],
    Rule("burst-24h", "burst", params={"device_window_minutes": 24 * 60, "min_anomalies": 2}),
    Rule("burst-7d", "burst", True, "info", "many in a week", {
        "device_window_minutes": 7 * 24 * 60, "min_anomalies": 4, "min_score": 0.13, "cooldown_minutes": 24 * 60}),
]
DEFAULTS = RuleDefaults(0.14, "warning")


def grid(column: Column | str, places: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(0.37182818 * 10.0 ** -places), places)


def gridded(df: DataFrame, names, places: int = 6) -> DataFrame:
    return df.withColumns({n: grid(n, places) for n in names})


def flagged(view: DataFrame) -> DataFrame:
    return L.flag(view, THRESHOLD)


def _feature_query(*names, places: int = 6):
    def query(spark, sf_dir):
        matrix = FT.feature_matrix(telemetry_view(spark, sf_dir), EXACT)
        return gridded(matrix.select("event_id", *names), names, places)
    return query


def _of_view(build):
    return lambda spark, sf_dir: build(telemetry_view(spark, sf_dir))


def explained_features(view: DataFrame) -> DataFrame:
    level = lambda s: F.coalesce(F.col(s).cast("double"), F.lit(0.0))
    return flagged(view).select(
        "event_id", "device_id", "timestamp", "state", "anomaly_tag", "score", "pred",
        *[level(s).alias(f"{s}_level") for s in SIGNALS],
        F.col("error_code").cast("double").alias("error_level"),
        (F.col("state") == "IDLE").cast("double").alias("state_idle"),
        F.hour("timestamp").cast("double").alias("time_hour"),
        (F.col("event_id") % 7).cast("double").alias("phase_step"))


def standardized(view: DataFrame) -> DataFrame:
    rows = explained_features(view)
    keep = ["event_id", "device_id", "timestamp", "state", "anomaly_tag", "score", "pred"]
    return S.standardize(rows, S.fit_scaler(rows, EXPLAINED), keep)


def explanations(view: DataFrame) -> DataFrame:
    return X.explain_rows(standardized(view), EXPLAINED)


def view_alerts(view: DataFrame) -> DataFrame:
    rows = explanations(view)
    return A.alerts_batch(rows, FAMILY_RULES)


def _numbered_alerts(view: DataFrame) -> DataFrame:
    """Alerts with the event as file position."""
    rows = explanations(view).withColumn("pos", F.col("event_id"))
    return A.build_alerts(rows, FAMILY_RULES, keep=["pos"])


ALERT_FIELDS = ["timestamp", "device_id", "state", "score", "severity", "tag", "route", "queue",
                "rule_name", "rule_id", "root_cause", "cause", "confidence"]


def _alert_table(df: DataFrame, *extra) -> DataFrame:
    n = F.size("families").cast("long").alias("n_families")
    return gridded(df.select(*extra, *ALERT_FIELDS, n), ["score", "confidence"])


def _pairs(df: DataFrame, keys, column: str, name: str) -> DataFrame:
    """An ordered array of (name, pct) as rows."""
    rows = df.select(*keys, F.posexplode_outer(column).alias("ord", "e")).where("ord IS NOT NULL")
    return rows.select(*keys, "ord", f"e.{name}", grid("e.pct").alias("pct"))


def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    (telemetry_view(spark, sf_dir).select(*TELEMETRY_COLUMNS).write.option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return TM.read_telemetry_csv(spark, path)


def ingest_twice(spark, sf_dir):
    view, path = telemetry_view(spark, sf_dir), fresh_path(spark, "store")
    counts = TM.ingest_telemetry(view.where(F.col("timestamp") < STORED_UNTIL), path), \
        TM.ingest_telemetry(view, path), TM.ingest_telemetry(view, path)
    return TM.read_store(spark, path).agg(F.count(F.lit(1)).alias("stored")).select(
        *[F.lit(c).cast("long").alias(f"inserted_{i}") for i, c in enumerate(counts, 1)], "stored")


def missing_report(view):
    report = Q.validation_report(view.select(*TELEMETRY_COLUMNS))
    return report.select("rows", "schema_valid", F.size("missing_columns").alias("n_missing_columns"),
                         *[grid(f"missing_rates.{c}").alias(f"missing_{c}") for c in TELEMETRY_COLUMNS],
                         "range_checks.*")


def ops_table(view):
    text = lambda c, name: F.array_join(F.transform(c, lambda e: F.concat_ws(
        "=", e[name].cast("string"), e["rows"].cast("string"))), ",")
    rows = M.ops_metrics(view)
    lists = {"rows_per_device": text("rows_per_device", "device_id"), "by_tag": text("by_tag", "tag"),
             "by_code": text("by_code", "code")}
    return gridded(rows.withColumns(lists), ["anomaly_rate", "error_rate"])


def one_row(spark, **values):
    """Driver-side statistics as a row."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def medians(spark, sf_dir):
    found = FT.signal_medians(telemetry_view(spark, sf_dir), SPEC)
    return one_row(spark, **{k: float(v) for k, v in found.items()}).select(
        *[grid(k).alias(k) for k in found])


def median_filled(view):
    filled = FT.median_fill(FT.ffill_signals(view, SPEC), FT.signal_medians(view, SPEC))
    return gridded(filled.select("event_id", *SIGNALS), SIGNALS)


def thresholds(spark, sf_dir):
    found = E.score_quantile_thresholds(telemetry_view(spark, sf_dir))
    frame = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in found])).alias("threshold"))
    return gridded(frame, ["threshold"])


def sweep(values=None):
    def query(view):
        rows = view.select("score", L.label(F.col("anomaly_tag")).alias("y"))
        return gridded(E.threshold_sweep(rows, values),
                       ["threshold", "precision", "recall", "f1", "roc_auc"])
    return _of_view(query)


def summaries(view, group_by):
    rows = G.aggregate_explanations(explanations(view), group_by)
    top = F.array_join(F.transform("top_families", lambda e: e.family), ">")
    return gridded(rows.select("group_key", "n_flagged", "avg_score", "p95_score",
                               F.element_at("top_families", 1).pct.alias("top_pct"),
                               top.alias("families")), ["avg_score", "p95_score", "top_pct"])


def scaler_table(view):
    s = S.fit_scaler(explained_features(view), EXPLAINED)
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(m).alias("mean"), F.lit(d).alias("std"))
                     for f, m, d in zip(s.features, s.mean, s.std)])
    one = view.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")
    return gridded(one, ["mean", "std"])


def stored_aggregates(view):
    path = fresh_path(view.sparkSession, "aggregates")
    feeds.write_feed(G.aggregate_explanations(explanations(view)), path)
    return feeds.read_aggregates(view.sparkSession, path)


def open_aggregates(view):
    """Stored summaries whose objects hold a site, with a load of another type for every fifth device."""
    rows = G.aggregate_explanations(explanations(view))
    k, n = F.substring("group_key", 5, 9).cast("int"), F.col("n_flagged").cast("string")
    load = (F.when(k % 5 == 0, n).when(k % 5 == 1, F.concat(F.lit('"r'), n, F.lit('"'))).when(k % 5 == 2, F.lit("true"))
            .when(k % 5 == 3, F.concat(F.lit('{"n":'), n, F.lit("}"))))
    site = F.concat(F.lit('{"site":{"room":"R'), (k % 7).cast("string"), F.lit('"'), F.coalesce(F.concat(F.lit(',"load":'), load), F.lit("")), F.lit("}}"))
    path = fresh_path(view.sparkSession, "aggregates")
    feeds.write_feed(rows.withColumn(feeds.OPEN, F.parse_json(site)), path)
    return feeds.read_aggregates(view.sparkSession, path)


def extra_feed(view):
    rows = feed.aggregate_feed(open_aggregates(view), "$.site.load", True, 200)
    return gridded(rows.select(
        "device_id", "n_flagged", "p95_score", feeds.extra("$.site.room", "string").alias("room"),
        F.to_json(feeds.extra("$.site.load", "variant")).alias("load")), ["p95_score"])


def open_alerts(view):
    """Alerts with a ticket, written and read twice: what no column holds survives."""
    spark, rows = view.sparkSession, _numbered_alerts(view)
    ticket = F.concat(F.lit('{"ticket":{"no":'), F.col("pos").cast("string"), F.lit(',"open":true}}'))
    rows = rows.withColumn(feeds.OPEN, F.parse_json(ticket))
    for _ in range(2):
        path = fresh_path(spark, "alerts")
        feeds.write_feed(rows, path)
        rows = feeds.read_alerts(spark, path).drop("pos")
    ticket_no = feeds.extra("$.ticket.no", "long")
    found = feed.alert_feed(rows.withColumn("pos", ticket_no), severity="critical", limit=300)
    return gridded(found.select("alert_id", "device_id", "score", ticket_no.alias("ticket"), feeds.extra("$.ticket.open", "boolean").alias("open")), ["score"])


def stored_alerts(spark, sf_dir):
    path = fresh_path(spark, "alerts")
    feeds.write_feed(view_alerts(telemetry_view(spark, sf_dir)), path)
    return _alert_table(feeds.read_alerts(spark, path))


def routed_by_table(view):
    """Routes from a table of tags: one new tag, one that replaces a known one."""
    table = view.sparkSession.createDataFrame(
        [(" mystery_fault", "electrical", None), ("bearing_wear", "workshop", "critical"), ("", "nowhere", None)],
        "tag string, route string, severity string")
    return A.tag_route(view, routes=A.read_routes(table)).select("event_id", "tag", "route", "tag_severity")


def alert_lookup(view):
    """The first alert of one device, found again by its id."""
    alerts = _numbered_alerts(view)
    known = feed.with_alert_id(alerts).where(F.col("device_id") == DEVICE).orderBy("pos").select("alert_id").first()
    return _alert_table(feed.alert_by_id(alerts, known.alert_id if known else ""), "alert_id", "pos")


def alerts_document(view):
    alerts = _numbered_alerts(view)
    fields = [c for c in alerts.columns if c != "pos"]
    path = fresh_path(view.sparkSession, "document")
    documents.write_document(alerts.select("pos", F.to_json(F.struct(*fields)).alias("item")), '{"alerts":[7,', "]}", path)
    return _alert_table(feeds.read_alerts(view.sparkSession, path, document=True, parts=True).withColumn("pos", F.col("pos").cast("long")), "pos")


def aggregates_document(view):
    rows = G.aggregate_explanations(explanations(view))
    keyed = F.concat(F.to_json(F.array("device_id")).substr(F.lit(2), F.length("device_id") + 2), F.lit(":"),
                     F.to_json(F.struct(*[c for c in rows.columns if c != "device_id"])))
    path = fresh_path(view.sparkSession, "document")
    documents.write_document(rows.select(F.col("device_id").alias("pos"), keyed.alias("item")), "{", "}", path)
    found = feeds.read_aggregates(view.sparkSession, path, document=True, parts=True)
    return gridded(found.select("device_id", "n_flagged", "avg_score", "p95_score"), ["avg_score", "p95_score"])


def stored_metrics(view):
    path = fresh_path(view.sparkSession, "metrics")
    feeds.write_metrics(view.sparkSession, {**M.anomaly_rate(view).first().asDict(), **M.error_code_rate(view).first().asDict()}, path)
    return gridded(feeds.read_metrics(view.sparkSession, path).select("anomaly_rate", "error_rate"), ["anomaly_rate", "error_rate"])


def stored_explanations(view):
    path = fresh_path(view.sparkSession, "explanations")
    feeds.write_feed(explanations(view).withColumn("n_families", F.size("families_sorted")), path)
    schema = "event_id long, device_id string, anomaly_tag string, score double, n_families long"
    return gridded(view.sparkSession.read.schema(schema).json(path), ["score"])


SPIKE_ROW, LOST_ROW = 1, 5


def spiked_features(view):
    """Rows whose frames no longer hold a huge and an infinite reading of their device."""
    order = Window.partitionBy("device_id").orderBy("timestamp", *TIES)
    rows = view.withColumn("_n", F.row_number().over(order)).withColumn(
        "temp_c", F.when(F.col("_n") == SPIKE_ROW, 1e9).when(F.col("_n") == LOST_ROW, float("inf")).otherwise(F.col("temp_c")))
    names = [f"temp_c_{k}" for k in ("mean", "std", "zscore", "fft_energy")]
    matrix = FT.feature_matrix(rows, EXACT, keep=["_n"]).where(F.col("_n") > LOST_ROW + EXACT.window)
    return gridded(gridded(matrix.select("event_id", *names), names[:-1]), names[-1:], 3)


def bursts_of(view):
    return B.burst_dedupe(flagged(view), BURST_MINUTES, BURST_COUNT)


def fitted(spark, sf_dir):
    return train(telemetry_view(spark, sf_dir), SPEC)


def model_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "model")
    model_store.save_model(spark, fitted(spark, sf_dir), path)
    return node_table(spark, model_store.load_model(spark, path))


def node_table(spark, model):
    return gridded(model_store.model_tables(spark, model)["forest"], ["split"], 4)


def scored_rows(spark, sf_dir):
    return gridded(score_telemetry(telemetry_view(spark, sf_dir), fitted(spark, sf_dir), SPEC), ["score"])


def scoring_alerts(spark, sf_dir):
    """The whole job: train, score, pick a threshold, explain the top rows, raise alerts."""
    view = telemetry_view(spark, sf_dir).drop("score")
    run = run_scoring(view, train(view, SPEC), SPEC)
    return _alert_table(run.alerts)


def scoring_alerts_all(spark, sf_dir):
    """Alerts for every flagged row, not only for the highest scores."""
    view = telemetry_view(spark, sf_dir).drop("score")
    return _alert_table(run_scoring(view, train(view, SPEC), SPEC, top_n=None).alerts)


def burst_report(spark, sf_dir):
    """Which devices have bursts of anomalies, and how long they last."""
    rows = bursts_of(telemetry_view(spark, sf_dir))
    return (rows.groupBy("device_id").agg(
                F.count(F.lit(1)).alias("bursts"), F.sum("n_events").alias("anomalies"),
                F.min("burst_start").alias("first_start"), F.max("burst_end").alias("last_end")))


QUERIES = {
    # sources and sinks
    "read_telemetry_csv": csv_roundtrip,
    "ingest_telemetry": ingest_twice,
    "rows_to_insert": _of_view(lambda v: TM.rows_to_insert(
        v.select(*TELEMETRY_COLUMNS), v.where(F.col("timestamp") < STORED_UNTIL))),
    "load_telemetry": _of_view(TM.load_telemetry),
    "load_telemetry_limit": _of_view(lambda v: TM.load_telemetry(v, 500)),
    "read_alerts": stored_alerts,
    "read_aggregates": _of_view(lambda v: gridded(
        stored_aggregates(v).select("device_id", "n_flagged", "avg_score", "p95_score"),
        ["avg_score", "p95_score"])),
    "read_alerts_document": _of_view(alerts_document),
    "read_aggregates_document": _of_view(aggregates_document),
    "read_metrics": _of_view(stored_metrics),
    "read_explanations": _of_view(stored_explanations),
    "alert_by_id": _of_view(alert_lookup),
    "aggregate_by_device": _of_view(lambda v: gridded(feed.aggregate_by_device(stored_aggregates(v), DEVICE).select(
        "device_id", "n_flagged", "avg_score", "p95_score"), ["avg_score", "p95_score"])),
    "save_model": model_roundtrip,
    # lookups
    "device_window": _of_view(lambda v: L.device_window(v, DEVICE, START, END, ties=TIES)),
    "latest_rows": _of_view(lambda v: L.latest_rows(v, 10, TIES)),
    "latest_per_device": _of_view(lambda v: L.latest_per_device(v, 3, TIES)),
    "recent_device_window": _of_view(lambda v: L.recent_device_window(v, 3 * 24 * 60, TIES)),
    "normalize_tag": _of_view(lambda v: v.select(
        "event_id", normalize_tag(F.col("anomaly_tag")).alias("tag"),
        L.label(F.col("anomaly_tag")).alias("y"))),
    "training_rows": _of_view(lambda v: L.normal_rows(L.production_rows(v)).select("event_id", "state")),
    "flag": _of_view(lambda v: flagged(v).select("event_id", "score", "pred")),
    "alert_feed": _of_view(lambda v: _alert_table(feed.alert_feed(
        _numbered_alerts(v), severity="critical", route="Electrical", since=SINCE, limit=100), "alert_id", "pos")),
    "alert_feed_all": _of_view(lambda v: _alert_table(feed.alert_feed(_numbered_alerts(v)), "alert_id", "pos")),
    "aggregate_feed": _of_view(lambda v: gridded(feed.aggregate_feed(
        stored_aggregates(v), "p95_score", True, 50).select(
            "device_id", "n_flagged", "avg_score", "p95_score"), ["avg_score", "p95_score"])),
    "aggregate_feed_extra": _of_view(extra_feed),
    "alert_feed_extra": _of_view(open_alerts),
    # quality
    "missing_rates": _of_view(lambda v: gridded(Q.missing_rates(v.select(*TELEMETRY_COLUMNS)), ["missing_rate"])),
    "range_checks": _of_view(Q.range_checks),
    "validation_report": _of_view(missing_report),
    # aggregations
    "row_count": _of_view(M.row_count),
    "time_bounds": _of_view(M.time_bounds),
    "rows_per_device": _of_view(M.rows_per_device),
    "anomaly_rate": _of_view(lambda v: gridded(M.anomaly_rate(v), ["anomaly_rate"])),
    "anomalies_by_tag": _of_view(M.anomalies_by_tag),
    "error_code_rate": _of_view(lambda v: gridded(M.error_code_rate(v), ["error_rate"])),
    "errors_by_code": _of_view(M.errors_by_code),
    "ops_metrics": _of_view(ops_table),
    "label_breakdown": _of_view(lambda v: M.label_breakdown(L.production_rows(v))),
    "sample_step_seconds": lambda spark, d: one_row(
        spark, step_s=FT.sample_step_seconds(telemetry_view(spark, d)),
        device_step_s=FT.sample_step_seconds(telemetry_view(spark, d), per_device=True)),
    "signal_medians": medians,
    "score_quantile_thresholds": thresholds,
    "threshold_sweep": sweep(),
    "threshold_sweep_given": sweep(SWEEP),
    "roc_auc": _of_view(lambda v: gridded(E.roc_auc(
        v.select("score", L.label(F.col("anomaly_tag")).alias("y"))), ["roc_auc"])),
    "per_tag_recall": _of_view(lambda v: gridded(E.per_tag_recall(flagged(v)), ["recall"])),
    "aggregate_explanations": _of_view(lambda v: summaries(v, "device_id")),
    "aggregate_explanations_by_tag": _of_view(lambda v: summaries(v, "anomaly_tag")),
    "aggregate_explanations_fleet": _of_view(lambda v: summaries(v, None)),
    "fleet_buckets": _of_view(lambda v: gridded(M.fleet_buckets(flagged(v).where("pred = 1").withColumn(
        "severity", A.score_severity(F.col("score")))), ["avg_severity"])),
    "anomaly_rate_over_time": _of_view(lambda v: gridded(M.anomaly_rate_over_time(flagged(v)), ["rate"])),
    "alerts_by_route": _of_view(lambda v: M.alerts_by_route(view_alerts(v))),
    # windows
    "ffill_signals": _of_view(lambda v: FT.ffill_signals(v, SPEC).select("event_id", *SIGNALS)),
    "median_fill": _of_view(median_filled),
    **{f"rolling_{k}": _feature_query(*[f"{s}_{k}" for s in SIGNALS]) for k in ("mean", "std", "min", "max")},
    "trend_resid": _feature_query(*[f"{s}_{k}" for s in SIGNALS for k in ("trend", "resid")]),
    "delta_zscore": _feature_query(*[f"{s}_{k}" for s in SIGNALS for k in ("delta", "zscore")]),
    "diff": _feature_query(*[f"{s}_diff" for s in SIGNALS]),
    "fft_energy": _feature_query(*[f"{s}_fft_energy" for s in SIGNALS], places=3),
    "fft_dom_bin": _of_view(lambda v: FT.feature_matrix(v, SPEC).select(
        "event_id", *[f"{s}_fft_dom_bin" for s in SIGNALS])),
    "error_streak": _feature_query("error_streak"),
    "time_since_error_s": _feature_query("time_since_error_s"),
    "state_change": _feature_query("state_change"),
    "state_change_count": _feature_query("state_change_count"),
    "time_since_state_change_s": _feature_query("time_since_state_change_s"),
    "phase": _feature_query("phase_sin", "phase_cos"),
    "feature_matrix": _of_view(lambda v: gridded(
        gridded(FT.feature_matrix(v, SPEC), [n for n in FT.feature_names(SPEC) if "fft" not in n]),
        [n for n in FT.feature_names(SPEC) if n.endswith("fft_energy")], 3)),
    "feature_matrix_spikes": _of_view(spiked_features),
    # model
    "fit_scaler": _of_view(scaler_table),
    "standardize": _of_view(lambda v: gridded(standardized(v).select("event_id", *EXPLAINED), EXPLAINED)),
    "fit_forest": lambda spark, d: node_table(spark, fitted(spark, d)),
    "score_forest": scored_rows,
    "training_features": _of_view(lambda v: gridded(training_rows(v, EXACT).select(
        "event_id", "y", "temp_c_mean", "error_streak"), ["temp_c_mean", "error_streak"])),
    # attribution
    "contributions": _of_view(lambda v: _pairs(X.contributions(
        standardized(v), EXPLAINED, len(EXPLAINED)), ["event_id"], "top_features", "feature")),
    "top_features": _of_view(lambda v: _pairs(explanations(v), ["event_id"], "top_features", "feature")),
    "family_totals": _of_view(lambda v: explanations(v).select(
        "event_id", F.explode("family_totals").alias("family", "p")).select(
            "event_id", "family", grid("p").alias("pct"))),
    "top_anomalies": _of_view(lambda v: L.top_anomalies(v, 20, TIES).select(
        "event_id", "device_id", "timestamp", "score")),
    "explain_rows": _of_view(lambda v: _pairs(explanations(v), [
        "event_id", "device_id", "timestamp", "state", "anomaly_tag", "pred"], "families_sorted", "family")),
    # alerts
    "score_severity": _of_view(lambda v: v.select("event_id", A.score_severity(F.col("score")).alias("severity"))),
    "tag_route": _of_view(lambda v: A.tag_route(v).select(
        "event_id", "tag", "route", "tag_severity", "root_cause", "rule_name", "confidence")),
    "tag_route_table": _of_view(routed_by_table),
    "match_dominant_family": _of_view(lambda v: gridded(A.match_dominant_family(
        explanations(v), FAMILY_RULES).select(
            "event_id", "matched_rule", "matched_cause", "match_confidence"), ["match_confidence"])),
    "build_alerts": _of_view(lambda v: _alert_table(_numbered_alerts(v), "pos")),
    "alerts_batch": _of_view(lambda v: _alert_table(view_alerts(v))),
    "burst_alerts": _of_view(lambda v: B.burst_alerts(flagged(v), BURST_MINUTES, BURST_COUNT)),
    "burst_dedupe": _of_view(bursts_of),
    "burst_cooldown": _of_view(lambda v: B.burst_cooldown(bursts_of(v), COOLDOWN_MINUTES)),
    "evaluate_rules": _of_view(lambda v: gridded(A.evaluate_rules(
        explanations(v), rules_table(v.sparkSession, RULES)), ["score", "confidence"]).withColumn(
            "n_events", F.col("n_events").cast("double"))),
    "evaluate_burst_rules": _of_view(lambda v: A.evaluate_rules(
        flagged(v), rules_table(v.sparkSession, BURST_RULES), defaults=DEFAULTS).select(
            "rule_id", "device_id", "timestamp", "burst_start", "n_events", "severity", "route", "message")),
    # jobs and streams
    "burst_report": burst_report,
    "scoring_alerts": scoring_alerts,
    "scoring_alerts_all": scoring_alerts_all,
    "stream_ingest": ingest_stream_table,
    "stream_burst": burst_stream_table,
    "stream_burst_cooldown": lambda spark, d: burst_stream_table(spark, d, COOLDOWN_MINUTES),
}
