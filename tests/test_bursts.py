import random

import pytest

from conftest import at
from sensorloom.operators.bursts import BurstRule, burst_alerts, burst_cooldown, burst_dedupe, burst_sweep


def brute_hits(times, window, least):
    """(time, count) where the window [t - M, t] holds enough readings; equal times count."""
    counts = {t: sum(1 for u in times if t - window <= u <= t) for t in times}
    return {t: n for t, n in counts.items() if n >= least}


def brute_bursts(times, window, least):
    hits, islands = sorted(brute_hits(times, window, least)), []
    for h in hits:
        if islands and h - islands[-1][-1] <= window:
            islands[-1].append(h)
        else:
            islands.append([h])
    out = []
    for island in islands:
        start = min(u for u in times if island[0] - window <= u <= island[0])
        out.append((start, island[-1], sum(1 for u in times if start <= u <= island[-1])))
    return out


def found(df):
    return sorted((r.device_id, r.burst_start, r.burst_end, r.n_events) for r in df.collect())


CASES = [
    ([("A", m) for m in (0, 5, 10)], 3, [("A", 0, 10, 3)]),
    ([(d, m) for d, m in zip("ABC", (0, 5, 10))], 3, []),
    ([("A", m) for m in (0, 20, 40)], 3, []),
    ([("A", m) for m in (0, 15, 30)], 2, [("A", 0, 30, 3)]),
    ([("A", m) for m in (0, 14 + 59 / 60, 29 + 58 / 60)], 2, [("A", 0, 29 + 58 / 60, 3)]),
    ([("A", m) for m in (0, 15 + 1 / 60)], 2, []),
    ([("A", m) for m in (0, 5, 10, 14, 18)], 3, [("A", 0, 18, 5)]),
    ([("A", m) for m in (0, 5)], 3, []),
    ([("A", m) for m in (0, 3, 6, 9, 12)], 3, [("A", 0, 12, 5)]),
    ([("A", 0), ("A", 3), ("B", 6), ("A", 9)], 3, [("A", 0, 9, 3)]),
    ([("A", m) for m in (0, 5, 10, 60, 65, 70)], 3, [("A", 0, 10, 3), ("A", 60, 70, 3)]),
    ([("A", 0), ("A", 0), ("A", 0)], 3, [("A", 0, 0, 3)]),
    ([], 3, []),
]


@pytest.mark.parametrize("rows,least,expected", CASES)
def test_cases(events, rows, least, expected):
    got = found(burst_dedupe(events(rows), 15, least))
    assert got == sorted((d, at(a), at(b), n) for d, a, b, n in expected)


def test_hit_counts_only_what_is_still_in_the_window(events):
    hits = burst_alerts(events([("A", m) for m in (0, 10, 20, 25)]), 15, 3)
    assert [(r.timestamp, r.n_events, r.window_start) for r in hits.collect()] == [(at(25), 3, at(10))]


@pytest.mark.parametrize("window,least", [(0, 3), (-5, 3), (15, 0)])
def test_bad_parameters(events, window, least):
    with pytest.raises(ValueError):
        burst_alerts(events([("A", 0)]), window, least)


def test_year_long_window(events):
    day = 24 * 60
    assert len(found(burst_dedupe(events([("A", 0), ("A", 30 * day), ("A", 60 * day)]), 365 * day, 3))) == 1


def test_only_flagged_rows_above_the_score(events):
    rows = [dict(minutes=m, pred=p, score=s) for m, p, s in
            [(0, 1, .2), (1, 0, .2), (2, 1, .1), (3, 1, .2), (4, 1, None)]]
    assert found(burst_dedupe(events(rows), 15, 2, min_score=.16)) == [("DEV-001", at(0), at(3), 2)]
    assert found(burst_dedupe(events(rows), 15, 3, min_score=.16)) == []


@pytest.mark.parametrize("seed,window,least", [(1, 10, 3), (2, 3, 2), (3, 30, 5), (4, 1, 1)])
def test_random_times_equal_brute_force(events, seed, window, least):
    """Spans many slices, with equal times and one device that holds most rows."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < .7 else f"D{rng.randrange(4)}", rng.randrange(0, 1500) / 2) for _ in range(400)]
    by_device = {}
    for d, m in rows:
        by_device.setdefault(d, []).append(m)
    df = events(rows)
    want = sorted((d, at(a), at(b), n) for d, ts in by_device.items() for a, b, n in brute_bursts(ts, window, least))
    assert found(burst_dedupe(df, window, least)) == want
    hits = {(r.device_id, r.timestamp): (r.n_events, r.n_rows) for r in burst_alerts(df, window, least).collect()}
    assert hits == {(d, at(t)): (n, ts.count(t)) for d, ts in by_device.items()
                    for t, n in brute_hits(ts, window, least).items()}


def test_cooldown_follows_the_last_kept_burst(spark):
    spans = [("A", 0, 10), ("A", 25, 35), ("A", 50, 60), ("A", 100, 110), ("B", 30, 31)]
    df = spark.createDataFrame([(d, at(a), at(b)) for d, a, b in spans],
                               "device_id string, burst_start timestamp, burst_end timestamp")
    kept = lambda minutes: sorted((r.device_id, r.burst_start) for r in burst_cooldown(df, minutes).collect())
    assert kept(30) == [("A", at(0)), ("A", at(50)), ("A", at(100)), ("B", at(30))]
    assert kept(15) == sorted((d, at(a)) for d, a, _ in spans)
    assert kept(95) == [("A", at(0)), ("B", at(30))]
    assert kept(90) == [("A", at(0)), ("A", at(100)), ("B", at(30))]


def plain_cooldown(spans, quiet):
    kept, last = [], {}
    for d, a, b in sorted(spans):
        if d not in last or a >= last[d] + quiet:
            kept.append((d, a))
            last[d] = b
    return kept


@pytest.mark.parametrize("quiet", [0, 30])
def test_cooldown_of_hot_devices_equals_the_loop(spark, quiet):
    """Devices above the limit are walked by doubling pointers, over several ranges of one device."""
    rng = random.Random(8)
    spans = []
    for device, n in (("hot", 600), ("warm", 120), ("few", 5)):
        t = 0
        for _ in range(n):
            t += rng.randrange(1, 25)
            spans.append((device, t, t + rng.randrange(0, 6)))
            t = spans[-1][2]
    df = spark.createDataFrame([(d, at(a), at(b), a) for d, a, b in spans],
                               "device_id string, burst_start timestamp, burst_end timestamp, mark int").repartition(5)
    got = sorted((r.device_id, r.mark) for r in burst_cooldown(df, quiet, longest=50).collect())
    assert got == plain_cooldown(spans, quiet) == sorted((r.device_id, r.mark) for r in burst_cooldown(df, quiet).collect())


def test_one_long_chain_stays_split(spark):
    n = 60_000
    df = spark.range(n).selectExpr("'D' AS device_id", "timestamp_seconds(id * 60) AS burst_start", "timestamp_seconds(id * 60 + 10) AS burst_end")
    kept = burst_cooldown(df, 5, longest=10_000)
    # Ten seconds and five minutes after a start, the sixth next burst is the first one allowed.
    assert kept.count() == -(-n // 6)
    from sensorloom.operators.bursts import _following_start
    nodes = df.selectExpr("device_id", "unix_micros(burst_start) AS start", "unix_micros(burst_end) AS end", "300000000L AS quiet")
    ranges = _following_start(nodes, ["device_id"])
    assert ranges.where("to IS NULL").count() == 6 and ranges.where("to <> start + 360000000").isEmpty()


def test_rules_in_one_sweep_equal_rules_alone(events):
    rng = random.Random(12)
    rows = [dict(device_id=rng.choice("AAB"), minutes=rng.randrange(0, 900) / 2, score=rng.choice([.1, .15, .2])) for _ in range(150)]
    df = events(rows)
    rules = [BurstRule(10, 3, .15, 30, name="a"), BurstRule(3, 2, name="b", severity="info"), BurstRule(40, 6, None, 60, name="c", message="many")]
    got = sorted((r.rule_name, r.device_id, r.burst_start, r.n_events, r.severity, r.message) for r in burst_sweep(df, rules).collect())
    want = []
    for r in rules:
        alone = burst_dedupe(df, r.window_minutes, r.min_anomalies, r.min_score, r.severity, r.name)
        alone = burst_cooldown(alone, r.cooldown_minutes) if r.cooldown_minutes else alone
        want += [(x.rule_name, x.device_id, x.burst_start, x.n_events, x.severity, r.message or x.message) for x in alone.collect()]
    assert got == sorted(want) and {w[0] for w in want} == {"a", "b", "c"}
    exchanges = lambda rs: burst_sweep(df, rs)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    plain = [BurstRule(m, 3, name=str(m)) for m in (5, 10, 20)]
    assert exchanges(plain) == exchanges(plain[:1])
    hot = sorted((r.rule_name, r.device_id, r.burst_start) for r in burst_sweep(df, rules, longest=2).collect())
    assert hot == [g[:3] for g in got]


def test_cooldown_of_many_short_chains_is_one_pass(spark):
    """No Python call per chain; chains, devices and the ends of batches do not touch each other."""
    rng = random.Random(3)
    spans = []
    for device in "ABCDEFG":
        t = 0
        for _ in range(rng.randrange(1, 60)):
            t += rng.choice([1, 5, 90])
            spans.append((device, t, t + rng.randrange(0, 4)))
            t = spans[-1][2]
    df = spark.createDataFrame([(d, at(a), at(b), a) for d, a, b in spans],
                               "device_id string, burst_start timestamp, burst_end timestamp, mark int").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        kept = burst_cooldown(df, 30)
        assert sorted((r.device_id, r.mark) for r in kept.collect()) == plain_cooldown(spans, 30)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan
