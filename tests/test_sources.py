import json

import pytest
from pyspark.sql import functions as F

from conftest import at
from sensorloom.operators import feed
from sensorloom.sources import feeds
from sensorloom.sources.telemetry import (
    conform, ingest_telemetry, load_telemetry, read_store, read_telemetry_csv, rows_to_insert)
from sensorloom.streaming.bursts import ROCKSDB, stream_bursts, write_bursts
from sensorloom.streaming.ingest import stream_ingest

HEADER = "timestamp,device_id,state,rpm,temp_c,vibration_g,current_a,voltage_v,error_code,anomaly_tag\n"


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(HEADER + "2026-01-01T10:00:00,DEV-0001,RUN,1700,nan,0.2,4.0,24.0,0, \n"
                    "not a time,DEV-0002,IDLE,12.0,51.5,,NaN,24.0,3,power_spike\n")
    a, b = read_telemetry_csv(spark, str(path)).orderBy("device_id").collect()
    assert a.timestamp == at(0) and a.temp_c is None and a.anomaly_tag == " " and a.rpm == 1700
    assert b.timestamp is None and b.rpm == 12 and b.vibration_g is None and b.current_a is None and b.error_code == 3


def test_second_ingest_inserts_nothing(spark, telemetry, tmp_path):
    target = str(tmp_path / "store")
    rows = [dict(timestamp=at(m)) for m in (0, 1, 1, 2000)] + [dict(device_id=None), dict(timestamp=None), dict(state=None)]
    df = telemetry(rows)
    assert ingest_telemetry(df, target) == 3
    assert ingest_telemetry(df, target) == 0
    more = telemetry([dict(timestamp=at(m)) for m in (1, 3)])
    assert ingest_telemetry(more, target) == 1
    stored = read_store(spark, target)
    assert stored.count() == 4 and stored.select("device_id", "timestamp").distinct().count() == 4
    assert ingest_telemetry(df.limit(0), target) == 0


def test_smallest_row_of_a_repeated_key_stays(telemetry):
    df = telemetry([dict(timestamp=at(0), rpm=9), dict(timestamp=at(0), rpm=3), dict(timestamp=at(0), rpm=5)])
    assert [r.rpm for r in rows_to_insert(df, df.limit(0)).collect()] == [3]


def test_nan_becomes_null(telemetry):
    row = conform(telemetry([dict(temp_c=float("nan"))])).first()
    assert row.temp_c is None


def test_load_is_in_time_order_with_a_limit(telemetry):
    df = telemetry([dict(timestamp=at(m)) for m in (3, 1, 2)])
    assert [r.timestamp for r in load_telemetry(df, 2).collect()] == [at(1), at(2)]
    assert load_telemetry(df).count() == 3


ALERTS = [
    {"alert_id": " given ", "device_id": "A", "timestamp": "2026-01-01T10:00:00Z", "severity": "Critical", "route": "thermal", "score": 0.2},
    "not an object",
    {"id": "second", "device_id": "B", "timestamp": "2026-01-01 12:00:00", "severity": "warning", "extra": [1]},
    {"alert_id": 5, "rule_id": "r", "device_id": "A", "timestamp": "2026-01-01T11:00:00+01:00", "severity": "critical"},
    {"device_id": "A", "severity": "CRITICAL "},
    7,
]


@pytest.mark.parametrize("doc", [ALERTS, {"alerts": ALERTS}])
def test_alert_documents(spark, tmp_path, doc):
    (tmp_path / "alerts.json").write_text(json.dumps(doc, indent=1))
    df = feeds.read_alerts(spark, str(tmp_path / "alerts.json"), document=True)
    ids = lambda rows: [r.alert_id for r in rows.collect()]
    assert ids(feed.with_alert_id(df).orderBy("pos")) == ["given", "second", "r:A:2026-01-01T11:00:00+01:00", "idx:3"]
    # 11:00+01:00 is 10:00 UTC: equal times keep file order; no time comes last.
    assert ids(feed.alert_feed(df)) == ["second", "given", "r:A:2026-01-01T11:00:00+01:00", "idx:3"]
    assert ids(feed.alert_feed(df, device="A", severity=" CRITICAL")) == ["given", "r:A:2026-01-01T11:00:00+01:00", "idx:3"]
    assert ids(feed.alert_feed(df, route="THERMAL")) == ["given"]
    assert ids(feed.alert_feed(df, since="2026-01-01T11:30:00Z")) == ["second"]
    assert len(ids(feed.alert_feed(df, since="whenever"))) == 4
    assert ids(feed.alert_feed(df, limit=1)) == ["second"]
    assert feed.alert_by_id(df, "idx:3").count() == 1 and feed.alert_by_id(df, "nope").count() == 0
    for limit in (0, 2001):
        with pytest.raises(ValueError):
            feed.alert_feed(df, limit=limit)


@pytest.mark.parametrize("doc", [{"alert": []}, [], {}, "text", 5])
def test_documents_without_alerts(spark, tmp_path, doc):
    (tmp_path / "a.json").write_text(json.dumps(doc))
    assert feeds.read_alerts(spark, str(tmp_path / "a.json"), document=True).count() == 0


@pytest.mark.parametrize("doc", [
    {"B": {"n_flagged": 2, "avg_score": 0.5}, "A": {"n_flagged": 1, "p95_score": 0.9}, "C": 4},
    [{"device_id": "A", "n_flagged": 7}, {"n_flagged": 1}, 3, {"device_id": "B", "n_flagged": 2, "avg_score": 0.5},
     {"device_id": "A", "n_flagged": 1, "p95_score": 0.9}]])
def test_aggregate_documents(spark, tmp_path, doc):
    (tmp_path / "g.json").write_text(json.dumps(doc))
    df = feeds.read_aggregates(spark, str(tmp_path / "g.json"), document=True)
    order = lambda **o: [r.device_id for r in feed.aggregate_feed(df, **o).collect()]
    assert order() == ["A", "B"] and order(desc=True) == ["B", "A"]
    assert order(sort_by="p95_score") == ["B", "A"] and order(sort_by="n_flagged", desc=True, limit=1) == ["B"]
    assert order(sort_by="missing") == ["A", "B"]
    assert feed.aggregate_by_device(df, "A").first().n_flagged == 1
    with pytest.raises(ValueError):
        feed.aggregate_feed(df, limit=5001)


def test_streamed_ingest_keeps_each_key_once(spark, telemetry, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = telemetry([dict(timestamp=at(m)) for m in (0, 1, 1, 2)]).drop("row_id")
    for part in (rows, rows.limit(2)):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        stream_ingest(stream, target, str(tmp_path / "check")).awaitTermination()
    assert sorted(r.timestamp for r in read_store(spark, target).collect()) == [at(0), at(1), at(2)]


def test_streamed_bursts_equal_batch(spark, events, tmp_path):
    """Files arrive out of order within the delay; a late marker closes the last bursts."""
    import random
    from test_bursts import brute_bursts
    rng = random.Random(6)
    rows = sorted([(rng.choice("AAB"), rng.randrange(0, 1200) / 2) for _ in range(160)], key=lambda r: r[1])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    chunks = [rows[:50] + rows[60:65], rows[50:60] + rows[65:], [("Z", 5000.0)], [("Z", 9000.0)]]
    for chunk in chunks:
        events(chunk).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events([]).schema).parquet(source)
        found = stream_bursts(stream, 10, 3, delay="60 minutes")
        write_bursts(found, target, str(tmp_path / "check")).awaitTermination()
    by_device = {}
    for d, m in rows:
        by_device.setdefault(d, []).append(m)
    want = sorted((d, at(a), at(b), n) for d, ts in by_device.items() for a, b, n in brute_bursts(ts, 10, 3))
    got = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert got == want and want


def test_stream_and_batch_share_one_store(spark, telemetry, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("source", "store", "check"))
    assert ingest_telemetry(telemetry([dict(timestamp=at(m)) for m in range(6)]), target) == 6
    for k, minutes in enumerate([(100, 101), (4, 5, 6, 7), (-9000, 101, 6)]):  # out of order, repeated, very late
        telemetry([dict(timestamp=at(m)) for m in minutes]).coalesce(1).write.mode("append").parquet(source)
        schema = spark.read.parquet(source).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_ingest(stream, target, check).awaitTermination()
    stored = [r.timestamp for r in read_store(spark, target).collect()]
    assert sorted(stored) == sorted(at(m) for m in (-9000, 0, 1, 2, 3, 4, 5, 6, 7, 100, 101))
    assert ingest_telemetry(telemetry([dict(timestamp=at(m)) for m in (-9000, 3, 101)]), target) == 0


def test_lines_keep_file_order_and_drop_other_values(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    long = [json.dumps({"device_id": "D", "score": float(i), "message": "x" * 50}) for i in range(400)]
    (folder / "part-00000.json").write_text('7\n{"device_id": "A", "score": 1.0}\n"text"\n')
    (folder / "part-00001.json").write_text("\n".join(long) + "\n")
    rows = feeds.read_alerts(spark, str(folder)).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(401))
    assert [r.device_id for r in rows] == ["A"] + ["D"] * 400
    assert [r.score for r in rows[1:]] == [float(i) for i in range(400)]


def test_cluster_without_shared_folder_is_refused(spark):
    class Context:
        master = "spark://host:7077"

    class Conf:
        get = staticmethod(lambda key, default: default)

    class Session:
        sparkContext, conf = Context, Conf

    from sensorloom.workspace import work_dir
    with pytest.raises(ValueError):
        work_dir(Session)


def test_open_objects_keep_and_sort_by_any_key(spark, tmp_path):
    items = {
        "A": {"n_flagged": 2, "site": {"load": 7, "a.b": "x"}, "it's": 1}, "B": {"site": {"load": "high"}, "avg_score": 0.5, "it's": True},
        "C": {"site": {"load": True}}, "D": {"site": {"load": None}, "it's": 3.5}, "E": {"site": {"load": [1, 2]}}, "F": {"other": 1},
        "G": {"site": {"load": -3.5}}, "H": {"site": {"load": "Low"}}, "I": {"site": 4}}
    (tmp_path / "g.json").write_text(json.dumps(items))
    df = feeds.read_aggregates(spark, str(tmp_path / "g.json"), document=True)
    order = lambda **o: "".join(r.device_id for r in feed.aggregate_feed(df, **o).collect())
    # Numbers (missing: -1, true: 1), texts by code points, then lists and objects.
    assert order(sort_by="$.site.load") == "GDFICAHBE"
    assert order(sort_by="$.site.load", desc=True) == "EBHACDFIG"
    assert order(sort_by="it's") == "CEFGHIABD" and order(sort_by="$.none") == "ABCDEFGHI" == order(sort_by="none")
    assert order(sort_by="n_flagged", desc=True)[0] == "A"
    feeds.write_feed(df.withColumn("n_flagged", df.n_flagged + 1), str(tmp_path / "again"))
    back = {r.device_id: json.loads(r.j) for r in feeds.read_aggregates(spark, str(tmp_path / "again")).selectExpr("device_id", "to_json(body) j").collect()}
    for device, item in items.items():
        assert {k: v for k, v in back[device].items() if k in item and k != "n_flagged"} == {k: v for k, v in item.items() if k != "n_flagged"}
    assert back["A"]["n_flagged"] == 3 and back["I"]["device_id"] == "I"


def test_alert_lines_keep_extra_keys(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    lines = [{"device_id": "A", "id": 5, "owner": {"name": "Ö"}}, {"id": "x", "alert_id": " ", "score": "high", "owner": [1]}]
    (folder / "part-0.json").write_text("\n".join(map(json.dumps, lines)))
    df = feeds.read_alerts(spark, str(folder))
    rows = feed.with_alert_id(df).withColumn("owner", feeds.extra("$.owner.name", "string")).orderBy("pos").collect()
    assert [(r.alert_id, r.owner, r.score) for r in rows] == [("idx:0", "Ö", None), ("x", None, None)]
    feeds.write_feed(df, str(tmp_path / "again"))
    again = feeds.read_alerts(spark, str(tmp_path / "again"))
    assert [json.loads(r.j) for r in again.orderBy("pos").selectExpr("to_json(variant_get(body, '$.owner')) j").collect()] == [{"name": "Ö"}, [1]]


def scanned_rows(df):
    """Rows that the file scans of a finished query handed on: row groups that are skipped do not count."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        inner = node.executedPlan() if node.nodeName().startswith("AdaptiveSparkPlan") else node.plan() if "QueryStage" in node.nodeName() else None
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())] + ([inner] if inner is not None else [])
    return total


def test_device_window_skips_row_groups(spark, telemetry, tmp_path):
    from sensorloom.operators.lookup import device_window
    rows = spark.range(60_000).selectExpr(
        "timestamp_seconds(1767225600 + id div 60) AS timestamp", "format_string('DEV-%04d', 2 * (id % 60)) AS device_id", "'RUN' AS state",
        "CAST(id % 1999 AS INT) AS rpm", "rand(1) AS temp_c", "rand(2) AS vibration_g", "rand(3) AS current_a", "rand(4) AS voltage_v",
        "0 AS error_code", "' ' AS anomaly_tag")
    target = str(tmp_path / "store")
    assert ingest_telemetry(rows.repartition(7), target, **{"parquet.block.size": "65536"}) == 60_000
    store = read_store(spark, target)
    window = device_window(store, "DEV-0042", at(-10_000), at(10_000))
    assert window.count() == 1000 and 1000 <= scanned_rows(window) < 6000
    # A device that is not there, though its name lies between others of a row group.
    assert scanned_rows(device_window(store, "DEV-0043", at(-10_000), at(10_000))) == 0
    assert ingest_telemetry(rows, target) == 0


def test_store_that_cannot_be_read_is_no_empty_store(spark, tmp_path):
    (tmp_path / "store").write_text("no parquet")
    with pytest.raises(Exception):
        read_store(spark, str(tmp_path / "store")).count()
    assert read_store(spark, str(tmp_path / "none")).count() == 0


def test_documents_are_cut_at_braces_anywhere(spark, tmp_path):
    """Items of a document of many splits: braces and escapes in strings, other keys, lists and scalars between."""
    odd = ['}', '{"', '\\', '\\"}', 'a"}{b\\\\', "[[{", "é}"]
    items = []
    for i in range(16):
        items += [{"id": f"n{i}{odd[i % 7]}", "device_id": odd[(i + 3) % 7], "extra": {"in": [{"x": odd[i % 5]}, [{}]]}}]
        items += [i, "}", [1, {"id": "nested"}], None][: i % 5]
    wanted = [(k, x["id"], x["device_id"]) for k, x in enumerate(x for x in items if isinstance(x, dict))]
    around = {"meta": {"alerts": [{"id": "deep"}], "v": {"w": {}}}, "first": [{"id": "no"}, {"id": "no"}], "alerts": items,
              "more": [{"id": "no"}, 2, {"id": "no"}], "z": {"id": "no"}, "end": "}]"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 331)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        for doc, indent in ((items, None), (around, 1)):
            path = tmp_path / f"{indent}.json"
            path.write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)))
            found = feeds.read_alerts(spark, str(path), document=True)
            assert [(r.pos, r.id, r.device_id) for r in found.orderBy("pos").collect()] == wanted
        by_device = {f"{o}{k}": {"n_flagged": k, "x": [{o: o}]} for k, o in enumerate(odd * 2)}
        (tmp_path / "g.json").write_text(json.dumps({"a": "}", **by_device, "b": [{"n_flagged": 1}], "last": {"n_flagged": -1}}))
        found = feeds.read_aggregates(spark, str(tmp_path / "g.json"), document=True)
        assert {r.device_id: r.n_flagged for r in found.collect()} == {**{d: v["n_flagged"] for d, v in by_device.items()}, "last": -1}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_document_is_written_and_read_in_parts(spark, tmp_path):
    from pyspark.sql import functions as F
    from sensorloom.sources.documents import write_document

    rows = spark.range(0, 100, 1, 8).select(F.expr("if(id = 9, null, id div 3)").alias("pos"), F.to_json(F.struct(
        F.concat(F.lit('a}"'), F.col("id").cast("string")).alias("id"), F.array(F.struct("id")).alias("extra"))).alias("item"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    write_document(rows, '{"alerts":[7,', "]}", str(tmp_path / "doc"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "doc").glob("part-*"))
    assert len(parts) > 1
    whole = json.loads("".join(p.read_text() for p in parts))["alerts"]
    ordered = [json.loads(r.item)["id"] for r in rows.orderBy("pos", "item").collect()]
    assert whole[0] == 7 and [x["id"] for x in whole[1:]] == ordered
    found = feeds.read_alerts(spark, str(tmp_path / "doc"), document=True, parts=True)
    assert [(r.pos, r.id) for r in found.orderBy("pos").collect()] == list(enumerate(ordered))
