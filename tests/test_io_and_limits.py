"""Sources, sinks, limits, traces, roles and streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens import session
from fleetlens.functions.limits import Admitted, Bucket, LevelTable, bucket_step, window_step
from fleetlens.operators import admission, reads, registry, traces
from fleetlens.sources import readers, telemetry, writers
from fleetlens.streaming import detect, stateful
from fleetlens.streaming.ingest import start_ingest

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def test_bucket_bursts_then_denies_then_refills():
    b = Bucket()
    assert [bucket_step(b, 0.0, 1, 1.0, 3.0)[0] for _ in range(4)] == [True, True, True, False]
    assert bucket_step(b, 1.0, 1, 1.0, 3.0)[0]
    assert bucket_step(b, 1.0, 1, 1.0, 3.0)[2] == 1.0


def test_sliding_window_counts_admitted_only():
    w = Admitted()
    assert [window_step(w, t, 2, 60)[0] for t in (0, 1, 2, 59.9, 60, 61)] == [True, True, False, False, True, True]


def test_parallel_segments_equal_a_plain_fold(spark):
    import random

    rnd = random.Random(4)
    rows, t = [], 0.0
    for i in range(3000):
        t += rnd.choice([0.01, 0.05, 0.2, 3.0])
        rows.append((i, T0 + timedelta(seconds=t), "hot" if i % 3 else "cold", "guest", 1))
    log = spark.createDataFrame(rows, "id int, ts timestamp, key string, role string, tokens int")
    out = {r["id"]: r["allowed"] for r in admission.token_bucket(log, 5.0, {"guest": 4.0}).collect()}
    slide = {r["id"]: r["allowed"] for r in admission.sliding_window(log, 2, {"guest": 2.0}).collect()}
    for key in ("hot", "cold"):
        b, w = Bucket(), Admitted()
        for i, ts, k, _, n in rows:
            if k == key:
                at = (ts - datetime(1970, 1, 1)).total_seconds()
                assert out[i] == bucket_step(b, at, n, 4.0, 5.0)[0]
                assert slide[i] == window_step(w, at, 4, 2)[0]
    assert 0 < sum(out.values()) < 3000 and 0 < sum(slide.values()) < 3000


@pytest.mark.parametrize("chunk", [7, 64, 5000])
def test_saturated_bucket_in_pieces_equals_a_plain_fold(spark, chunk):
    import random

    rnd = random.Random(chunk)
    rows, t = [], 0.0
    for i in range(2000):
        t += rnd.choice([0.0, 0.25, 0.5, 1.0])
        rows.append((i, T0 + timedelta(seconds=t), "hot" if i % 5 else "cold", "guest", rnd.choice([1, 1, 2, 3, 7])))
    log = spark.createDataFrame(rows, "id int, ts timestamp, key string, role string, tokens int")
    out = {r["id"]: r for r in admission.token_bucket(log, 9.0, {"guest": 0.5}, chunk=chunk).collect()}
    assert len(out) == 2000
    for key in ("hot", "cold"):
        b = Bucket()
        for i, ts, k, _, n in rows:
            if k == key:
                at = (ts - datetime(1970, 1, 1)).total_seconds()
                want = bucket_step(b, at, n, 0.5, 9.0)
                assert (out[i]["allowed"], out[i]["remaining"], out[i]["reset_after"]) == want


def test_level_table_equals_its_steps():
    import random

    rnd = random.Random(6)
    for _ in range(60):
        capacity = rnd.choice([3.0, 10.0])
        steps = [(rnd.choice([0.0, 0.25, 0.5, 4.0]), float(rnd.randrange(0, 5))) for _ in range(rnd.randrange(1, 40))]
        held = LevelTable.start()
        for gain, need in steps:
            held = held.then(gain, need, capacity)
        for level in [0.0, capacity, *(rnd.randrange(0, int(capacity * 8)) / 8 for _ in range(20))]:
            x = level
            for gain, need in steps:
                x = min(capacity, x + gain)
                x = x - need if x >= need else x
            assert held.after(level) == x


def test_fixed_window(spark):
    rows = [(i, T0 + timedelta(seconds=s), "k", "guest", 1) for i, s in enumerate([0, 1, 2, 59, 60, 61])]
    log = spark.createDataFrame(rows, "id int, ts timestamp, key string, role string, tokens int")
    out = admission.fixed_window(log, 60, {"guest": 2 / 60}).orderBy("id").collect()
    assert [r["allowed"] for r in out] == [True, True, False, False, True, True]


def test_idle_bucket_takes_the_rate_of_its_next_role(spark):
    rows = [(0, T0, "k", "viewer", 1), (1, T0 + timedelta(hours=3), "k", "admin", 1)]
    log = spark.createDataFrame(rows, "id int, ts timestamp, key string, role string, tokens int")
    kept = admission.token_bucket(log).orderBy("id").collect()
    renewed = admission.token_bucket(log, idle_ttl_s=3600).orderBy("id").collect()
    assert [r["limit"] for r in kept] == [1000.0, 1000.0]
    assert [r["limit"] for r in renewed] == [1000.0, 10000.0]


def test_headers(spark):
    df = spark.createDataFrame(
        [({"traceparent": "00-abc-def-01"},), ({"traceparent": "junk", "x-trace-id": "t1"},), ({"x-correlation-id": "c1"},), ({},)],
        "h map<string,string>",
    )
    got = [r[0] for r in df.select(traces.trace_id_from_headers("h")).collect()]
    assert got[:3] == ["abc", "t1", "c1"] and len(got[3]) == 36


def test_traces_of_all_sizes_have_one_shape(spark):
    rows = [("s", "t", str(i), None if i == 0 else "0", float(i), float(i + 1), "OK", None) for i in range(5000)]
    rows += [("s", "u", str(i), None if i == 0 else "0", 7.0, 8.0, "OK", None) for i in range(3)]
    spans = spark.createDataFrame(
        rows, "name string, trace_id string, span_id string, parent_span_id string, start_time double, end_time double, status string, error string"
    )
    out = traces.export_traces(spans, 1e4, "api", "test").orderBy("trace_id", "position").collect()
    large, small = [r for r in out if r["trace_id"] == "t"], [r for r in out if r["trace_id"] == "u"]
    assert [r["position"] for r in large] == list(range(1, 5001))
    assert [r["span_id"] for r in large] == [str(i) for i in range(5000)]
    assert [(r["position"], r["span_id"]) for r in small] == [(1, "0"), (2, "1"), (3, "2")]
    assert {r["span_count"] for r in large} == {5000} and {r["span_count"] for r in small} == {3}


def test_roles(spark):
    table = registry.role_table(spark, {"auditor": ["logs:read"]})
    summary = {r["role"]: r["permission_count"] for r in registry.role_summary(table).collect()}
    assert summary == {"admin": 17, "operator": 6, "viewer": 4, "service": 6, "guest": 2, "auditor": 1}
    users = spark.createDataFrame([("u", ["viewer", "ghost"])], "user_id string, roles array<string>")
    assert registry.user_permissions(users, table).count() == 4


def test_argument_bounds(spark):
    m = telemetry.metrics(spark, SF)
    for bad in ({"minutes": 0}, {"minutes": 1441}, {"limit": 5001}):
        with pytest.raises(ValueError):
            reads.get_metrics(m, **bad)
    with pytest.raises(ValueError):
        writers.manual_scale_event(None, 0, "u", T0)


def test_latest_prediction_defaults(spark):
    from fleetlens.schemas import PREDICTIONS

    row = reads.latest_prediction(spark.createDataFrame([], PREDICTIONS)).first()
    assert row["predicted_rps"] == 0.0 and row["model_name"] == "none"
    zero = spark.createDataFrame([(T0, 10, 7.0, None, None, None, 0.0, None, None)], PREDICTIONS)
    assert reads.latest_prediction(zero).first()["upper_bound"] == 7.0


def test_metrics_table_round_trip_is_pruned_by_date(spark, tmp_path):
    path = str(tmp_path / "metrics")
    m = telemetry.metrics(spark, SF)
    writers.write_metrics(m, path, files_per_date=2)
    back = readers.read_metrics(spark, path)
    assert back.count() == m.count()
    plan = back.filter(F.col("date") == F.lit("2024-01-05").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_dual_write_and_csv(spark, tmp_path):
    from fleetlens.plans import tables

    a = tables.anomalies(spark, SF)
    writers.write_anomalies_and_alerts(a, str(tmp_path / "a"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == spark.read.parquet(str(tmp_path / "b")).count() == a.count()
    events = spark.createDataFrame(
        [(T0, "scale_up", 2, 5, "cpu, high"), (T0 + timedelta(hours=1), "no_change", 5, 5, "-")],
        "triggered_at timestamp, action string, prev_replicas int, new_replicas int, reason string",
    )
    writers.export_scaling_csv(events, str(tmp_path / "c"), T0, T0 + timedelta(days=1))
    rows = readers.read_scaling_csv(spark, str(tmp_path / "c")).collect()
    assert [(r["action"], r["prev_replicas"], r["reason"]) for r in rows] == [("scale_up", 2, "cpu, high")]


def test_load_files_and_results(spark, tmp_path):
    stats = tmp_path / "stats.csv"
    stats.write_text(
        "Type,Name,Request Count,Failure Count,Median Response Time,Average Response Time,Min Response Time,"
        "Max Response Time,Average Content Size,Requests/s,Failures/s,50%,66%,75%,80%,90%,95%,98%,99%,99.9%,99.99%,100%\n"
        "POST,/x,10,1,2,2.5,1,9,3,4.5,0,2,2,3,3,4,5,6,7,8,9,9\n,Aggregated,10,1,2,2.5,1,9,3,4.5,0,2,2,3,3,4,5,6,7,8,9,9\n"
    )
    assert readers.read_load_stats(spark, str(stats)).filter("Type IS NULL").first()["99.9%"] == 8.0
    history = tmp_path / "h.csv"
    history.write_text("Timestamp,User Count,Type,Name,Requests/s\n1704067200,5,,Aggregated,3.5\n")
    assert readers.read_load_history(spark, str(history)).first()["Timestamp"] == 1704067200
    result = spark.createDataFrame([(1.5, 10)], "p99_ms double, samples int")
    writers.save_result(result, str(tmp_path / "r"), "latency", T0)
    assert readers.read_results(spark, str(tmp_path / "r")).first()["_metadata"]["test_name"] == "latency"


def test_bulk_sizes(spark):
    one = '{"cpu": 1, "memory": 2, "latency": 3, "rps": 4}'
    bodies = [f'{{"metrics": [{one}]}}', '{"metrics": []}', f'{{"metrics": [{",".join([one] * 1001)}]}}', "not json"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows, refused = readers.explode_bulk(df, "body", T0)
    assert rows.count() == 1 and refused.count() == 3
    row = rows.first()
    assert row["node_id"] == "api-client" and row["disk_usage"] == 0.0 and row["timestamp"] == T0


def test_ingest_stream_resumes_without_loss_or_doubles(spark, tmp_path):
    entries = readers.encode_json(telemetry.metrics(spark, SF))
    source = str(tmp_path / "in")
    entries.limit(400).coalesce(1).write.mode("append").text(source)
    args = (str(tmp_path / "t"), str(tmp_path / "r"), str(tmp_path / "c"))

    def run():
        for q in start_ingest(readers.read_metrics_stream(spark, source), *args, available_now=True):
            q.awaitTermination()

    run()
    spark.createDataFrame([('{"node_id": "x"}',), ("junk",)], "value string").write.mode("append").text(source)
    run()
    run()
    assert spark.read.parquet(args[0]).count() == 400
    assert spark.read.json(args[1]).count() >= 1


def test_a_replayed_ingest_batch_changes_neither_table(spark, tmp_path):
    from pyspark.sql import functions as F

    from fleetlens.plans.registry_queries import damaged_entries
    from fleetlens.streaming.ingest import write_ingest_batch

    entries = damaged_entries(telemetry.metrics(spark, SF)).select("entry")
    paths = str(tmp_path / "t"), str(tmp_path / "r")
    state = lambda: (
        sorted(map(str, spark.read.parquet(paths[0]).collect())), sorted(map(str, spark.read.json(paths[1]).collect()))
    )
    write_ingest_batch(entries, 0, *paths)
    write_ingest_batch(entries.limit(300), 1, *paths)
    before = state()
    write_ingest_batch(entries, 0, *paths)
    assert state() == before and spark.read.parquet(paths[0]).select("batch").distinct().count() == 2
    whole = spark.read.parquet(paths[0]).where(F.col("batch") == 0).count() + spark.read.json(paths[1]).where("batch = 0").count()
    assert whole == entries.count()


def test_refused_requests_have_a_reason(spark):
    good = '{"node_id": "n", "cpu": 1, "memory": 2, "latency": 3, "rps": 4}'
    bodies = [good, "{bad", "", None, "[1]", "7", '{"cpu": 1}', good.replace("}", ', "timestamp": "junk"}')]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    rows, refused = readers.split_json_requests(df, "body", T0)
    assert [r["cpu_usage"] for r in rows.collect()] == [1.0]
    got = {r["id"]: r["reason"] for r in refused.collect()}
    assert got == dict.fromkeys([1, 2, 3, 4, 5], "not a JSON object") | dict.fromkeys([6, 7], "missing or unreadable value")


def test_sliding_summary_counts_ten_thousand_nodes(spark, tmp_path):
    from pyspark.sql import functions as F

    from fleetlens.streaming import windows

    rows = spark.range(30_000).select(
        F.concat(F.lit("n"), (F.col("id") % 10_000).cast("string")).alias("node_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 50).alias("timestamp"),
        *[F.lit(1.0).alias(c) for c in ("cpu_usage", "memory_usage", "latency_ms", "requests_per_sec")],
    )
    end = rows.limit(1).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_009_000)))
    rows.union(end).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = windows.sliding_summary(stream, "1 hour", "1 hour")
    q = out.writeStream.format("memory").queryName("wide").trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(r["node_count"] for r in spark.table("wide").collect()) == 10_000


def test_stream_dedup_drops_repeats(spark, tmp_path):
    m = telemetry.metrics(spark, SF).limit(50)
    source = str(tmp_path / "in")
    readers.encode_json(m.union(m)).coalesce(1).write.text(source)
    for q in start_ingest(
        readers.read_metrics_stream(spark, source), str(tmp_path / "t"), str(tmp_path / "r"), str(tmp_path / "c"),
        dedup_delay="30 days", available_now=True,
    ):
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 50


def test_detector_replay_keeps_rows_once(spark, tmp_path):
    m = telemetry.metrics(spark, SF, streaming=True)
    paths = [str(tmp_path / p) for p in ("a", "b", "c")]
    for _ in range(2):
        detect.start_detector(m, *paths, available_now=True).awaitTermination()
    assert spark.read.parquet(paths[0]).count() == spark.read.parquet(paths[1]).count()


def test_stream_reset_event_refills_the_bucket(spark, tmp_path):
    rows = [(i, T0 + timedelta(seconds=i), "k", "guest", 1, i == 3) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, key string, role string, tokens int, reset boolean")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = stateful.token_bucket(stream, 2.0, {"guest": 0.001}, ttl_s=None)
    q = (
        out.writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = {r["id"]: r["allowed"] for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {0: True, 1: True, 2: False, 3: None, 4: True}


class _Stub:
    """Just enough of a session to ask for its checkpoint folder."""

    def __init__(self, master, configured=None):
        self.conf = self.sparkContext = self
        self.master, self.configured = master, configured

    def getConf(self):
        return self

    def get(self, name, default=None):
        return self.configured or default

    def getCheckpointDir(self):
        return None


def test_checkpoint_dir_comes_from_the_session():
    assert session.checkpoint_dir(_Stub("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.checkpoint_dir(_Stub("local[2]"))
    with pytest.raises(ValueError):
        session.checkpoint_dir(_Stub("yarn"))


def test_bulk_with_one_bad_metric_is_refused_whole(spark):
    good = '{"node_id":"a","cpu":1,"memory":2,"network_in":1,"network_out":1}'
    bodies = [
        (1, '{"metrics":[%s]}' % good),
        (2, '{"metrics":[%s,{"node_id":"b","memory":2}]}' % good),
        (3, '{"metrics":[%s]}' % good.replace('"cpu":1', '"cpu":1,"timestamp":"garbage"')),
    ]
    df = spark.createDataFrame(bodies, "id int, body string")
    rows, refused = readers.explode_bulk(df, "body", T0)
    whole = {r.id for r in refused.collect()}
    assert {2, 3} <= whole and rows.count() == 3 - len(whole)


def test_access_audit_without_roles(spark):
    log = spark.createDataFrame([(1, None, ["x"]), (2, [], ["x"]), (3, [None], [])], "id int, roles array<string>, required array<string>")
    out = registry.access_audit(log)
    assert [(r.has_any, r.has_all) for r in out.orderBy("id").collect()] == [(False, False), (False, False), (False, True)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_retention_drops_folders_and_rewrites_one_date(spark, tmp_path):
    rows = [(f"n{h % 3}", T0 + timedelta(hours=h), *[1.0 * h] * 5) for h in range(24 * 12)]
    columns = ["node_id string", "timestamp timestamp", *(f"{c} double" for c in ("cpu_usage", "memory_usage", "latency_ms", "requests_per_sec", "disk_usage"))]
    df, path = spark.createDataFrame(rows, ", ".join(columns)), tmp_path / "metrics"
    writers.write_metrics(df, str(path))
    files = lambda: {p.relative_to(path): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    before, now = files(), T0 + timedelta(days=11, hours=18)
    done = {r["date"]: r for r in registry.apply_retention(spark, str(path), "metrics", now, {"metrics": 5}).collect()}
    limit = now - timedelta(days=5)
    left = spark.read.parquet(str(path)).collect()
    assert {r["timestamp"] for r in left} == {r[1] for r in rows if r[1] >= limit}
    assert sum(r["removed"] for r in done.values()) == len(rows) - len(left)
    edge = limit.date().isoformat()
    assert done[edge]["action"] == "rewritten" and {r["action"] for d, r in done.items() if d != edge} == {"dropped"}
    later = {k: v for k, v in before.items() if str(k.parent)[5:] > edge}
    assert later and later.items() <= files().items()
    assert registry.apply_retention(spark, str(path), "metrics", now, {"metrics": 5}).count() == 0


def test_retention_keeps_open_alerts_of_old_dates(spark, tmp_path):
    rows = [(i, T0 + timedelta(days=i % 6), i % 4 != 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, raised_at timestamp, resolved boolean")
    path = str(tmp_path / "alerts")
    df.withColumn("date", F.to_date("raised_at")).write.partitionBy("date").parquet(path)
    now = T0 + timedelta(days=6)
    registry.apply_retention(spark, path, "alerts", now, {"alerts": 2})
    got = {r["id"] for r in spark.read.parquet(path).collect()}
    assert got == {i for i, at, resolved in rows if at >= now - timedelta(days=2) or not resolved}
