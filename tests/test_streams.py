"""Keyed state of streams: many keys share a part, and rows are released in order."""

import random
from datetime import datetime, timedelta

from fleetlens.functions.limits import Admitted, Bucket, bucket_step, window_step
from fleetlens.session import STATE_STORE
from fleetlens.streaming import stateful
from fleetlens.streaming.ingest import start_table

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, key long, role string, tokens int"
RATES = {"guest": 0.002}


def _sent(spark, path, batches, judge):
    """The rows of all batches, one micro-batch each, judged by a query that goes on from its checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        start_table(judge(stream), f"{path}/out", f"{path}/offsets", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _log(hot, keys):
    """One key with ``hot`` requests, ``keys`` with five, and five without a key, by time."""
    rng = random.Random(3)
    owners = [7] * hot + [1000 + k for k in range(keys) for _ in range(5)] + [None] * 5
    at = sorted(rng.randrange(2 * 86_400_000) for _ in owners)
    rng.shuffle(owners)
    return [(n, T0 + timedelta(milliseconds=ms), key, "guest", 1) for n, (ms, key) in enumerate(zip(at, owners))]


def _plain(log, fresh, step):
    states, out = {}, {}
    for n, ts, key, *_ in sorted(log, key=lambda r: (r[1], r[0])):
        allowed, remaining, _ = step(states.setdefault(key, fresh()), (ts - datetime(1970, 1, 1)).total_seconds())
        out[n] = key, allowed, remaining
    return out


def _found(table):
    return {r["id"]: (r["key"], r["allowed"], r["remaining"]) for r in table.collect()}


def test_keys_of_one_part_keep_their_own_records(spark, tmp_path):
    log = _log(300, 400)
    batches = [log[:900], log[900:1800], log[1800:]]
    bucket = _sent(spark, str(tmp_path / "b"), batches, lambda s: stateful.token_bucket(s, 2.0, RATES, None, parts=3))
    assert _found(bucket) == _plain(log, Bucket, lambda state, at: bucket_step(state, at, 1, 0.002, 2.0))
    window = _sent(spark, str(tmp_path / "w"), batches, lambda s: stateful.sliding_window(s, 1_000, RATES, None, parts=3))
    assert _found(window) == _plain(log, Admitted, lambda state, at: window_step(state, at, 2, 1_000))


def test_a_part_of_any_size_is_released_in_order(spark, tmp_path):
    log = _log(60_000, 100)
    rng = random.Random(5)
    sent = sorted(log, key=lambda r: r[1] + timedelta(seconds=rng.randrange(36_000)))
    third = len(sent) // 3
    end = [(10**6, T0 + timedelta(days=9), 7, "guest", 1)]
    batches = [sent[:third] + sent[:50], sent[third : 2 * third], sent[2 * third :], end]
    out = _sent(
        spark, str(tmp_path), batches, lambda s: stateful.sliding_window(s, 1_000, RATES, delay="10 hours", parts=1)
    )
    assert out.count() == len(log)
    assert _found(out) == _plain(log, Admitted, lambda state, at: window_step(state, at, 2, 1_000))
