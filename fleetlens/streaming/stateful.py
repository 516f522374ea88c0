"""Keyed state over streams: capacity decisions, admission and node silence.

Each processor keeps one small record per key and applies the same step
function as the batch replay. Keys are dealt to parts by a hash; a part is one
group of the stream and holds the records of its keys in map state. Without a
watermark delay the rows of a part are put in time order inside a micro-batch,
which the source's limit per trigger bounds. With a delay they wait in state as
chunks, by time, and event-time timers release them in order once the watermark
has passed: any arrival order within the delay gives the results of the batch
form, and chunks whose time has come are merged a few at a time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetlens.functions.control import LoopState, ScalerState, decision_step
from fleetlens.functions.limits import Admitted, Bucket, bucket_step, window_step
from fleetlens.operators.admission import CAPACITY, IDLE_TTL_S, WINDOW_S, role_rate
from fleetlens.operators.scaling import DECISION_OUTPUTS
from fleetlens.params import ScalerPolicy


def _ordered(batches: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    frames = list(batches)
    return pd.concat(frames, ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


def _named(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Batches under their own column names, some of which Spark replaces."""
    return (batch.set_axis(columns, axis=1) for batch in batches)


def _micros(times: pd.Series) -> np.ndarray:
    return times.astype("datetime64[us]").astype("int64").to_numpy()


def _seconds(times: pd.Series) -> list[float]:
    return (_micros(times) / 1e6).tolist()


#: A part holds many keys, so that a call into Python, a frame and a timer serve them all. The number of parts bounds
#: the rows in one frame, not the number of keys; a checkpoint keeps the number it was begun with.
PARTS = 1024
PART_COLUMNS = ["_key", "_part"]


def _parted(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    return rows.withColumns({"_key": F.to_json(F.struct(*keys)), "_part": part})


# --- rules: one small record per key, changed by each row ------------------------------


class _Loop:
    record, outputs = "integral double, error double, workers int, decided_at double", DECISION_OUTPUTS

    def __init__(self, columns: list[str], policy: ScalerPolicy, start_workers: int, dt_s: float):
        self.policy, self.start, self.dt_s = policy, start_workers, dt_s
        self.inputs = ["utilization", "upper_bound", "spike_probability", *(["workers"] if "workers" in columns else [])]

    def load(self, kept: Any) -> ScalerState:
        return ScalerState(LoopState(kept[0], kept[1]), kept[2], kept[3]) if kept else ScalerState(LoopState(), self.start)

    def save(self, state: ScalerState) -> tuple | None:
        return state.loop.integral, state.loop.error, state.workers, state.decided_at

    def step(self, state: ScalerState, at: float, used: float, upper: float, spike: float, workers: Any = None) -> tuple:
        return decision_step(state, at, used, upper, spike, self.dt_s, self.policy, workers)


ADMISSION = {"allowed": "boolean", "remaining": "bigint", "reset_after": "double"}


class _BucketRule:
    """With ``idle_s`` a bucket that is idle for so long, in event time, is forgotten."""

    record, outputs, inputs = "tokens double, at double, refill double", ADMISSION, ["tokens", "rate", "reset"]

    def __init__(self, capacity: float, idle_s: float | None = None):
        self.capacity, self.idle_s = capacity, idle_s

    def load(self, kept: Any) -> list:
        return [Bucket(kept[0], kept[1]), kept[2]] if kept else [Bucket(), None]

    def save(self, state: list) -> tuple | None:
        return None if state[1] is None else (state[0].tokens, state[0].at, state[1])

    def step(self, state: list, at: float, need: float, rate: float, reset: bool) -> tuple:
        bucket = state[0]
        if reset or (self.idle_s and bucket.tokens is not None and at - bucket.at >= self.idle_s):
            bucket, _ = state[:] = Bucket(), None
        if reset:
            return None, None, None
        if state[1] is None:
            state[1] = rate
        return bucket_step(bucket, at, need, state[1], self.capacity)


class _WindowRule:
    record, outputs, inputs = "times array<double>", ADMISSION, ["limit"]

    def __init__(self, window_s: float):
        self.window_s = window_s

    def load(self, kept: Any) -> Admitted:
        return Admitted(deque(kept[0] if kept else ()))

    def save(self, state: Admitted) -> tuple | None:
        return (list(state.times),) if state.times else None

    def step(self, state: Admitted, at: float, limit: int) -> tuple:
        return window_step(state, at, limit, self.window_s)


# --- processors of a part ----------------------------------------------------------------


class _AtOnce(StatefulProcessor):
    """The rows of a micro-batch, in time order, change the records of their keys."""

    def __init__(self, columns: list[str], rule: Any, time: str, tie: str | None, ttl_s: float | None = None):
        self.columns, self.rule, self.time, self.ttl_s = [*columns, *PART_COLUMNS], rule, time, ttl_s
        self.order = [time, tie] if tie else [time]

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = int(self.ttl_s * 1000) if self.ttl_s else None
        self.records = handle.getMapState("records", "key string", self.rule.record, ttl)

    def judged(self, rows: pd.DataFrame, states: dict[str, Any]) -> pd.DataFrame:
        """``rows`` in order, with the outputs of the rule; ``states`` holds the keys met so far."""
        results = []
        given = [rows[c].tolist() for c in self.rule.inputs]
        for key, at, *values in zip(rows["_key"].tolist(), _seconds(rows[self.time]), *given):
            if key not in states:
                states[key] = self.rule.load(self.records.getValue((key,)))
            results.append(self.rule.step(states[key], at, *values))
        out = pd.DataFrame(results, columns=list(self.rule.outputs), dtype=object)
        kept = rows.drop(columns=[c for c in (*PART_COLUMNS, "_turn") if c in rows]).reset_index(drop=True)
        return pd.concat([kept, out], axis=1)

    def keep(self, states: dict[str, Any]) -> None:
        for key, state in states.items():
            record = self.rule.save(state)
            if record is not None:
                self.records.updateValue((key,), record)
            elif self.records.containsKey((key,)):
                self.records.removeKey((key,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        states: dict[str, Any] = {}
        out = self.judged(_ordered(_named(rows, self.columns), self.order), states)
        self.keep(states)
        yield out

    def close(self) -> None:
        pass


CHUNK_ROWS = 5_000
RELEASE_ROWS = 20_000


def _packed(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_pandas()


class _Released(_AtOnce):
    """Rows wait in chunks that are sorted by time, and are judged in order when the watermark has passed them.

    A row of the same key, time and tie as one that still waits replaces it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "first long, number long", "rows binary")
        self.number = handle.getValueState("number", "next long")

    def wait(self, frames: Iterator[pd.DataFrame]) -> int | None:
        """Store rows by chunks; returns the first time among them."""
        kept, firsts = self.number.get(), []
        number = kept[0] if kept else 0
        for rows in frames:
            if "_turn" not in rows:
                rows = rows.assign(_turn=number)
            rows = rows.sort_values(self.time, kind="stable")
            at = _micros(rows[self.time])
            for start in range(0, len(rows), CHUNK_ROWS):
                place = int(at[start]), number
                self.waiting.updateValue(place, (_packed(rows.iloc[start : start + CHUNK_ROWS]),))
                firsts.append(place[0])
                number += 1
        self.number.update((number,))
        return min(firsts, default=None)

    def wake(self, soonest: int | None) -> None:
        if soonest is not None:
            self.handle.registerTimer(-(-soonest // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        self.wake(self.wait(_named(rows, self.columns)))
        return iter([])

    def parted(self, frames: list[pd.DataFrame], end: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Rows before ``end``, in order and once each, and the others."""
        rows = pd.concat(frames, ignore_index=True).sort_values([*self.order, "_turn"], kind="stable", ignore_index=True)
        due = _micros(rows[self.time]) < end
        return rows[due].drop_duplicates(["_key", *self.order], keep="last"), rows[~due]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        places = sorted(tuple(p) for p in self.waiting.keys())
        due = [p for p in places if p[0] <= passed]
        later = [p[0] for p in places if p[0] > passed]
        states: dict[str, Any] = {}
        frames, held, most = [], 0, RELEASE_ROWS
        for place in due:
            if held >= most:  # what is before the next chunk needs no other
                ready, rest = self.parted(frames, place[0])
                if len(ready):
                    yield self.judged(ready, states)
                frames, held = [rest], len(rest)
                most = max(RELEASE_ROWS, 2 * held)
            frames.append(_unpacked(self.waiting.getValue(place)[0]))
            held += len(frames[-1])
            self.waiting.removeKey(place)
        if frames:
            ready, rest = self.parted(frames, passed + 1)
            if len(rest):
                later.append(self.wait([rest]))
            if len(ready):
                yield self.judged(ready, states)
            self.keep(states)
        self.wake(min(later, default=None))

    def close(self) -> None:
        pass


def _by_part(rows: DataFrame, keys: list[str], parts: int, processor: _AtOnce, mode: str) -> DataFrame:
    return _parted(rows, keys, parts).groupBy("_part").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=_with_outputs(rows, processor.rule.outputs),
        outputMode="Append",
        timeMode=mode,
    )


class _Decisions(StatefulProcessor):
    def __init__(self, keys: list[str], policy: ScalerPolicy, start_workers: int, dt_s: float):
        self.keys, self.policy, self.start, self.dt_s = keys, policy, start_workers, dt_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "loop", "integral double, error double, workers int, decided_at double"
        )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kept = self.state.get()
        if kept is None:
            state = ScalerState(LoopState(), self.start)
        else:
            state = ScalerState(LoopState(kept[0], kept[1]), kept[2], kept[3])
        batch = _ordered(rows, ["triggered_at"])
        observed = batch["workers"].tolist() if "workers" in batch else [None] * len(batch)
        steps = [
            decision_step(state, at, u, up, p, self.dt_s, self.policy, n)
            for at, u, up, p, n in zip(
                _seconds(batch["triggered_at"]),
                batch["utilization"].tolist(),
                batch["upper_bound"].tolist(),
                batch["spike_probability"].tolist(),
                observed,
            )
        ]
        self.state.update((state.loop.integral, state.loop.error, state.workers, state.decided_at))
        out = pd.DataFrame(steps, columns=list(DECISION_OUTPUTS), dtype=object)
        yield pd.concat([batch, out], axis=1)

    def close(self) -> None:
        pass


def _with_outputs(df: DataFrame, outputs: dict[str, str]) -> str:
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return given + "".join(f", `{n}` {k}" for n, k in outputs.items())


def scaling_decisions(
    steps: DataFrame,
    keys: list[str],
    policy: ScalerPolicy = ScalerPolicy(),
    start_workers: int | None = None,
    dt_s: float = 15.0,
    delay: str | None = None,
) -> DataFrame:
    """Decisions on a stream of control inputs, with the loop as keyed state.

    A column ``workers`` holds the replicas observed at each step; without it the last target counts. With ``delay``
    steps may arrive in any order within it, one per time.
    """
    first = policy.min_workers if start_workers is None else start_workers
    if delay:
        late = steps.withWatermark("triggered_at", delay)
        rule = _Loop(steps.columns, policy, first, dt_s)
        return _by_part(late, keys, PARTS, _Released(steps.columns, rule, "triggered_at", None), "EventTime")
    return steps.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Decisions(keys, policy, first, dt_s),
        outputStructType=_with_outputs(steps, DECISION_OUTPUTS),
        outputMode="Append",
        timeMode="None",
    )


def token_bucket(
    log: DataFrame,
    capacity: float = CAPACITY,
    rates: dict[str, float] | None = None,
    ttl_s: float | None = IDLE_TTL_S,
    delay: str | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """Token-bucket admission of a request stream ``(id, ts, key, role, tokens)``.

    A row with ``reset`` set clears its key. A key that is idle for ``ttl_s`` of
    processing time is forgotten; expiry keeps the query running, so a run that
    is to end at the end of its input passes ``ttl_s=None``. With ``delay``
    requests may arrive in any order within it, and ``ttl_s`` counts event time.
    """
    reset = F.col("reset") if "reset" in log.columns else F.lit(False)
    rows = log.withColumns({"rate": role_rate("role", rates), "reset": reset})
    if delay:
        held = _Released(rows.columns, _BucketRule(capacity, ttl_s), "ts", "id")
        return _by_part(rows.withWatermark("ts", delay), ["key"], parts, held, "EventTime")
    at_once = _AtOnce(rows.columns, _BucketRule(capacity), "ts", "id", ttl_s)
    return _by_part(rows, ["key"], parts, at_once, "ProcessingTime" if ttl_s else "None")


def sliding_window(
    log: DataFrame,
    window_s: int = WINDOW_S,
    rates: dict[str, float] | None = None,
    ttl_s: float | None = IDLE_TTL_S,
    delay: str | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """Sliding-window admission; a key's state is its admitted times, at most ``limit``. With ``delay`` requests may
    arrive in any order within it."""
    rows = log.withColumn("limit", F.floor(role_rate("role", rates) * window_s).cast("bigint"))
    rule = _WindowRule(window_s)
    if delay:
        held = _Released(rows.columns, rule, "ts", "id")
        return _by_part(rows.withWatermark("ts", delay), ["key"], parts, held, "EventTime")
    at_once = _AtOnce(rows.columns, rule, "ts", "id", ttl_s)
    return _by_part(rows, ["key"], parts, at_once, "ProcessingTime" if ttl_s else "None")


class _Silence(StatefulProcessor):
    def __init__(self, silent_s: float):
        self.silent_ms = int(silent_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        newest = max(int(b["timestamp"].astype("datetime64[ms]").astype("int64").max()) for b in rows)
        kept = self.last.get()
        if kept is None or newest > kept[0]:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.silent_ms)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        self.last.clear()
        when = lambda ms: datetime.fromtimestamp(ms / 1000, timezone.utc)
        yield pd.DataFrame(
            {"node_id": [key[0]], "last_seen": [when(last)], "silent_at": [when(last + self.silent_ms)]}
        )

    def close(self) -> None:
        pass


def silent_nodes(metrics: DataFrame, silent_s: float = 300, delay: str = "1 minute") -> DataFrame:
    """One row each time a node has not reported for ``silent_s`` of event time."""
    rows = metrics.select("node_id", "timestamp").withWatermark("timestamp", delay)
    return rows.groupBy("node_id").transformWithStateInPandas(
        statefulProcessor=_Silence(silent_s),
        outputStructType="node_id string, last_seen timestamp, silent_at timestamp",
        outputMode="Append",
        timeMode="EventTime",
    )
