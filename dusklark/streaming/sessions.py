"""Sessions over a stream: interval state per key, merged as events arrive, closed by the watermark.

Every event opens an interval of one gap; overlapping or touching intervals merge (:mod:`dusklark.operators.intervals`,
as for tables), so late events join, extend or bridge sessions as long as these are open. A session is final, and
leaves the state, once the watermark has passed its end by more than the gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dusklark.operators.intervals import Intervals, Rule, countdown, of_events
from dusklark.operators.sessions import hourly

SCHEMA = "start long, end long, duration long, events long"
STATE = "starts array<long>, untils array<long>, counts array<long>"
#: With a rule, the state keeps the events themselves: a later one may stand between them, or replace one.
EVENT_STATE = "moments array<long>, ranks array<long>, rows array<long>, counters array<double>"


def _seconds(ts: pd.Series) -> np.ndarray:
    return ts.to_numpy().astype("datetime64[s]").astype(np.int64)


def _wake(state: GroupState, until: int, unit: int) -> None:
    """Come back when the watermark has passed ``until``."""
    state.setTimeoutTimestamp(max((until + 1) * unit * 1000, state.getCurrentWatermarkMs() + 1))


def _closed(key: tuple, names: list[str], starts: np.ndarray, untils: np.ndarray, counts: np.ndarray, gap: int) -> pd.DataFrame:
    ends = untils - gap
    return pd.DataFrame({n: [k] * len(starts) for n, k in zip(names, key)} | {"start": starts, "end": ends, "duration": ends - starts, "events": counts})


def sessionize_stream(events: DataFrame, key: str, at: str, gap_seconds: int, watermark: str) -> DataFrame:
    """Closed sessions of a stream, in seconds since 1970: ``key, start, end, duration, events``. Rows with a NULL key or time are left out.

    Events older than the watermark are dropped by the engine before they reach the state, which holds the merged open
    intervals. A batch's events of one key are counted per second first, so a hot key costs as many intervals as it
    has distinct seconds.
    """
    stream = events.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withWatermark(at, watermark)
    plain = stream.select(F.col(key).cast("string").alias("key"), F.col(at).alias("ts"))

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, untils, counts = (np.array(x, dtype=np.int64) for x in (state.get if state.exists else ([], [], [])))
        if not state.hasTimedOut:
            for f in frames:
                t, n = np.unique(_seconds(f["ts"]), return_counts=True)
                new = of_events(t, None, n.astype(np.int64), gap_seconds)
                starts, untils, counts = np.append(starts, new.start), np.append(untils, new.until), np.append(counts, new.events)
        order = np.argsort(starts, kind="stable")
        unknown = np.full(len(order), np.nan)
        _, starts, untils, _, _, counts = Intervals(starts[order], untils[order], unknown, unknown, counts[order], np.zeros(max(0, len(order) - 1), dtype=bool)).merged()
        done = untils < state.getCurrentWatermarkMs() // 1000
        left = ~done
        if left.any():
            state.update((starts[left].tolist(), untils[left].tolist(), counts[left].tolist()))
            _wake(state, int(untils[left].min()), 1)
        elif state.exists:
            state.remove()
        yield _closed(k, ["key"], starts[done], untils[done], counts[done], gap_seconds)

    return plain.groupBy("key").applyInPandasWithState(run, f"key string, {SCHEMA}", STATE, "append", GroupStateTimeout.EventTimeTimeout)


def episodes_stream(raw: DataFrame, watermark: str, rule: Rule = countdown) -> DataFrame:
    """Closed selling episodes of a stream of raw hourly rows: ``sku_id, fc, start, end, duration, events`` in hours since 1970.

    Reads rows as the episodes of a table do: of several rows for one hour the one loaded last counts, then the largest
    ``row_id``, whichever batch it comes in. An hour that arrives or is corrected late changes its episode as long as
    the watermark has not closed it; rows older than the watermark are dropped by the engine.
    """
    hours = hourly(raw).withColumn("ts", F.timestamp_seconds(F.col("at_hour") * 3600)).withWatermark("ts", watermark)
    # a missing load time is the earliest
    plain = hours.select("sku_id", "fc", "ts", F.coalesce(F.unix_micros("loaded_at"), F.lit(-(2**63))).alias("rank"), F.coalesce("row_id", F.lit(-(2**63))).alias("row"), "counter")

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [], [], [])
        moments, ranks, rows = (np.array(x, dtype=np.int64) for x in held[:3])
        counters = np.array([np.nan if x is None else x for x in held[3]], dtype=float)
        if not state.hasTimedOut:
            for f in frames:
                moments, counters = np.append(moments, _seconds(f["ts"]) // 3600), np.append(counters, f["counter"].to_numpy(float))
                ranks, rows = np.append(ranks, f["rank"].to_numpy(np.int64)), np.append(rows, f["row"].to_numpy(np.int64))
        order = np.lexsort((rows, ranks, moments))
        order = order[np.append(moments[order][1:] != moments[order][:-1], True)] if len(order) else order
        moments, ranks, rows, counters = moments[order], ranks[order], rows[order], counters[order]
        at, starts, untils, _, _, counts = of_events(moments, counters, None, 1).merged(rule)
        # an episode is final when no hour that could still come would touch it
        done = untils < state.getCurrentWatermarkMs() // 3_600_000
        left = np.repeat(~done, np.diff(np.append(at, len(moments))))
        if left.any():
            state.update(tuple(x[left].tolist() for x in (moments, ranks, rows, counters)))
            _wake(state, int(untils[~done].min()), 3600)
        elif state.exists:
            state.remove()
        yield _closed(k, ["sku_id", "fc"], starts[done], untils[done], counts[done], 1)

    kinds = {f.name: f.dataType.simpleString() for f in T.StructType([*plain.select("sku_id", "fc").schema])}
    return plain.groupBy("sku_id", "fc").applyInPandasWithState(run, f"sku_id {kinds['sku_id']}, fc {kinds['fc']}, {SCHEMA}", EVENT_STATE, "append", GroupStateTimeout.EventTimeTimeout)
