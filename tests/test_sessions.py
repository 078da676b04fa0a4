import datetime as dt
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dusklark.operators.intervals import Intervals, countdown, merge_sorted, of_events
from dusklark.operators.sessions import hour_text, merge_sessions, selling_episodes
from dusklark.streaming.sessions import episodes_stream, sessionize_stream

RAW = "row_id long, date date, hour_of_day long, sku_id long, fc string, hours_remaining double, loaded_at timestamp, start string, _t string, events string"


def raw(spark, rows):
    """rows: row_id, day, hour, sku, fc, counter, loaded"""
    full = [(i, dt.date(2026, 3, d), h, s, f, c, dt.datetime(2026, 3, 20, n), "x", "y", "z") for i, d, h, s, f, c, n in rows]
    return spark.createDataFrame(full, RAW)


def episodes(spark, rows, bucket=24 * 28):
    e = selling_episodes(raw(spark, rows), bucket)
    return sorted((r["sku_id"], r["fc"], r["a"], r["z"], r["events"]) for r in e.select("sku_id", "fc", hour_text(F.col("start")).alias("a"), hour_text(F.col("end")).alias("z"), "events").collect())


def test_midnight_gap_counter_and_unknown_counters(spark):
    rows = [
        (1, 2, 23, 1, "AA1", 3.0, 1), (2, 2, 24, 1, " aa1", 2.0, 1), (3, 3, 1, 1, "AA1", 1.0, 1),  # over midnight, hour 24
        (4, 3, 2, 1, "AA1", 9.0, 1),  # countdown breaks
        (5, 3, 4, 1, "AA1", 8.0, 1),  # clock breaks
        (6, 3, 5, 1, "AA1", None, 1), (7, 3, 6, 1, "AA1", 40.0, 1), (8, 3, 7, 1, "AA1", -1.0, 1), (9, 3, 8, 1, "AA1", float("nan"), 1),  # clock alone
        (10, 3, 9, 2, "AA1", 5.0, 1),
    ]
    assert episodes(spark, rows) == [
        (1, "AA1", "2026-03-02T23", "2026-03-03T01", 3),
        (1, "AA1", "2026-03-03T02", "2026-03-03T02", 1),
        (1, "AA1", "2026-03-03T04", "2026-03-03T08", 5),
        (2, "AA1", "2026-03-03T09", "2026-03-03T09", 1),
    ]


def test_the_latest_load_counts_then_the_largest_row(spark):
    rows = [(1, 2, 10, 1, "A", 5.0, 1), (2, 2, 11, 1, "A", 4.0, 2), (3, 2, 11, 1, "A", 9.0, 1), (4, 2, 12, 1, "A", 9.0, 5), (5, 2, 12, 1, "A", 3.0, 5), (5, 2, 12, 1, "A", 3.0, 5)]
    assert episodes(spark, rows) == [(1, "A", "2026-03-02T10", "2026-03-02T12", 3)]


def test_nulls_and_empty(spark):
    rows = [(1, 2, None, 1, "A", 5.0, 1), (2, 2, 11, None, "A", 4.0, 2), (3, 2, 11, 1, None, 9.0, 1), (4, 2, 11, 1, " ", 9.0, 1)]
    assert episodes(spark, rows) == []
    assert episodes(spark, []) == []


def test_bucket_width_does_not_matter(spark):
    rng = random.Random(1)
    rows, c = [], 50.0
    for i in range(300):
        c = c - 1 if rng.random() < 0.8 else rng.choice([50.0, None, -1.0])
        c = 50.0 if c is None and rng.random() < 0.5 else c
        if rng.random() < 0.9:
            rows.append((i, 1 + i // 24, i % 24, 1, "A", c, 1))
        c = 30.0 if c is None else c
    assert episodes(spark, rows, 3) == episodes(spark, rows, 7) == episodes(spark, rows, 10_000)


def naive(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1][1] = t
            out[-1][2] += 1
        else:
            out.append([t, t, 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("gap,bucket", [(5, 3), (5, 50), (1, 1), (30, 7)])
def test_general_sessions_match_a_plain_scan(spark, gap, bucket):
    rng = random.Random(gap * bucket)
    times = [rng.randrange(-200, 1500) for _ in range(250)] + [7, 7, 7]
    df = spark.createDataFrame([("k", t, 1) for t in times] + [("k2", None, 1), (None, 3, 1)], "user string, at long, start int")
    got = sorted((r["start"], r["end"], r["events"]) for r in merge_sessions(df, ["user"], "at", gap, bucket).collect())
    assert got == naive(times, gap)


def test_rule_sees_neighbours_across_buckets(spark):
    df = spark.createDataFrame([("k", t, float(c)) for t, c in [(0, 9), (1, 8), (2, 7), (3, 3), (4, 2)]], "k string, t long, c double")
    got = sorted((r["start"], r["end"], r["duration"]) for r in merge_sessions(df, ["k"], "t", 1, 2, "c", countdown).collect())
    assert got == [(0, 2, 2), (3, 4, 1)]


def test_merging_merged_intervals_is_merging_all():
    rng = np.random.default_rng(2)
    for rule in (None, countdown):
        t = np.unique(rng.integers(0, 400, 200))
        c = np.where(rng.random(len(t)) < 0.2, np.nan, 1000.0 - t + (rng.random(len(t)) < 0.1))
        whole = of_events(t, c, None, 3).merged(rule)[1:]
        for cuts in ([50], [3, 4, 5, 90], list(range(1, len(t)))):
            parts = [of_events(x, y, None, 3).merged(rule)[1:] for x, y in zip(np.split(t, cuts), np.split(c, cuts))]
            joined = [np.concatenate(x) for x in zip(*parts)]
            again = Intervals(*joined, np.zeros(len(joined[0]) - 1, dtype=bool)).merged(rule)[1:]
            assert all(np.array_equal(a, b, equal_nan=True) for a, b in zip(whole, again))
    assert all(len(x) == 0 for x in of_events(np.zeros(0), None, None, 5).merged())


def test_nested_intervals_and_groups():
    i = Intervals(np.array([0, 2, 5, 6, 0]), np.array([20, 4, 6, 9, 3]), *[np.full(5, np.nan)] * 2, np.array([1, 2, 3, 4, 5]), np.array([False, False, False, True]))
    at, start, until, _, _, n = i.merged()
    assert (at.tolist(), start.tolist(), until.tolist(), n.tolist()) == ([0, 4], [0, 0], [20, 3], [10, 5])


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_groups_run_over_batches(size):
    rng = random.Random(size)
    rows = sorted({(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.randrange(60)) for _ in range(120)}, key=lambda r: (r[0] or "", r[1], r[2]))
    table = pa.table({"k": [r[0] for r in rows], "_b0": [r[1] for r in rows], "_b1": [r[1] for r in rows], "_start": [r[2] for r in rows], "_until": [r[2] + 2 for r in rows], "_first": pa.array([None] * len(rows), pa.float64()), "_last": pa.array([None] * len(rows), pa.float64()), "_n": [1] * len(rows)})
    got = [r for b in merge_sorted(iter(table.to_batches(max_chunksize=size)), ["k", "_b0"], None, False) for r in b.to_pylist()]
    want = []
    for key in dict.fromkeys(r[:2] for r in rows):
        found = naive([r[2] for r in rows if r[:2] == key], 2)
        want += [(*key, a, z + 2, n, i in (0, len(found) - 1)) for i, (a, z, n) in enumerate(found)]
    assert [(r["k"], r["_b0"], r["_start"], r["_until"], r["_n"], r["_edge"]) for r in got] == want


def test_stream_closes_sessions_and_takes_late_events(spark, tmp_path):
    src = str(tmp_path / "in")
    base = dt.datetime(2026, 3, 1, 10)
    schema = "user string, ts timestamp"
    batches = [
        [("a", 0), ("a", 200), ("b", 10), (None, 5)],
        [("a", 100), ("b", 5000)],  # late event bridges a's two intervals
        [("b", 20_000)],
        [("b", 40_000)],
    ]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame([(u, base + dt.timedelta(seconds=s)) for u, s in rows], schema).coalesce(1)
        df.write.mode("append").parquet(f"{src}/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{src}/*")
    out = sessionize_stream(stream, "user", "ts", 120, "1 hour")
    q = out.writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    t0 = int(base.replace(tzinfo=dt.timezone.utc).timestamp())
    got = sorted((r["key"], r["start"] - t0, r["end"] - t0, r["events"]) for r in spark.table("closed").collect())
    assert ("a", 0, 200, 3) in got and ("b", 10, 10, 1) in got


RAW_COLUMNS = ["row_id", "date", "hour_of_day", "sku_id", "fc", "hours_remaining", "loaded_at"]


def episodes_of_stream(spark, tmp_path, parts, watermark):
    """Rows in the given parts, one micro-batch each, and a row far later that moves the watermark past all."""
    schema = parts[0].select(*RAW_COLUMNS).schema
    end = spark.createDataFrame([(10**9, dt.date(2030, 1, d), 0, -1, "END", None, None) for d in (1, 2)], schema)
    for n, df in enumerate([*parts, end.filter("date = '2030-01-01'"), end.filter("date = '2030-01-02'")]):
        df.select(*RAW_COLUMNS).coalesce(1).write.parquet(str(tmp_path / f"in/{n:03d}"))
        time.sleep(0.05)  # files are taken in the order of their times
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    name = f"episodes_{tmp_path.name.replace('-', '_')}"
    q = episodes_stream(stream, watermark).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(600)
    return sorted((r["sku_id"], r["fc"], r["start"], r["end"], r["events"]) for r in spark.table(name).collect() if r["fc"] != "END")


def test_stream_of_episodes_takes_late_and_corrected_hours(spark, tmp_path):
    first = [(1, 2, 10, 1, "A", 5.0, 1), (2, 2, 12, 1, "A", 3.0, 1), (3, 2, 13, 1, "A", 9.0, 1), (4, 2, 20, 2, "A", None, 1)]
    second = [(5, 2, 11, 1, "a ", 4.0, 3), (6, 2, 13, 1, "A", 2.0, 2), (7, 2, 12, 1, "A", 7.0, 0), (8, 4, 20, 2, "A", None, 1)]
    third, fourth = [(9, 6, 1, 3, "A", 1.0, 5)], [(12, 6, 2, 3, "A", 0.0, 5)]  # the engine drops what the watermark before last has passed
    late = [(10, 2, 14, 1, "A", 1.0, 5), (11, 2, 21, 2, "A", 1.0, 6)]  # behind the watermark by then
    got = episodes_of_stream(spark, tmp_path, [raw(spark, x) for x in (first, second, third, fourth, late)], "3 days")
    day = (dt.date(2026, 3, 2) - dt.date(1970, 1, 1)).days * 24
    assert got == [(1, "A", day + 10, day + 13, 4), (2, "A", day + 20, day + 20, 1), (2, "A", day + 68, day + 68, 1), (3, "A", day + 97, day + 98, 2)]


def test_stream_equals_batch_on_the_hourly_rows(spark, tmp_path):
    """Rows in the order in which they were loaded, most of them in time, some days late, some corrected."""
    t = spark.read.parquet("/root/testdata/sf0.001/flc_raw.parquet").select(*RAW_COLUMNS)
    cuts = [dt.datetime(2026, 1, 1), *(dt.datetime(2026, m, 1) for m in (5, 7)), dt.datetime(2027, 1, 1)]
    parts = [t.filter((F.col("loaded_at") >= a) & (F.col("loaded_at") < z)) for a, z in zip(cuts, cuts[1:])]
    assert sum(p.count() for p in parts) == t.count()
    want = sorted((r["sku_id"], r["fc"], r["start"], r["end"], r["events"]) for r in selling_episodes(t).collect())
    assert episodes_of_stream(spark, tmp_path, parts, "60 days") == want and len(want) > 100
