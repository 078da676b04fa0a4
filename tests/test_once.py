import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from dusklark.functions.text import instant
from dusklark.operators import once
from dusklark.operators.once import OnceStore, ingest_in_batches, single_winners
from dusklark.session import scratch

SCHEMA = "delivery_id long, message_id string, received_at timestamp, finalized_at string, body string, start string"


def t(day, hour=0):
    return dt.datetime(2026, 8, day, hour)


ROWS = [
    (1, "A", t(1), "2026-08-01T10:00:00+09:00", "x", "s"),
    (2, " a\t", t(2), "2026-08-01T01:30:00Z", "y", None),
    (3, "b", t(2), None, None, None),
    (4, "B", t(3), "2026-08-09 00:00:00", "late", None),
    (5, None, t(3), None, "n1", None),
    (6, None, t(3), None, "n1", None),
    (7, " ", None, None, "blank", None),
    (8, "c", t(4), "2026-08-04", "c", None),
    (8, "c", t(4), "2026-08-04", "c", None),
]


def store(spark, label="once"):
    return OnceStore(spark, scratch(spark, label), "message_id", "delivery_id", "received_at", [instant(F.col("finalized_at")), F.col("received_at")])


def kept(s):
    return sorted(r["delivery_id"] for r in s.current().collect())


def test_one_batch_keeps_one_copy_of_each(spark):
    s = store(spark)
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    # the earliest instant wins whatever its notation; NULL is last; nameless messages stay
    assert kept(s) == [1, 4, 5, 6, 7, 8]
    assert s.current().columns == SCHEMA.replace(",", "").split(" ")[0::2]


def test_batches_in_any_order_agree_with_one_batch(spark):
    for order in (1, -1):
        s = store(spark)
        for row in ROWS[::order]:
            s.ingest(spark.createDataFrame([row], SCHEMA))
        assert kept(s) == [1, 4, 5, 6, 7, 8]


def test_only_affected_days_are_rewritten(spark):
    s = store(spark)
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    before = s.manifest()["data"]
    s.ingest(spark.createDataFrame([(9, "C", t(9), "2026-08-03", "earlier", None), (10, "new", t(3), None, "on a known day", None)], SCHEMA))
    after = s.manifest()["data"]
    assert after["2026-08-01"] == before["2026-08-01"]
    # c has left its day, which is empty now; the third only gains a message
    assert "2026-08-04" not in after and after["2026-08-09"] != before.get("2026-08-09")
    assert after["2026-08-03"][:-1] == before["2026-08-03"] and len(after["2026-08-03"]) == 2
    assert kept(s) == [1, 4, 5, 6, 7, 9, 10]


def test_repeated_batch_changes_nothing(spark):
    s = store(spark)
    df = spark.createDataFrame(ROWS, SCHEMA)
    s.ingest(df)
    first = sorted(map(str, s.current().collect()))
    s.ingest(df)
    assert sorted(map(str, s.current().collect())) == first


def test_creation_is_exclusive(spark):
    s = store(spark)
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    path = f"{s.path}/manifest/00000001.json"
    held = s.files.read(path)
    assert not s.files.write_new(path, json.dumps({}))
    # also where the file appears after the look
    s.files.exists = lambda _: False
    assert not s.files.write_new(path, json.dumps({})) and s.files.read(path) == held


class Killed(Exception):
    pass


@pytest.mark.parametrize("history", [False, True])
@pytest.mark.parametrize("point", ["_parts", "_file", "write_new"])
def test_a_writer_that_dies_anywhere_leaves_the_store_usable(spark, point, history):
    """``_parts`` dies after the messages, ``_file`` before the index, ``write_new`` before the manifest."""
    s = store(spark)
    if history:
        s.ingest(spark.createDataFrame(ROWS[:3], SCHEMA))
    dead = OnceStore(spark, s.path, s.id_col, s.delivery_col, s.period_col, s.order[:-1])

    def die(*_):
        raise Killed

    setattr(dead.files if point == "write_new" else dead, point, die)
    for _ in range(2):
        with pytest.raises(Killed):
            dead.ingest(spark.createDataFrame(ROWS, SCHEMA))
    assert not history or kept(s) == [1, 3]
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    assert kept(s) == [1, 4, 5, 6, 7, 8]
    left = s.vacuum(age=0)
    assert len([f for f in left if f.startswith("data/")]) == 2
    assert kept(s) == [1, 4, 5, 6, 7, 8] and s.vacuum(age=0) == []


def test_two_writers_both_come_through(spark):
    """The slower one finds its version taken after all its writing, and starts over from the other's."""
    s, other = store(spark), None
    s.ingest(spark.createDataFrame(ROWS[:2], SCHEMA))
    other = OnceStore(spark, s.path, s.id_col, s.delivery_col, s.period_col, s.order[:-1])
    prepare, raced = s._prepare, []

    def slow(*args):
        out = prepare(*args)
        if not raced:
            raced.append(other.ingest(spark.createDataFrame(ROWS[2:5], SCHEMA)))
        return out

    s._prepare = slow
    assert s.ingest(spark.createDataFrame(ROWS[5:], SCHEMA)) == 3 and raced == [2]
    assert kept(s) == kept(other) == [1, 4, 5, 6, 7, 8]
    assert s.vacuum(age=0) == []


def test_two_writers_at_once(spark):
    s = store(spark)
    parts = [ROWS[:3], ROWS[3:6], ROWS[6:]]
    with ThreadPoolExecutor(3) as pool:
        of = lambda: OnceStore(spark, s.path, s.id_col, s.delivery_col, s.period_col, s.order[:-1])
        got = sorted(pool.map(lambda rows: of().ingest(spark.createDataFrame(rows, SCHEMA)), parts))
    assert got == [1, 2, 3] and kept(s) == [1, 4, 5, 6, 7, 8]


def test_index_grows_and_is_put_together(spark, monkeypatch):
    monkeypatch.setattr(once, "SLOT_ENTRIES", 6)
    monkeypatch.setattr(once, "MAX_CHANGES", 2)
    s, want = store(spark), set()
    for n in range(7):
        rows = [(100 * n + i, f"k{n}-{i}", t(1 + i), None, "x", None) for i in range(4)] + [(100 * n + 50, f"k{max(0, n - 2)}-1", t(20 + n), None, "again", None)]
        s.ingest(spark.createDataFrame(rows, SCHEMA))
        want |= {100 * n + i for i in range(4)}
    now = s.manifest()
    assert set(kept(s)) == want and now["entries"] == 28 and now["slots"] == 8
    assert all(len(a) <= 2 for a in now["index"].values()) and all(len(a) <= 3 for a in now["data"].values())
    listed = s._latest(s._read("index", "once_slot__", now["index"], None, s._ENTRY))
    assert listed.count() == 28
    # superseded versions are gone, the kept ones stay readable
    assert len(s._versions()) == once.KEEP_VERSIONS and s.vacuum(age=0) == []


def test_days_out_of_range_and_maps(spark):
    rows = [(1, "a", dt.datetime(1903, 1, 1), {"x": 1}), (2, "b", dt.datetime(4000, 1, 1), None), (3, "a ", dt.datetime(2026, 1, 1), {}), (3, "a ", dt.datetime(2026, 1, 1), {})]
    df = spark.createDataFrame(rows, "delivery_id long, message_id string, received_at timestamp, props map<string,int>")
    s = OnceStore(spark, scratch(spark, "once"), "message_id", "delivery_id", "received_at", [F.col("received_at")])
    s.ingest(df)
    s.ingest(df)
    assert kept(s) == [1, 2] and set(s.manifest()["data"]) == {"outside"}


def test_unpublished_version_is_invisible(spark):
    s = store(spark)
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    spark.range(3).write.parquet(f"{s.path}/data/00000002-x/once_period__=2026-08-01")
    assert kept(s) == [1, 4, 5, 6, 7, 8]


def test_empty_batch_and_groups(spark):
    s = store(spark)
    empty = spark.createDataFrame([], SCHEMA)
    ingest_in_batches(s, empty, "body", "received_at", 2)
    assert kept(s) == []
    s.ingest(spark.createDataFrame(ROWS, SCHEMA))
    assert kept(s) == [1, 4, 5, 6, 7, 8]
    for column in ("body", "start"):  # as batches; most of the second are NULL
        two = store(spark)
        ingest_in_batches(two, spark.createDataFrame(ROWS, SCHEMA), column, "received_at", 3)
        assert kept(two) == [1, 4, 5, 6, 7, 8] and two.manifest()["version"] == 3


def test_reading_before_the_first_batch_is_an_error(spark):
    with pytest.raises(ValueError):
        store(spark).current()


def test_hot_identifier_is_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (-F.col("id")).alias("v"))
    out = single_winners(df, "k", [F.col("v")])
    assert out.count() == 20_001
    assert out.filter("k = 'hot'").first()["v"] == -29_997
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()
