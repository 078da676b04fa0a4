import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dusklark.functions.text import identifier
from dusklark.operators import orphans as O
from dusklark.operators import rolling as R
from dusklark.operators.skew import hot_keys, lookup_join
from dusklark.session import scratch


def t(h):
    return dt.datetime(2026, 8, 22) + dt.timedelta(hours=h)


def found(spark, records, voids, children):
    rec = spark.createDataFrame(records, "decision_id string, received_at timestamp, key string")
    voi = spark.createDataFrame(voids, "decision_id string, voided_at timestamp")
    chi = spark.createDataFrame(children, "outcome_id string, decision_id string, received_at timestamp, moment string, kind int")
    exist = O.record_deltas(rec, "decision_id", "received_at", voi, "decision_id", "voided_at")
    refs = O.references("outcome_log", chi, identifier(F.col("outcome_id")), F.col("decision_id"), F.col("received_at"), F.monotonically_increasing_id())
    state = O.apply_deltas(O.apply_deltas(None, O.deltas(refs, refs=F.lit(1))), exist)
    return sorted((r["child_id"] or "", r["key"], r["kind"]) for r in O.orphan_references(refs, state).collect())


def test_kinds_of_orphans(spark):
    records = [("A", t(1), "x"), (" a ", t(0), "x"), ("late", t(9), "x"), ("gone", t(1), "x"), ("gone", t(2), "x"), (None, t(1), "x")]
    voids = [("GONE", t(3)), ("gone", t(7)), ("unknown", t(0)), ("a", t(8)), (None, t(1))]
    children = [
        ("o1", "a", t(0), "m", 1), ("o2", "nope", t(5), "m", 1), ("o3", "LATE\t", t(5), "m", 1), ("o4", "gone", t(3), "m", 1), ("o5", "gone", t(2), "m", 1),
        ("o6", None, t(5), "m", 1), ("o7", " \t", t(5), "m", 1), ("O2 ", "nope", t(6), "m", 1), ("o8", "unknown", t(5), "m", 1), ("o9", "a", t(8), "m", 1), (None, "nope", t(1), "m", 1), (" ", "nope", t(1), "m", 1), ("o10", "nope", None, "m", 1),
    ]
    # children without identifier count one by one
    assert found(spark, records, voids, children) == [("", "nope", "missing"), ("", "nope", "missing"), ("o10", "nope", "missing"), ("o2", "nope", "missing"), ("o3", "late", "late"), ("o4", "gone", "deleted"), ("o8", "unknown", "missing"), ("o9", "a", "deleted")]


def test_moment_is_the_childs_earliest(spark):
    assert found(spark, [("k", t(5), "x")], [], [("o", "k", t(9), "m", 1), ("O", " K", t(4), "m", 1)]) == [("o", "k", "late")]


def test_empty_tables(spark):
    assert found(spark, [], [], []) == []
    assert found(spark, [], [], [("o", "k", t(1), "m", 1)]) == [("o", "k", "missing")]


DELTA = "key string, at timestamp, refs long, exist long"
DELTAS = [("a", t(1), 1, 0), ("a", t(1), 1, 0), ("a", t(2), 0, 1), ("b", t(3), 1, 0), ("c", t(1), 1, 1), ("a", t(1), -2, 0), ("a", t(2), 0, -1), (None, t(1), 5, 0), ("b", t(3), None, None), ("d", None, 0, 1), ("d", t(0), 1, 0)]


def test_deltas_commute_and_cancel(spark):
    d = spark.createDataFrame(DELTAS, DELTA)
    whole = O.apply_deltas(None, d)
    halves = O.apply_deltas(O.apply_deltas(None, d.filter("refs > 0")), d.filter("NOT refs > 0 OR refs IS NULL"))
    want = [("b", t(3), 1, 0), ("c", t(1), 1, 1), ("d", None, 0, 1), ("d", t(0), 1, 0)]
    plain = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert plain(whole) == plain(halves) == sorted(want, key=str)
    assert [r["key"] for r in O.orphan_keys(whole).collect()] == ["b"]
    assert [(r["key"], r["at"], r["kind"]) for r in O.orphan_moments(whole).collect()] == [("b", t(3), "missing")]


def test_stored_state_after_three_batches(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_CHANGES", 2)  # the third batch puts all together
    d = lambda *rows: spark.createDataFrame(rows, DELTA)
    s = O.CountStore(spark, scratch(spark, "counts"))
    with pytest.raises(ValueError):
        s.state()
    keys = lambda: sorted(map(tuple, O.orphan_keys(s.state()).collect()))
    assert s.apply(1, d(("a", t(1), 1, 0), ("b", t(1), 1, 0), ("c", t(0), 0, 1), ("c", t(1), 1, 0)))
    assert keys() == [("a", 1), ("b", 1)]
    assert s.apply(2, d(("a", t(5), 0, 1), ("b", t(6), 1, 0))) and not s.apply(2, d(("z", t(5), 1, 0)))
    assert keys() == [("b", 2)]
    assert s.apply(3, d(("c", t(4), 0, -1), ("b", t(1), -1, 0), ("b", t(6), -1, 0), ("a", t(6), 1, 0), ("c", t(3), 1, 0), ("c", t(4), 1, 0)))
    assert keys() == [("c", 3)]
    assert len(s._manifest()["folders"]) == 1
    # a's first reference came before the record; of c's three only the one from the withdrawal on is an orphan
    assert sorted((r["key"], r["at"], r["refs"], r["kind"]) for r in O.orphan_moments(s.state()).collect()) == [("a", t(1), 1, "late"), ("c", t(4), 1, "deleted")]


def test_current_keys_count_both_child_tables(spark, tmp_path):
    from dusklark.plans import feeds

    tables = {
        "decision_log": ([("a", t(0)), ("b", t(0))], "decision_id string, received_at timestamp"),
        "decision_voids": ([("B", t(1))], "decision_id string, voided_at timestamp"),
        "outcome_log": ([("o1", "b", t(2), 1), ("O1", " B", t(3), 2), ("o2", "a", t(2), 3), ("o3", None, t(2), 4), (None, "b", t(2), 5), (None, "b", t(2), 6)], "outcome_id string, decision_id string, received_at timestamp, delivery_id long"),
        "spread_ledger": ([(1, "B ", t(2)), (2, "nope", t(2)), (3, "a", t(2)), (4, " ", t(2))], "ledger_id long, decision_id string, received_at timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(map(tuple, feeds.p4_current_keys(spark, str(tmp_path)).collect())) == [("b", 4), ("nope", 1)]


def test_hot_key_join_keeps_every_row(spark):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 997 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("4", 2)], "k string, v int")
    assert [r["k"] for r in hot_keys(left.dropna(), ["k"], 0.01)] == ["hot"]
    out = lookup_join(left, right, ["k"], 0.01)
    assert out.count() == 6000 and out.filter("v = 1").count() == 2000 and out.filter("v = 2").count() == 1


ENT = "sku_id long, fc string, date date, units_sold long, rate double, total string, bucket int, first_day string"


def d(n):
    return dt.date(2025, 12, 1) + dt.timedelta(days=n)


def rows_of(spark, rows):
    return spark.createDataFrame([(s, f, None if n is None else d(n), u, r, "x", 1, "y") for s, f, n, u, r in rows], ENT)


@pytest.mark.parametrize("include_today", [True, False])
def test_trailing_totals_match_brute_force(spark, include_today):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2]), rng.choice(["A", "B"]), rng.randrange(100), rng.choice([0, 1, 5, -2, None]), None) for _ in range(300)]
    out = R.trailing_totals(rows_of(spark, rows), ["sku_id", "fc"], "date", "units_sold", [7, 30], include_today)
    got = {(r["sku_id"], r["fc"], r["date"]): (r["total_7d"], r["total_30d"], r["mean_30d"]) for r in out.collect()}
    want = {}
    for e in {(s, f) for s, f, *_ in rows}:
        days = [n for s, f, n, *_ in rows if (s, f) == e]
        for x in range(min(days), max(days) + 1):
            total = lambda w: sum(u or 0 for s, f, n, u, _ in rows if (s, f) == e and (x - w < n <= x if include_today else x - w <= n < x))  # noqa: B023, E731
            want[(*e, d(x))] = (total(7), total(30), total(30) / 30)
    assert got == want


def test_trailing_totals_run_on_to_the_tables_last_day(spark):
    rows = [(1, "A", 0, 4, None), (1, "A", 2, 3, None), (2, "A", 40, 1, None), (None, "A", 60, 1, None)]
    out = R.trailing_totals(rows_of(spark, rows), ["sku_id", "fc"], "date", "units_sold", [7, 30], to_end=True).collect()
    got = {(r["sku_id"], r["date"]): (r["total_7d"], r["total_30d"]) for r in out}
    want = {(1, d(n)): (4 * (n < 7) + 3 * (2 <= n < 9), 4 * (n < 30) + 3 * (2 <= n < 32)) for n in range(41)}
    assert len(out) == 42 and got == {**want, (2, d(40)): (1, 1)}


def test_rolling_nulls_empty_and_periods(spark):
    assert R.trailing_totals(rows_of(spark, []), ["sku_id", "fc"], "date", "units_sold", [7]).count() == 0
    out = R.trailing_totals(rows_of(spark, [(None, "A", 1, 1, None), (1, None, 1, 1, None), (1, "A", None, 1, None), (1, "A", 3, None, None)]), ["sku_id", "fc"], "date", "units_sold", [1]).collect()
    assert [(r["date"], r["total_1d"]) for r in out] == [(d(3), 0)]
    with pytest.raises(ValueError):
        R.trailing_totals(rows_of(spark, []), ["sku_id"], "date", "units_sold", [0])


def test_stale_rates(spark):
    rows = [(1, "A", 0, 3, None), (1, "A", 0, 3, 0.5), (1, "A", 10, 6, 0.2), (1, "A", 30, 1, 0.4), (1, "A", 31, 1, 7 / 30), (1, "A", 31, 2, 7 / 30 + 1e-5), (1, "A", 40, 1, None), (2, "A", 5, 1, float("nan"))]
    bad = R.stale_rates(rows_of(spark, rows), ["sku_id", "fc"], "date", "units_sold", "rate")
    assert sorted((r["sku_id"], r["date"]) for r in bad.collect()) == [(1, d(0)), (1, d(31)), (2, d(5))]
    # the right values themselves aren't reported: day 10 is 6 / 30, day 30 is 12 / 30


def test_trailing_plan_has_no_cross_join(spark):
    out = R.trailing_totals(rows_of(spark, [(1, "A", 0, 3, None)]), ["sku_id", "fc"], "date", "units_sold", [30])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
