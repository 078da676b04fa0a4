import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dusklark.llm import digest as D
from dusklark.llm import packing as P
from dusklark.session import written


def test_clusters_keep_weight_order_and_ties():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.lognormal(0, 2, 20_000), np.full(9_000, 1.25), [-1e300, 1e300, 5e-324]])
    w, m, lo, hi = D.cluster(np.ones(len(v)), v, v, v, 100)
    assert w.sum() == len(v) and len(w) < 120
    assert (np.diff(m) >= 0).all() and (lo <= m).all() and (m <= hi).all()
    i = np.flatnonzero((lo == 1.25) & (hi == 1.25))
    assert w[i].sum() == 9_000  # the tie stands alone and is met exactly
    assert D.quantile(w, lo, hi, 0.0) == -1e300 and D.quantile(w, lo, hi, 1.0) == 1e300
    assert len(D.cluster(*[np.zeros(0)] * 4)[0]) == 0


def test_rank_error_stays_inside_the_bound():
    rng = np.random.default_rng(2)
    for v in (rng.normal(size=50_000), rng.pareto(0.5, 50_000), rng.integers(0, 20, 50_000).astype(float)):
        parts = [D.cluster(np.ones(len(x)), x, x, x) for x in np.array_split(v, 37)]
        w, m, lo, hi = D.cluster(*[np.concatenate(x) for x in zip(*parts)])
        for p in (0.001, 0.01, 0.25, 0.5, 0.9, 0.999):
            e = D.quantile(w, lo, hi, p)
            assert max((v < e).mean() - p, p - (v <= e).mean(), 0) < 2 * np.pi / D.DELTA


ROWS = [("a", float(i % 100), None, "x") for i in range(2000)] + [(None, 5.0, 1.0, "x")] * 3 + [("b", float("nan"), float("inf"), "x"), ("b", None, -2.0, "x")]


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, grp double, n string")


@pytest.mark.parametrize("parts", [1, 9])
def test_percentiles_are_certified(spark, parts):
    df = table(spark, ROWS).repartition(parts)
    merged = D.merge_digests(D.build_digests(df, F.col("g"), ["v", "grp"]))
    found = written(D.estimates(merged, [0.5, 0.99]), "t")
    got = {(r["grp"], r["metric"], r["p"]): r for r in D.certify(df, F.col("g"), ["v", "grp"], found, [0.5, 0.99]).collect()}
    assert set(got) == {(g, m, p) for g, m in (("a", "v"), (None, "v"), (None, "grp"), ("b", "grp")) for p in (0.5, 0.99)}
    assert got[("a", "v", 0.5)]["n"] == 2000 and got[(None, "v", 0.5)]["value"] == 5.0 and got[("b", "grp", 0.5)]["value"] == -2.0
    assert max(r["rank_error"] for r in got.values()) < 0.01
    values = np.array([r[1] for r in ROWS if r[0] == "a"])
    r = got[("a", "v", 0.99)]
    assert r["rank_low"] == pytest.approx((values < r["value"]).mean()) and r["rank_high"] == pytest.approx((values <= r["value"]).mean())


def test_digests_of_days_combine(spark):
    df = table(spark, ROWS)
    apart = [D.build_digests(df.filter(F.col("v") % 2 == k), F.col("g"), ["v"]) for k in (0, 1)]
    both = D.merge_digests(apart[0].unionByName(apart[1]))
    assert {r["grp"]: r["n"] for r in both.collect()} == {"a": 2000, D.NULL_GROUP: 3}
    e = {r["grp"]: r["values"][0] for r in D.estimates(both, [0.5]).collect()}
    assert abs(e["a"] - 49.5) <= 1


def test_empty_percentiles(spark):
    df = table(spark, [])
    merged = written(D.estimates(D.merge_digests(D.build_digests(df, F.col("g"), ["v"])), [0.5]), "t")
    assert D.certify(df, F.col("g"), ["v"], merged, [0.5]).count() == 0


def loads(histogram, capacity):
    segments, bins = P.plan(dict(histogram), capacity)
    load, count = np.zeros(bins, int), np.zeros(bins, int)
    large = np.zeros(bins, int)
    for i, (s, a, first, per) in enumerate(segments.tolist()):
        z = segments[i + 1][1] if i + 1 < len(segments) and segments[i + 1][0] == s else histogram[s]
        at = first + (np.arange(a, z) - a) // per
        np.add.at(load, at, s)
        np.add.at(count, at, 1)
        if 3 * s > capacity:
            np.add.at(large, at, 1)
    return load, count, large


@pytest.mark.parametrize("capacity", [1, 2, 3, 10, 97, 512])
def test_plans_place_every_item_once(capacity):
    rng = random.Random(capacity)
    for _ in range(20):
        h = {rng.randint(1, capacity): rng.choice([1, 2, 3, 50, 1001]) for _ in range(rng.randint(1, 30))}
        load, count, large = loads(h, capacity)
        assert load.max() <= capacity and load.min() > 0 and load.sum() == sum(s * n for s, n in h.items())
        assert count.sum() == sum(h.values()) and large.max(initial=0) <= 2
        full = -(-load.sum() // capacity)
        assert len(load) <= 1.5 * full + 1
    assert len(P.plan({}, capacity)[0]) == 0
    with pytest.raises(ValueError):
        P.plan({capacity + 1: 1}, capacity)


def test_items_keep_their_identity(spark):
    rows = [(i, t) for i, t in enumerate([0, 1, 3, 10, 10, 11, 25, 30, None, -1])] + [(None, 4), (3, 10)]
    sizes = spark.createDataFrame(rows, "doc_id long, tokens long")
    items = P.pack(sizes, 10).collect()
    per = {}
    for r in items:
        per.setdefault(r["container"], []).append(r["size"])
    assert all(sum(x) <= 10 for x in per.values())
    cut = sorted((r["part"], r["token_start"], r["size"]) for r in items if r["doc_id"] == 6)
    assert cut == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert sum(1 for r in items if r["doc_id"] == 3) == 2 and sum(1 for r in items if r["doc_id"] is None) == 1
    assert sum(r["size"] for r in items if r["doc_id"] in (0, 8, 9)) == 3  # blank texts take one token each
    assert sum(r["size"] for r in items) == sum(max(t or 0, 1) for _, t in rows)
    assert P.pack(spark.createDataFrame([], "doc_id long, tokens long"), 10).count() == 0


def test_one_size_is_numbered_in_parallel(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_SLOT", 500)
    sizes = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5 + 1).alias("tokens"))
    out = P.containers(P.pack(sizes, 16), 16)
    assert out.agg(F.max("used"), F.sum("n_items")).first()[:] == (16, 9000)
    assert out.select(F.explode("items.doc_id").alias("d")).distinct().count() == 9000


def test_tokens_are_counted_for_whole_texts(spark):
    df = spark.createDataFrame([(2**53 + 1, "one two three", 1), (2, "", 1), (3, None, 1), (4, "word " * 50_000, 1), (5, "<|endoftext|>", 1)], "id long, text string, tokens int")
    got = {r["doc_id"]: r["tokens"] for r in P.token_sizes(df, "id", "text").collect()}
    assert got[2**53 + 1] == 3 and got[2] == got[3] == 0 and got[4] >= 50_000 and got[5] > 1
    assert P.pack_documents(df.limit(0), "id").count() == 0
