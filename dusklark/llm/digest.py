"""Percentiles of very large numeric columns from merging centroid digests.

A digest is a list of centroids in ascending order, each with its weight, mean and the range of the values in it.
Sorted values are clustered under the size function k(q) = delta / (2 pi) * asin(2 q - 1): a cluster may span at most
one unit of k, so clusters are small at both tails. Digests are merged by putting their centroids together and
clustering again, in any order and grouping; partitions, days and months can be summarised apart and combined later.
Equal values stay in a centroid of their own as soon as they outgrow a cluster, so ties are met exactly.

What a digest can't promise by itself is certified afterwards: a second pass counts, for every reported value, the
rows below it and up to it, and reports the distance between the asked and the reached rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dusklark.operators.skew import lookup_join

DELTA = 400
#: Values held per group before they are clustered, and centroids held by a task before it hands them on.
BUFFER, HELD = 1 << 16, 1 << 21
#: Up to so many groups the reported values are broadcast for the counting pass; beyond, they are joined.
BROADCAST_GROUPS = 10_000
NULL_GROUP = "\u0000"
SCHEMA = "grp string, metric string, lane long, n long, weights array<double>, means array<double>, lows array<double>, highs array<double>"
ARROW = pa.schema([("grp", pa.string()), ("metric", pa.string()), ("lane", pa.int64()), ("n", pa.int64()), *((c, pa.list_(pa.float64())) for c in ("weights", "means", "lows", "highs"))])


def scale(q: np.ndarray, delta: float) -> np.ndarray:
    return delta / (2 * np.pi) * np.arcsin(np.clip(2 * q - 1, -1.0, 1.0))


def cluster(weights: np.ndarray, means: np.ndarray, lows: np.ndarray, highs: np.ndarray, delta: float = DELTA) -> tuple[np.ndarray, ...]:
    """Cluster centroids (any order) into at most about ``delta / 2`` plus the heavy ties."""
    if len(weights) == 0:
        return weights, means, lows, highs
    order = np.lexsort((highs, lows, means))
    w, m, lo, hi = weights[order], means[order], lows[order], highs[order]
    # equal values first
    point = lo == hi
    same = np.concatenate([[False], point[1:] & point[:-1] & (m[1:] == m[:-1])])
    start = np.flatnonzero(~same)
    w, m, lo, hi = np.add.reduceat(w, start), m[start], lo[start], hi[start]
    total = w.sum()
    right = np.minimum(np.cumsum(w) / total, 1.0)
    left = np.concatenate([[0.0], right[:-1]])
    unit = np.floor(scale((left + right) / 2, delta) - scale(np.zeros(1), delta)[0]).astype(np.int64)
    heavy = scale(right, delta) - scale(left, delta) >= 1.0
    cut = np.concatenate([[True], (unit[1:] != unit[:-1]) | heavy[1:] | heavy[:-1]])
    start = np.flatnonzero(cut)
    mass = np.add.reduceat(w, start)
    # shifted by each cluster's first value, so that huge and tiny values don't cancel and a lone value stays exact
    base = m[start]
    shift = np.add.reduceat(w / np.repeat(mass, np.diff(np.append(start, len(w)))) * (m - np.repeat(base, np.diff(np.append(start, len(w))))), start)
    return mass, base + shift, np.minimum.reduceat(lo, start), np.maximum.reduceat(hi, start)


def quantile(weights: np.ndarray, lows: np.ndarray, highs: np.ndarray, p: float) -> float:
    """The value at rank ``p`` times the total weight, interpolated inside the centroid's own range."""
    edges = np.cumsum(weights)
    at = p * edges[-1]
    i = int(min(np.searchsorted(edges, at, side="left"), len(edges) - 1))
    inside = (at - (edges[i] - weights[i])) / weights[i]
    return float(lows[i] + (highs[i] - lows[i]) * min(max(inside, 0.0), 1.0))


def _row(grp: str, metric: str, lane: int, d: tuple[np.ndarray, ...]) -> tuple:
    return (grp, metric, lane, int(round(d[0].sum())), *(x.tolist() for x in d))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(ARROW)], schema=ARROW)


def _builder(metrics: list[str], delta: float):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId() if TaskContext.get() else 0
        loose: dict[tuple[str, str], list[np.ndarray]] = {}
        sizes: dict[tuple[str, str], int] = {}
        done: dict[tuple[str, str], tuple[np.ndarray, ...]] = {}

        def settle(key: tuple[str, str]) -> None:
            v = np.concatenate(loose.pop(key))
            parts = (np.ones(len(v)), v, v, v)
            if key in done:
                parts = tuple(np.concatenate(x) for x in zip(done[key], parts))
            done[key] = cluster(*parts, delta)
            sizes[key] = 0

        def flush() -> list[tuple]:
            for key in list(loose):
                settle(key)
            rows = [_row(*key, lane, d) for key, d in done.items()]
            done.clear()
            sizes.clear()
            return rows

        for b in batches:
            groups = b.column("grp").dictionary_encode()
            codes, names = groups.indices.to_numpy(zero_copy_only=False), groups.dictionary.to_pylist()
            order = np.argsort(codes, kind="stable")
            bounds = np.searchsorted(codes[order], np.arange(len(names) + 1))
            for i, metric in enumerate(metrics):
                v = b.column(f"_x_{i}").to_numpy(zero_copy_only=False).astype(np.float64)[order]
                for g, name in enumerate(names):
                    x = v[bounds[g] : bounds[g + 1]]
                    x = x[np.isfinite(x)]
                    if len(x):
                        key = (name, metric)
                        loose.setdefault(key, []).append(x)
                        sizes[key] = sizes.get(key, 0) + len(x)
                        if sizes[key] >= BUFFER:
                            settle(key)
            if sum(sizes.values()) + len(done) * delta > HELD and (rows := flush()):
                yield _batch(rows)
        if rows := flush():
            yield _batch(rows)

    return build


def _merge(delta: float):
    def merge(t: pa.Table) -> pa.Table:
        d = [t.column(c).combine_chunks() for c in ("weights", "means", "lows", "highs")]
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in d]
        first = t.slice(0, 1).to_pylist()[0]
        return pa.Table.from_batches([_batch([_row(first["grp"], first["metric"], first["lane"], cluster(*flat, delta))])])

    return merge


def build_digests(df: DataFrame, group: Column, metrics: list[str], delta: float = DELTA) -> DataFrame:
    """Digests of several numeric columns per group: one row per task, group and metric (schema ``SCHEMA``).

    NULL, NaN and infinite values are left out; rows with a NULL group form a group of their own; a group without a
    value has no digest, and an empty table gives none. Each task reduces its rows to centroids before anything is
    sent, whatever share of the rows a group holds.
    """
    plain = df.select(F.coalesce(group.cast("string"), F.lit(NULL_GROUP)).alias("grp"), *[F.col(m).cast("double").alias(f"_x_{i}") for i, m in enumerate(metrics)])
    return plain.mapInArrow(_builder(metrics, delta), SCHEMA)


def merge_digests(digests: DataFrame, delta: float = DELTA, lanes: int = 64) -> DataFrame:
    """One digest per group and metric, merged in two rounds: first inside each of ``lanes`` lanes, then across them.

    No task sees more than its lane's share of a group's digests, or one digest per lane.
    """
    laned = digests.withColumn("lane", F.pmod("lane", F.lit(lanes)))
    half = laned.groupBy("grp", "metric", "lane").applyInArrow(_merge(delta), SCHEMA)
    return half.groupBy("grp", "metric").applyInArrow(_merge(delta), SCHEMA)


def estimates(digests: DataFrame, probs: list[float]) -> DataFrame:
    """``grp, metric, n, values``: the estimate for each probability, in order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            out = [[quantile(np.array(r["weights"]), np.array(r["lows"]), np.array(r["highs"]), p) for p in probs] for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("metric"), b.column("n"), pa.array(out, type=pa.list_(pa.float64()))], names=["grp", "metric", "n", "values"])

    return digests.mapInArrow(read, "grp string, metric string, n long, values array<double>")


def certify(df: DataFrame, group: Column, metrics: list[str], found: DataFrame, probs: list[float]) -> DataFrame:
    """Count each estimate's true ranks over all rows: ``grp, metric, p, value, n, rank_low, rank_high, rank_error``.

    ``rank_low`` is the share of values below the estimate, ``rank_high`` the share up to it; the error is the
    distance of ``p`` from that range. ``found`` should be a written table, for it is read twice. ``n`` is counted here
    and may differ from the digest's where the rows changed in between.
    """
    per_group = found.groupBy("grp").agg(*[F.max(F.when(F.col("metric") == m, F.col("values"))).alias(f"_v_{i}") for i, m in enumerate(metrics)])
    plain = df.select(F.coalesce(group.cast("string"), F.lit(NULL_GROUP)).alias("grp"), *[F.col(m).cast("double").alias(f"_x_{i}") for i, m in enumerate(metrics)])
    small = found.select("grp").distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    joined = plain.join(F.broadcast(per_group), "grp", "left") if small else lookup_join(plain, per_group, ["grp"])
    counts = []
    for i in range(len(metrics)):
        x = F.col(f"_x_{i}")
        ok = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
        counts.append(F.count(F.when(ok, 1)).alias(f"_n_{i}"))
        for j in range(len(probs)):
            v = F.col(f"_v_{i}")[j]
            counts += [F.count(F.when(ok & (x < v), 1)).alias(f"_lt_{i}_{j}"), F.count(F.when(ok & (x <= v), 1)).alias(f"_le_{i}_{j}")]
    counted = joined.groupBy("grp").agg(*counts).join(per_group, "grp")
    cells = [
        F.struct(F.lit(m).alias("metric"), F.lit(float(p)).alias("p"), F.col(f"_v_{i}")[j].alias("value"), F.col(f"_n_{i}").alias("n"), F.col(f"_lt_{i}_{j}").alias("lt"), F.col(f"_le_{i}_{j}").alias("le"))
        for i, m in enumerate(metrics)
        for j, p in enumerate(probs)
    ]
    rows = counted.select("grp", F.explode(F.array(*cells)).alias("c")).select("grp", "c.*").filter("n > 0")
    rows = rows.withColumn("rank_low", F.col("lt") / F.col("n")).withColumn("rank_high", F.col("le") / F.col("n"))
    error = F.greatest(F.lit(0.0), F.col("rank_low") - F.col("p"), F.col("p") - F.col("rank_high"))
    shown = F.when(F.col("grp") != NULL_GROUP, F.col("grp")).alias("grp")
    return rows.select(shown, "metric", "p", "value", "n", "rank_low", "rank_high", error.alias("rank_error"))
