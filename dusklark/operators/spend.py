"""Totals that run over a sorted column, and the spend that a threshold on costs implies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_total(df: DataFrame, order: str, value: str, buckets: int = 64) -> DataFrame:
    """``order, value, running``: the total of ``value`` up to and with each ``order``, over one row per order value.

    A prefix sum in two levels: approximate quantiles (at most ``buckets`` numbers) cut the order into ranges, ranges
    are summed, and each row adds its range's offset to the sum inside it. No task sees more than one range.
    """
    one = df.dropna(subset=[order]).groupBy(order).agg(F.sum(value).alias(value))
    cuts = one.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 1000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    at: Column = F.lit(0)
    for x in cuts:
        at = at + (F.col(order) > F.lit(x)).cast("int")
    d = one.withColumn("_b", at)
    sums = d.groupBy("_b").agg(F.sum(value).alias("_s"))  # at most ``buckets`` rows
    before = sums.select("_b", F.coalesce(F.sum("_s").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"))
    inside = F.sum(value).over(W.partitionBy("_b").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return d.join(F.broadcast(before), "_b").select(order, value, (F.col("_before") + inside).alias("running"))


def mean_affordable(costs: Column, threshold: Column) -> Column:
    """Mean of the costs up to a threshold; 0 if there is none."""
    ok = F.filter(costs, lambda x: x <= threshold)
    return F.when(F.size(ok) > 0, F.aggregate(ok, F.lit(0.0), lambda a, x: a + x) / F.size(ok)).otherwise(F.lit(0.0))


def spend_by_day(ledger: DataFrame, threshold: float) -> DataFrame:
    """Expected spend per day when each decision draws evenly from its affordable costs: ``day, spend, decisions``."""
    x = ledger.select("day", mean_affordable(F.col("costs"), F.lit(threshold)).alias("s"))
    return x.groupBy("day").agg(F.sum("s").alias("spend"), F.count(F.lit(1)).alias("decisions"))


def spend_curve(ledger: DataFrame) -> DataFrame:
    """Total expected spend just at each cost that occurs: ``tau, spend``.

    A decision's mean over its affordable costs changes only where one of them crosses the threshold. The changes of
    all decisions, summed in order of the threshold, are the curve: one pass instead of a search with a pass per step.
    """
    s = F.array_sort(F.filter("costs", lambda x: x.isNotNull() & ~F.isnan(x)))
    e = ledger.select(F.posexplode(s).alias("i", "tau"), s.alias("s"))
    upto = F.aggregate(F.slice("s", F.lit(1), F.col("i") + 1), F.lit(0.0), lambda a, x: a + x) / (F.col("i") + 1)
    before = F.when(F.col("i") > 0, F.aggregate(F.slice("s", F.lit(1), F.col("i")), F.lit(0.0), lambda a, x: a + x) / F.col("i")).otherwise(F.lit(0.0))
    deltas = e.select("tau", (upto - before).alias("delta"))
    return running_total(deltas, "tau", "delta").select("tau", F.col("running").alias("spend"))


def solve_threshold(ledger: DataFrame, budget: float) -> DataFrame:
    """The largest cost at which the expected spend is still below the budget: ``tau, spend`` (no row if there is none)."""
    below = spend_curve(ledger).filter(F.col("spend") < budget)
    return below.agg(F.max(F.struct("tau", "spend")).alias("b")).filter("b IS NOT NULL").select("b.*")
