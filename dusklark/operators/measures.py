"""Grouped statistics: ratios of sums, clustered errors, variance shares, robust spread, bins, streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.functions.numbers import ratio

PERCENTS = [0.1, 0.25, 0.5, 0.75, 0.9]
# Edges of the bins of the discount gap, as repeated addition of 0.05 to -0.20 gives them.
GAP_EDGES = [-0.2 + 0.05 * k for k in range(9)]


def percentiles(c: Column, probs: list[float] = PERCENTS) -> list[Column]:
    """Exact percentiles with linear interpolation, ``p10`` and so on. For groups of bounded size; see the digests for others."""
    return [F.percentile(c, F.lit(p)).alias(f"p{round(p * 100)}") for p in probs]


def share(predicate: Column) -> Column:
    """Share of rows for which the predicate is true; an unknown one counts as false."""
    return F.avg(F.coalesce(predicate, F.lit(False)).cast("double"))


def ratio_cuts(df: DataFrame, numerator: str, denominator: str, cuts: list[list[str]]) -> DataFrame:
    """Ratio of sums, overall and per cut, in one pass (grouping sets): cut columns, ``numerator, denominator, ratio``."""
    columns = list(dict.fromkeys(c for cut in cuts for c in cut))
    sets = [[F.col(c) for c in cut] for cut in cuts]
    sums = [F.sum(numerator).alias("numerator"), F.sum(denominator).alias("denominator"), F.grouping_id().alias("cut")]
    out = df.groupingSets(sets, *[F.col(c) for c in columns]).agg(*sums)
    return out.withColumn("ratio", ratio(F.col("numerator"), F.col("denominator")))


def clustered_ratio(df: DataFrame, unit: list[str], numerator: str, denominator: str) -> DataFrame:
    """Ratio of sums with the delta-method error clustered by unit: ``units, ratio, se``.

    One pass over unit sums: the variance of the residual numerator - R * denominator from variances and covariance.
    Unit sums without a known value count as 0. Fewer than two units, or no positive mean denominator, give a NULL error.
    """
    zero = F.lit(0.0)
    u = df.groupBy(*unit).agg(F.coalesce(F.sum(numerator), zero).alias("y"), F.coalesce(F.sum(denominator), zero).alias("x"))
    s = u.agg(F.count(F.lit(1)).alias("units"), F.sum("y").alias("sy"), F.sum("x").alias("sx"), F.var_samp("y").alias("vy"), F.var_samp("x").alias("vx"), F.covar_samp("y", "x").alias("cyx"))
    r = ratio(F.col("sy"), F.col("sx"))
    mean_x = F.col("sx") / F.col("units")
    var = (F.col("vy") - 2 * F.col("ratio") * F.col("cyx") + F.col("ratio") * F.col("ratio") * F.col("vx")) / (F.col("units") * mean_x * mean_x)
    return s.withColumn("ratio", r).select("units", "ratio", F.when((F.col("units") > 1) & (mean_x > 0), F.sqrt(F.greatest(var, F.lit(0.0)))).alias("se"))


def intra_class(df: DataFrame, group: list[str], value: str, least: int = 3) -> DataFrame:
    """Share of the variance that lies between groups of at least ``least`` rows, clipped to 0..0.95: ``rho, groups, rows``.

    Means and variances come from per-group counts, sums and sums of squares about the overall mean.
    """
    g = df.groupBy(*group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")).filter(F.col("n") >= least)
    total = g.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("groups"), F.var_samp("m").alias("between"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"), F.sum(F.col("n") * (F.col("v") + F.col("m") * F.col("m"))).alias("squares"))
    within = (F.col("squares") - F.col("rows") * F.col("mean") * F.col("mean")) / (F.col("rows") - 1)
    rho = F.when(within > 0, F.least(F.greatest(F.col("between") / within, F.lit(0.0)), F.lit(0.95))).otherwise(F.lit(0.0))
    return total.select(rho.alias("rho"), "groups", "rows")


def design_effect(rho: Column, size: Column) -> Column:
    return F.greatest(F.lit(1.0), 1 + (size - 1) * rho)


def robust_spread(df: DataFrame, value: str, factor: float = 3.0) -> DataFrame:
    """Median, 1.4826 times the median absolute deviation, standard deviation and number of values beyond ``factor`` robust sigmas."""
    middle = df.agg(F.median(value).alias("median"))  # one row
    d = df.crossJoin(F.broadcast(middle)).withColumn("_d", F.abs(F.col(value) - F.col("median")))
    spread = d.agg(F.max("median").alias("median"), (F.lit(1.4826) * F.median("_d")).alias("robust_sigma"), F.stddev_samp(value).alias("sigma"))
    far = df.crossJoin(F.broadcast(spread)).agg(F.count(F.when(F.abs(F.col(value) - F.col("median")) > factor * F.col("robust_sigma"), 1)).alias("outliers"))
    return spread.crossJoin(far)


def right_closed_bin(c: Column, edges: list[float]) -> Column:
    """Number of the bin ``(edge, next edge]`` that holds a value, from 0; NULL outside."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        out = F.when((c > edges[i]) & (c <= edges[i + 1]), F.lit(i)).otherwise(out)
    return out


def top_with_other(df: DataFrame, key: str, sums: list[str], by: str, top: int) -> DataFrame:
    """The ``top`` keys by ``by`` (ties by key), all others put together as ``other``."""
    ranked = df.orderBy(F.col(by).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(top).select(F.col(key).alias("_k"), F.lit(True).alias("_top"))
    joined = df.join(F.broadcast(ranked), df[key].eqNullSafe(ranked["_k"]), "left")  # at most ``top`` rows
    return joined.groupBy(F.when(F.col("_top"), F.col(key)).otherwise(F.lit("other")).alias(key)).agg(*[F.sum(s).alias(s) for s in sums])


def smoothed(df: DataFrame, order: str, value: str, days: int, part: list[str] | None = None) -> DataFrame:
    """Trailing mean over exactly ``days`` rows (NULL before) and the mean one such span earlier."""
    w = W.partitionBy(*(part or [F.lit(1)])).orderBy(order)
    frame = w.rowsBetween(1 - days, 0)
    mean = F.when(F.count(value).over(frame) == days, F.avg(value).over(frame))
    return df.withColumn("smooth", mean).withColumn("smooth_before", F.lag("smooth", days).over(w))


def trailing_streak(df: DataFrame, part: list[str], order: str, over: Column) -> DataFrame:
    """Number of latest rows in a row for which ``over`` holds, per part. An aggregate: the rows after the last that doesn't hold."""
    d = df.withColumn("_over", F.coalesce(over, F.lit(False)))
    last_calm = F.max(F.when(~F.col("_over"), F.col(order)))
    calm = d.groupBy(*part).agg(last_calm.alias("_calm"))
    return d.join(calm, part).groupBy(*part).agg(F.count(F.when(F.col("_calm").isNull() | (F.col(order) > F.col("_calm")), 1)).alias("streak"))


def arm(unit: list[Column], allocation: float) -> Column:
    """Deterministic assignment: the first four bytes of an MD5 as a share of their range, below ``allocation`` or not."""
    digest = F.md5(F.concat_ws("|", *unit))
    return F.when(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / 4294967296.0 < allocation, "treatment").otherwise("control")


def hash_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """``rows`` distinct keys drawn by hash: the same keys however the table is partitioned."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed))), key).limit(rows)
