"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.001) -> list:
    """Keys with more than ``share`` of all rows: at most ``1 / share`` of them, whatever the size of the input."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_t")).first()["_t"]
    return counts.filter(F.col("_n") > max(1.0, total * share)).select(*keys).collect()


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], share: float = 0.001) -> DataFrame:
    """Left join to a table with one row per key, without sending a hot key's rows to one task.

    The rows of hot keys (at most ``1 / share`` keys, a bound that doesn't grow with the data) are joined to their
    few right rows by broadcast; all other rows by the planner's choice. Rows with a NULL key are kept unmatched.
    """
    hot = hot_keys(left.dropna(subset=keys), keys, share)
    if not hot:
        return left.join(right, keys, "left")
    spark = left.sparkSession
    few = spark.createDataFrame([tuple(r) for r in hot], left.select(*keys).schema).withColumn("_hot", F.lit(True))
    tagged = left.join(F.broadcast(few), keys, "left")
    warm = right.join(F.broadcast(few), keys, "left_semi")
    a = tagged.filter("_hot").drop("_hot").join(F.broadcast(warm), keys, "left")
    b = tagged.filter("_hot IS NULL").drop("_hot").join(right.join(F.broadcast(few), keys, "left_anti"), keys, "left")
    return a.unionByName(b)


def null_safe(keys: list[str], left: DataFrame, right: DataFrame):
    """A join condition in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
