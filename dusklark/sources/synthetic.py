"""Hourly rows made up on the cluster, for tests of scale: every value is a function of its row number and the seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _unit(seed: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_003)) / 1_000_003.0


def hourly_rows(spark: SparkSession, skus: int, days: int, seed: int = 3, dirty: float = 0.004) -> DataFrame:
    """One selling window a day for each article, with countdown, stock chain and a share of dirty rows of each kind.

    Columns as in the raw table. Nothing is drawn in sequence, so the rows are the same for any partitioning.
    """
    c = F.col
    w = spark.range(skus * days).select((c("id") % skus + 15_000_000).alias("sku_id"), F.floor(c("id") / skus).alias("d"))
    w = w.select("sku_id", "d", (10 + F.floor(_unit(seed, c("sku_id"), c("d")) * 4)).alias("start"), (4 + F.floor(_unit(seed + 1, c("sku_id"), c("d")) * 5)).alias("n"), (1 + F.floor(_unit(seed + 2, c("sku_id"), c("d")) * 30)).alias("stock"))
    h = w.select("*", F.explode(F.sequence(F.lit(0), (c("n") - 1).cast("int"))).alias("k"))
    sold_before = F.least(c("stock"), F.floor(c("k") * c("stock") / 10.0))
    sold_after = F.least(c("stock"), F.floor((c("k") + 1) * c("stock") / 10.0))
    price = 1000 + 10 * F.pmod(F.xxhash64("sku_id"), F.lit(900))
    u = _unit(seed + 5, c("sku_id"), c("d"), c("k"))
    rate = F.least(F.lit(60.0), 15 + 2.5 * c("k"))
    last = c("k") == c("n") - 1
    return h.select(
        F.date_add(F.lit("2026-03-01").cast("date"), c("d").cast("int")).alias("date"), (c("start") + c("k")).alias("hour_of_day"), "sku_id",
        F.concat(F.lit("ZZ"), (F.pmod(F.xxhash64("sku_id"), F.lit(5)) + 1).cast("string")).alias("fc"), (c("stock") - sold_before).cast("double").alias("inventory"),
        F.when(u < dirty, 140.0).otherwise(rate).alias("discount"), F.when((u >= dirty) & (u < 2 * dirty), F.lit(-1)).otherwise(sold_after - sold_before).cast("long").alias("units_sold"),
        F.when((u >= 2 * dirty) & (u < 3 * dirty), 0.0).otherwise(price.cast("double")).alias("normal_asp"), F.when(sold_after > sold_before, price * (1 - rate / 100)).otherwise(0.0).alias("final_price"),
        (price * 0.6).alias("cogs_wo_vat"), F.when(last, 0.0).otherwise((c("stock") - sold_after).cast("double")).alias("ending_inventory"),
        F.when((u >= 3 * dirty) & (u < 4 * dirty), -1.0).otherwise((c("n") - 1 - c("k")).cast("double")).alias("hours_remaining"),
        F.when((u >= 4 * dirty) & (u < 5 * dirty), F.lit(None).cast("string")).otherwise(F.element_at(F.array(*[F.lit(x) for x in ("DAIRY", "FISH", "BAKERY", "TOFU")]), (F.pmod(F.xxhash64("sku_id"), F.lit(4)) + 1).cast("int"))).alias("category"),
        F.lit("MIXED").alias("subcategory"),
    )
