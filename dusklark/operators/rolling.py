"""Rolling totals over trailing periods, days without activity included.

Daily totals are range-joined to an entity's calendar. Both sides carry a coarse date bucket as wide as the longest
period, so a calendar day meets only the daily totals of its own and the preceding bucket: at most two periods' worth
of days, however many rows the entity has. The aggregate that follows is partitioned as the join is and needs no
shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_totals(rows: DataFrame, entity: list[str], date: str, value: str) -> DataFrame:
    """``entity, day`` (days since 1970), ``total, rows``; a NULL value counts as 0. Rows with a NULL entity or date are left out."""
    kept = rows.dropna(subset=[*entity, date])
    amount = F.coalesce(F.col(value), F.lit(0))
    return kept.groupBy(*entity, F.unix_date(date).alias("day")).agg(F.sum(amount).alias("total"), F.count(F.lit(1)).alias("rows"))


def calendar(daily: DataFrame, entity: list[str], bucket: int, to_end: bool = False) -> DataFrame:
    """Each entity's days from its first to its last, or to the last of all entities, with the bucket each lies in.

    The days are made bucket by bucket, so the longest array is one bucket.
    """
    span = daily.groupBy(*entity).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    if to_end:
        end = daily.agg(F.max("day").alias("last_day"))  # one row
        span = span.drop("last_day").crossJoin(F.broadcast(end))
    b = span.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first_day") / bucket), F.floor(F.col("last_day") / bucket))))
    inside = F.sequence(F.greatest("first_day", (F.col("bucket") * bucket).cast("int")), F.least("last_day", (F.col("bucket") * bucket + bucket - 1).cast("int")))
    return b.select(*entity, "bucket", "first_day", F.explode(inside).alias("day"))


def trailing_totals(rows: DataFrame, entity: list[str], date: str, value: str, periods: list[int], include_today: bool = True, days: DataFrame | None = None, to_end: bool = False) -> DataFrame:
    """Totals and averages over trailing periods: ``entity, date, first_day``, and per period ``total_<n>d, mean_<n>d``.

    A period of n days ends with the date itself, or with the day before it if ``include_today`` is false. Days
    without rows count as 0 and have a row of their own between the entity's first and last day; means divide by n.
    With ``to_end`` an entity's days run on to the table's last day, so totals that outlive its rows come out as well.
    ``days`` (``entity, day, bucket, first_day``) replaces that calendar. Entities are kept apart by all columns of
    ``entity``; other columns are ignored, and an empty table gives an empty table.
    """
    if not periods or min(periods) < 1:
        raise ValueError("periods are positive numbers of days")
    width, shift = max(periods), 0 if include_today else 1
    daily = daily_totals(rows, entity, date, value)
    dates = calendar(daily, entity, width, to_end) if days is None else days
    # a total counts for days in its own bucket and in the one after
    reach = daily.select(*[F.col(e).alias(f"_e{i}") for i, e in enumerate(entity)], F.col("day").alias("total_day"), "total", F.explode(F.sequence(F.floor(F.col("day") / width), F.floor((F.col("day") + width - 1 + shift) / width))).alias("_bucket"))
    age = F.col("day") - F.col("total_day")
    near = (F.col("bucket") == F.col("_bucket")) & age.between(shift, width + shift - 1)
    for i, e in enumerate(entity):
        near = near & (F.col(e) == F.col(f"_e{i}"))
    out = dates.join(reach, near, "left")
    sums = [F.coalesce(F.sum("total" if n == width else F.when(age < n + shift, F.col("total"))), F.lit(0)).alias(f"total_{n}d") for n in periods]
    out = out.groupBy(*entity, "bucket", "day", "first_day").agg(*sums)
    means = [(F.col(f"total_{n}d") / F.lit(float(n))).alias(f"mean_{n}d") for n in periods]
    totals = [F.col(f"total_{n}d") for n in periods]
    return out.select(*entity, F.date_from_unix_date("day").alias("date"), F.date_from_unix_date("first_day").alias("first_day"), *totals, *means)


def stale_rates(rows: DataFrame, entity: list[str], date: str, value: str, rate: str, period: int = 30, tolerance: float = 1e-6) -> DataFrame:
    """Entity days whose carried ``rate`` isn't the trailing mean: ``entity, date, rate_low, rate_high, expected``.

    Expected is the total of the ``period`` days before the date divided by ``period``; an entity's first day has none,
    and any non-NULL rate there is reported. NaN is a rate that never agrees.
    """
    carried = rows.dropna(subset=[*entity, date]).filter(F.col(rate).isNotNull()).groupBy(*entity, F.unix_date(date).alias("_day")).agg(F.min(rate).alias("rate_low"), F.max(rate).alias("rate_high"))
    right = trailing_totals(rows, entity, date, value, [period], include_today=False)
    expected = F.when(F.col("date") > F.col("first_day"), F.col(f"mean_{period}d"))
    right = right.select(*entity, F.unix_date("date").alias("_day"), expected.alias("expected"))
    both = carried.join(right, [*entity, "_day"], "left")
    wrong = F.col("expected").isNull() | (F.col("rate_high") - F.col("expected") > tolerance) | (F.col("expected") - F.col("rate_low") > tolerance)
    return both.filter(wrong).select(*entity, F.date_from_unix_date("_day").alias("date"), "rate_low", "rate_high", "expected")
