"""Grouping activity into sessions by merging intervals.

Every event opens the interval from its moment to ``gap`` later; intervals of one key that overlap or touch, and whose
counters satisfy an optional rule where they meet, merge into one session (:mod:`dusklark.operators.intervals`). The
merge runs twice so that no task has to hold a hot key: inside (key, time bucket), and then along the key over the
first and last interval of each bucket only. Intervals in the middle of a bucket are complete and travel alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dusklark.functions.text import code
from dusklark.operators.intervals import Rule, countdown, merge_sorted

_FIELDS = "_b0 long, _b1 long, _start long, _until long, _first double, _last double, _n long"


def latest_copy(df: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per ``keys``: the largest by ``order`` (NULL smallest). Reduced before the shuffle, so copies of one row may be many."""
    best = F.max(F.struct(*order, *keep)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in [*order, *keep]])


def merge_sessions(df: DataFrame, keys: list[str], at: str, gap: int, bucket: int, carry: str | None = None, rule: Rule | None = None) -> DataFrame:
    """Sessions of each key: ``keys, start, end, duration, events``.

    at: an integer moment (seconds, hours, ...); ``gap`` and ``bucket`` are in its unit. ``end`` is the last event's
    moment, so ``duration`` is 0 for a single event. Rows with a NULL key or moment belong to no session and are left
    out; equal moments are all counted. ``carry`` names a counter that ``rule(previous, current)`` compares where
    intervals meet (NULL is NaN there). With a rule, moments must be unique in a key, or neighbours among equal moments
    are arbitrary. Keys are of plain types. An empty table gives an empty table; other columns are ignored.
    """
    counter = F.col(carry).cast("double") if carry else F.lit(None).cast("double")
    moment, near = F.col(at).cast("long"), F.floor(F.col(at) / bucket)
    fields = [near.alias("_b0"), near.alias("_b1"), moment.alias("_start"), (moment + F.lit(gap)).alias("_until"), counter.alias("_first"), counter.alias("_last"), F.lit(1).cast("long").alias("_n")]
    opened = df.dropna(subset=[*keys, at]).select(*keys, *fields)
    plain = T.StructType([*opened.select(*keys).schema, *T._parse_datatype_string(_FIELDS), T.StructField("_edge", T.BooleanType())])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_sorted(batches, [*keys, "_b0"], rule, across=False)

    pieces = opened.repartition(*keys, "_b0").sortWithinPartitions(*keys, "_b0", "_start").mapInArrow(inside, plain)
    # the edges of a key's buckets meet in one lane, any other interval has a lane of its own
    lanes = pieces.withColumn("_lane", F.when(~F.col("_edge"), F.col("_start"))).drop("_edge")

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_sorted(batches, [*keys, "_lane"], rule, across=True)

    wide = T.StructType([*plain.fields[:-1], T.StructField("_lane", T.LongType()), plain.fields[-1]])
    merged = lanes.repartition(*keys, "_lane").sortWithinPartitions(*keys, "_lane", "_start").mapInArrow(along, wide)
    end = F.col("_until") - gap
    return merged.select(*keys, F.col("_start").alias("start"), end.alias("end"), (end - F.col("_start")).alias("duration"), F.col("_n").alias("events"))


def hourly(raw: DataFrame) -> DataFrame:
    """Raw hourly rows as ``sku_id, fc, at_hour`` (hours since 1970), ``loaded_at, row_id, counter``, those without a place left out."""
    at = F.unix_date("date").cast("long") * 24 + F.col("hour_of_day")
    rows = raw.select("sku_id", code(F.col("fc")).alias("fc"), at.alias("at_hour"), "loaded_at", "row_id", F.col("hours_remaining").cast("double").alias("counter"))
    return rows.dropna(subset=["sku_id", "fc", "at_hour"])


def selling_episodes(raw: DataFrame, bucket_hours: int = 24 * 28) -> DataFrame:
    """Selling episodes of hourly rows: ``sku_id, fc, start, end`` (hours since 1970), ``duration, events``.

    raw: ``row_id, date, hour_of_day, sku_id, fc, hours_remaining, loaded_at``. Hours of 24 and more run on past
    midnight. Rows without sku, fc, date or hour don't count; of several rows for one hour the one loaded last does
    (then the largest ``row_id``).
    """
    one = latest_copy(hourly(raw), ["sku_id", "fc", "at_hour"], ["loaded_at", "row_id"], ["counter"])
    return merge_sessions(one, ["sku_id", "fc"], "at_hour", gap=1, bucket=bucket_hours, carry="counter", rule=countdown)


def hour_text(hours: Column) -> Column:
    """Hours since 1970 as ``yyyy-MM-ddTHH``."""
    day = F.date_from_unix_date(F.floor(hours / 24).cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.lpad(F.pmod(hours, F.lit(24)).cast("string"), 2, "0"))
