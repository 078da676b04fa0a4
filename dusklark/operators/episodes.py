"""Operators on selling episodes: order, endings, slices, extension.

An episode is a column (or several) that names a run of hourly rows; ``ORDER`` gives their order. All windows are
partitioned by the episode, whose length is bounded by its selling window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.functions.numbers import holds

ORDER = ["date", "hour_of_day"]
# How an episode may end, and why stock may not reconcile.
SOLD_OUT, COMPLETED, NOT_CLOSED = "sold_out", "completed", "not_closed"
RESTOCK, WRITE_OFF = "intraday_restock", "episode_close_write_off"


def leftover(start: Column, sold: Column) -> Column:
    """Units left on the shelf, never below 0; NULL where either is unknown."""
    return F.when(start.isNotNull() & sold.isNotNull(), F.greatest(start - sold, F.lit(0)))


def inventory_break(start: Column, sold: Column, end: Column) -> Column:
    """Why stock doesn't reconcile: more than was left, or zeroed with stock left; NULL for neither."""
    left = leftover(start, sold)
    return F.when(end > left, F.lit(RESTOCK)).when((end == 0) & (left > 0), F.lit(WRITE_OFF))


def edge_rows(df: DataFrame, episode: list[str], columns: list[str], last: bool = True) -> DataFrame:
    """One row per episode, its last (or first) by ``ORDER``: an aggregate, so nothing is sorted or ranked.

    Rows with a NULL episode are left out. Equal moments are decided by the columns' values.
    """
    pick = F.max if last else F.min
    rest = [c for c in columns if c not in ORDER]
    one = df.dropna(subset=episode).groupBy(*episode).agg(pick(F.struct(*ORDER, *rest)).alias("_e"))
    return one.select(*episode, *[F.col(f"_e.{c}").alias(c) for c in [*ORDER, *rest]])


def endings(df: DataFrame, episode: list[str], extra: list[str] | None = None) -> DataFrame:
    """How each episode ended: its last row with ``left_units, ending, scrap_units``.

    An ending stock of 0 with units left marks a write-off and so a closed episode. If no last row of the whole table
    has that mark, the feed doesn't write off and every episode counts as closed. Scrap of an episode that didn't
    close is NULL, not 0.
    """
    columns = ["starting_inventory", "units_sold", "ending_inventory", "hours_remaining", *(extra or [])]
    last = edge_rows(df, episode, columns).withColumn("left_units", leftover(F.col("starting_inventory"), F.col("units_sold")))
    mark = holds((F.col("ending_inventory") == 0) & (F.col("left_units") > 0))
    # one row, whatever the input
    convention = last.agg(F.coalesce(F.max(mark), F.lit(False)).alias("_writes_off"))
    closed = holds(F.col("ending_inventory") == 0) | ~F.col("_writes_off")
    kind = F.when(F.col("left_units") <= 0, SOLD_OUT).when(closed, COMPLETED).otherwise(NOT_CLOSED)
    scrap = F.when(F.col("ending") == COMPLETED, F.col("left_units")).when(F.col("ending") == SOLD_OUT, F.lit(0))
    return last.crossJoin(F.broadcast(convention)).withColumn("ending", kind).withColumn("scrap_units", scrap).drop("_writes_off")


def restocked(df: DataFrame, episode: list[str]) -> DataFrame:
    """Episodes in which an hour opens with more stock than the hour before left behind."""
    w = W.partitionBy(*episode).orderBy(*ORDER)
    rise = holds(F.lead("starting_inventory").over(w) > leftover(F.col("starting_inventory"), F.col("units_sold")))
    return df.dropna(subset=episode).select(*episode, rise.alias("_r")).filter("_r").select(*episode).distinct()


def opening_exposure(df: DataFrame, episode: list[str], by: list[str]) -> DataFrame:
    """Unit cost times stock of each episode's first row, summed."""
    first = edge_rows(df, episode, ["cost", "starting_inventory", *by], last=False)
    return first.groupBy(*by).agg(F.count(F.lit(1)).alias("episodes"), F.sum(F.col("cost") * F.col("starting_inventory")).alias("exposure"))


def opened_between(df: DataFrame, episode: list[str], start: str, end: str) -> DataFrame:
    """Whole episodes whose first date lies in the range."""
    opening = F.min("date").over(W.partitionBy(*episode))
    return df.withColumn("_open", opening).filter(F.col("_open").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).drop("_open")


def position(episode: list[str]) -> Column:
    """Position of a row in its episode, from 0."""
    return F.row_number().over(W.partitionBy(*episode).orderBy(*ORDER)) - 1


def filled(column: Column, episode: list[str], both_ways: bool = True) -> Column:
    """The last known value up to a row, and, if ``both_ways``, else the next known one."""
    w = W.partitionBy(*episode).orderBy(*ORDER)
    before = F.last(column, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    after = F.first(column, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return F.coalesce(before, after) if both_ways else before


def extended(df: DataFrame, episode: list[str], carry: list[str], max_tail: int) -> DataFrame:
    """Rows of each episode and, marked ``is_observed = false``, one for every hour its countdown still names.

    Added rows sell nothing, hold the last row's leftover and carry ``carry`` over. NULL, NaN and negative counters add
    none, nor does one above ``max_tail``, a wrong counter that would make rows without bound: such episodes are listed
    by ``overlong``.
    """
    need = [*ORDER, "hours_remaining", "starting_inventory", "units_sold"]
    last = edge_rows(df, episode, [*need, *carry])
    hours = F.when(~F.isnan("hours_remaining"), F.col("hours_remaining"))
    tail = last.withColumn("_n", F.when(hours <= max_tail, hours.cast("int"))).filter("_n >= 1").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    at = F.unix_date("date").cast("long") * 24 + F.col("hour_of_day") + F.col("_k")
    stock = leftover(F.col("starting_inventory"), F.col("units_sold"))
    made = tail.select(
        *episode,
        F.date_from_unix_date(F.floor(at / 24).cast("int")).alias("date"),
        F.pmod(at, F.lit(24)).cast("long").alias("hour_of_day"),
        (F.col("hours_remaining") - F.col("_k")).alias("hours_remaining"),
        stock.alias("starting_inventory"),
        stock.alias("ending_inventory"),
        F.lit(0).cast("long").alias("units_sold"),
        *carry,
        F.lit(False).alias("is_observed"),
    )
    return df.withColumn("is_observed", F.lit(True)).unionByName(made, allowMissingColumns=True)


def overlong(df: DataFrame, episode: list[str], max_tail: int) -> DataFrame:
    """Last rows of episodes whose countdown names more hours than ``max_tail``: set aside by ``extended``, to be looked at."""
    return edge_rows(df, episode, [*ORDER, "hours_remaining"]).filter((F.col("hours_remaining") > max_tail) & ~F.isnan("hours_remaining"))
