"""Event-log operators: validation with reasons, quarantine, matching, consumed identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dusklark.functions.text import identifier, instant, stripped

# Fields that an outcome must carry.
OUTCOME_REQUIRED = ["outcome_id", "decision_id", "units_sold", "starting_inventory", "ending_inventory", "applied_price", "is_stockout", "execution_status", "finalized_at"]


def problems(tests: dict[str, Column]) -> Column:
    """The names of the tests that a row fails, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in tests.items()]))


def outcome_problems() -> Column:
    """What is wrong with an outcome: missing fields, negative counts, stock that doesn't reconcile without a reason, price, time."""
    c = F.col
    missing = {f"{f} missing": c(f).isNull() for f in OUTCOME_REQUIRED}
    negative = {f"{f} negative": c(f) < 0 for f in ("units_sold", "starting_inventory", "ending_inventory")}
    reason = F.coalesce(stripped(c("adjustment_reason")), F.lit("")) != ""
    off = (c("ending_inventory") != c("starting_inventory") - c("units_sold")) & ~reason
    counted = (c("units_sold") >= 0) & (c("starting_inventory") >= 0) & (c("ending_inventory") >= 0)
    price = F.isnan("applied_price") | (F.abs("applied_price") == float("inf"))
    late = c("finalized_at").isNotNull() & instant(c("finalized_at")).isNull()
    return problems(missing | negative | {"stock does not reconcile": off & counted, "applied_price not finite": price, "finalized_at unreadable": late})


def split(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their ``problems``; together they are all rows."""
    marked = df.withColumn("problems", bad)
    return marked.filter(F.size("problems") == 0).drop("problems"), marked.filter(F.size("problems") > 0)


def with_key(df: DataFrame, column: str, name: str = "key") -> DataFrame:
    return df.withColumn(name, identifier(F.col(column)))


def unconsumed(df: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the consumed ones; rows without a key stay."""
    return df.join(consumed.select(key).distinct(), key, "left_anti")
