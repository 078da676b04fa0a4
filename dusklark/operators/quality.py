"""The audited filter chain over hourly rows.

Episodes are cut where the clock or the countdown breaks; rows or whole episodes leave at named stages; the waterfall
tells what each stage left. All episode-scoped tests between two row-scoped stages are evaluated in one pass over one
partitioning by site and article, instead of one semi-join per stage: every row learns the number of the stage at which
it leaves, and the waterfall is summed from those numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.config import Config
from dusklark.functions.numbers import finite, holds
from dusklark.functions.text import code, label
from dusklark.operators.episodes import inventory_break, leftover
from dusklark.session import written

# The stages in order.
STAGES = [
    "raw",
    "duplicate_hour_rows_dropped",
    "exclusion_window_removed",
    "discount_out_of_range_dropped",
    "negative_quantities_dropped",
    "null_category_dropped",
    "zero_base_price_dropped",
    "negative_window_recovered",
    "negative_window_dropped",
    "window_too_long_dropped",
    "below_cost_dropped",
    "non_priceable_dropped",
    "units_gt_inventory_dropped",
    "chain_break_dropped",
    "contiguous_episodes_built",
    "restocked_episodes_dropped",
    "edge_truncated_episodes_dropped",
]
KEEP = 99
UNIT = ["sku_id", "fc"]


def loaded(raw: DataFrame) -> DataFrame:
    """Renamed and typed rows: discount as a fraction, stocks rounded half to even, site and labels normalised.

    Hours of 24 and more become hours of the following days. NaN and infinite numbers become NULL.
    """
    at = F.unix_date("date").cast("long") * 24 + F.col("hour_of_day")
    return raw.select(
        "sku_id",
        code(F.col("fc")).alias("fc"),
        at.alias("at_hour"),
        F.bround(finite(F.col("inventory"))).cast("long").alias("starting_inventory"),
        (finite(F.col("discount")) / 100.0).alias("total_discount"),
        "units_sold",
        finite(F.col("normal_asp")).alias("original_price"),
        finite(F.col("final_price")).alias("applied_price"),
        finite(F.col("cogs_wo_vat")).alias("cost"),
        F.bround(finite(F.col("ending_inventory"))).cast("long").alias("ending_inventory"),
        finite(F.col("hours_remaining")).alias("hours_remaining"),
        label(F.col("category")).alias("category"),
        label(F.col("subcategory")).alias("subcategory"),
    )


def unique_hours(rows: DataFrame) -> DataFrame:
    """Hours that occur once. Of an hour with several rows none is kept, and rows without a place in time or a key are left out.

    An aggregate, so that many copies of one hour are one row before they are sent anywhere.
    """
    keys = [*UNIT, "at_hour"]
    rest = [c for c in rows.columns if c not in keys]
    one = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_r"))
    return one.filter("_n = 1").select(*keys, "_r.*")


def episode_start(counter: str, unit: list[str] = UNIT) -> Column:
    """The hour at which a row's episode starts: a row goes on only one hour later with a countdown one lower."""
    w = W.partitionBy(*unit).orderBy("at_hour")
    goes_on = holds((F.col("at_hour") - F.lag("at_hour").over(w) == 1) & (F.col(counter) - F.lag(counter).over(w) == -1))
    return F.when(~goes_on, F.col("at_hour"))


def _with_start(df: DataFrame, counter: str, name: str) -> DataFrame:
    w = W.partitionBy(*UNIT).orderBy("at_hour").rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("_open", episode_start(counter)).withColumn(name, F.last("_open", ignorenulls=True).over(w)).drop("_open")


def _first_failure(tests: list[tuple[int, Column]], part: list[str]) -> Column:
    """The number of the first episode-scoped test that any row of the episode fails, else ``KEEP``."""
    w = W.partitionBy(*part)
    return reduce(lambda acc, t: F.least(acc, F.when(F.max(holds(t[1])).over(w), F.lit(t[0])).otherwise(KEEP)), tests, F.lit(KEEP))


def staged(raw: DataFrame, cfg: Config) -> DataFrame:
    """Unique hours with ``episode`` and ``new_episode`` (starting hours), ``leaves`` (number of the stage), filled price and recovered countdown.

    ``leaves`` is ``KEEP`` for rows that pass all stages.
    """
    c = F.col
    d = _with_start(unique_hours(loaded(raw)), "hours_remaining", "episode")
    day = F.date_from_unix_date(F.floor(c("at_hour") / 24).cast("int"))
    ep = [*UNIT, "episode"]
    d = d.withColumn(
        "leaves",
        _first_failure(
            [
                (2, day.between(F.lit(cfg.exclusion_start).cast("date"), F.lit(cfg.exclusion_end).cast("date"))),
                (3, ~holds(c("total_discount").between(0, 1))),
                (4, holds(c("starting_inventory") < 0) | holds(c("units_sold") < 0) | holds(c("cost") <= 0)),
            ],
            ep,
        ),
    )
    d = d.withColumn("leaves", F.when((c("leaves") == KEEP) & (c("category").isNull() | c("subcategory").isNull()), 5).otherwise(c("leaves")))

    # prices are filled among the rows that are still there
    d = d.withColumn("_alive", c("leaves") == KEEP)
    here = W.partitionBy(*ep, "_alive").orderBy("at_hour")
    known = F.when(c("original_price") != 0, c("original_price"))
    price = F.coalesce(F.last(known, ignorenulls=True).over(here.rowsBetween(W.unboundedPreceding, 0)), F.first(known, ignorenulls=True).over(here.rowsBetween(0, W.unboundedFollowing)))
    d = d.withColumn("original_price", F.when(c("_alive"), price).otherwise(c("original_price")))
    d = d.withColumn("leaves", F.when(c("_alive") & ~holds(c("original_price") > 0), 6).otherwise(c("leaves")))

    d = d.withColumn("_alive", c("leaves") == KEEP)
    whole = W.partitionBy(*ep, "_alive")
    entry = F.first("hours_remaining", ignorenulls=True).over(whole.orderBy("at_hour").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    length = F.count(F.lit(1)).over(whole)
    recovered = holds((entry < 0) & (length <= cfg.recovery_hours)) & c("_alive")
    place = F.row_number().over(whole.orderBy("at_hour")) - 1
    d = d.withColumn("hours_remaining", F.when(recovered, F.lit(cfg.recovery_hours - 1.0) - place).otherwise(c("hours_remaining")))
    offered = c("original_price") * (1 - c("total_discount"))
    reconciles = c("starting_inventory") - c("units_sold") == c("ending_inventory")
    explained = inventory_break(c("starting_inventory"), c("units_sold"), c("ending_inventory")).isNotNull()
    tests = [
        (8, c("hours_remaining") < 0),
        (9, c("hours_remaining") > cfg.max_window_hours),
        (10, offered < c("cost") - 1e-9),
        (11, c("cost") >= c("original_price")),
        (12, c("units_sold") > c("starting_inventory")),
        (13, ~(holds(reconciles) | explained)),
    ]
    d = d.withColumn("leaves", F.when(c("_alive"), _first_failure(tests, [*ep, "_alive"])).otherwise(c("leaves")))

    # what is left is cut into episodes anew
    d = d.withColumn("_alive", c("leaves") == KEEP)
    w = W.partitionBy(*UNIT, "_alive").orderBy("at_hour")
    d = d.withColumn("_open", F.when(c("_alive"), episode_start("hours_remaining", [*UNIT, "_alive"])))
    d = d.withColumn("new_episode", F.when(c("_alive"), F.last("_open", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))).drop("_open")
    new = W.partitionBy(*UNIT, "_alive", "new_episode")
    rise = F.lead("starting_inventory").over(new.orderBy("at_hour")) > leftover(c("starting_inventory"), c("units_sold"))
    d = d.withColumn("_rise", holds(rise)).withColumn("_rises", F.max("_rise").over(new))
    d = d.withColumn("leaves", F.when(c("_alive") & c("_rises"), 15).otherwise(c("leaves"))).drop("_rise", "_rises")
    final = F.max(F.struct("at_hour", "starting_inventory", "units_sold", "ending_inventory", "hours_remaining")).over(new)
    d = d.withColumn("_z", final).drop("_alive")
    # read for the end of the extract, for the last stage and, by the waterfall, twice more; all that needs the partitioning is done
    d = written(d, "staged").withColumn("_left", leftover(F.col("_z.starting_inventory"), F.col("_z.units_sold")))
    if not cfg.drop_edge_truncated:
        return d.drop("_z", "_left")

    kept = c("leaves") == KEEP
    zeroed = c("_z.ending_inventory") == 0
    facts = d.filter(kept).agg(F.max("at_hour").alias("_end"), F.coalesce(F.max(holds(zeroed & (c("_left") > 0))), F.lit(False)).alias("_writes_off"))
    unknown = holds(c("_left") > 0) & c("_writes_off") & ~holds(zeroed)
    cut = (c("_z.at_hour") + F.greatest(F.coalesce(c("_z.hours_remaining"), F.lit(0.0)), F.lit(0.0)) > c("_end")) | (c("_z.at_hour") >= c("_end"))
    d = d.crossJoin(F.broadcast(facts))  # one row
    d = d.withColumn("leaves", F.when(kept & unknown & holds(cut), 16).otherwise(c("leaves")))
    return d.drop("_z", "_left", "_end", "_writes_off")


def waterfall(raw: DataFrame, cfg: Config) -> DataFrame:
    """Rows, episodes and opening exposure left after each stage: ``stage_no, stage, rows, episodes, exposure``.

    Exposure is cost times stock of each episode's first row that is still there. The first stage counts all raw rows,
    its episodes and exposure those of the unique hours. Stage 14 counts the newly cut episodes.
    """
    d = staged(raw, cfg).withColumn("_money", F.col("cost") * F.col("starting_inventory"))
    c = F.col

    def opening(least: int) -> Column:
        return F.min(F.when(c("leaves") > least, F.struct("at_hour", "_money")))["_money"]

    old = d.groupBy(*UNIT, "episode").agg(
        F.max("leaves").alias("until"), opening(0).alias("m0"), opening(5).alias("m5"), opening(6).alias("m6"),
        *[F.count(F.when(c("leaves") > k, 1)).alias(f"r{k}") for k in range(2, 14)], F.count(F.lit(1)).alias("r1"),
    )
    new = d.filter("new_episode IS NOT NULL").groupBy(*UNIT, "new_episode").agg(F.max("leaves").alias("until"), opening(13).alias("m"), F.count(F.lit(1)).alias("r"))
    last = 16 if cfg.drop_edge_truncated else 15
    sums = [x for k in range(1, 14) for x in (
        F.sum(f"r{k}").alias(f"r{k}"), F.count(F.when(c("until") > k, 1)).alias(f"e{k}"),
        F.sum(F.when(c("until") > k, c("m6" if k >= 6 else "m5" if k == 5 else "m0"))).alias(f"x{k}"),
    )]
    more = [x for k in range(14, last + 1) for x in (
        F.sum(F.when(c("until") > k, c("r"))).alias(f"r{k}"), F.count(F.when(c("until") > k, 1)).alias(f"e{k}"), F.sum(F.when(c("until") > k, c("m"))).alias(f"x{k}"),
    )]
    one = old.agg(*sums).crossJoin(new.agg(*more)).crossJoin(raw.agg(F.count(F.lit(1)).alias("r0")))  # one row each

    def cell(k: int) -> Column:
        j = max(k, 1)
        zero = F.lit(0).cast("long")
        return F.struct(F.lit(k).alias("stage_no"), F.lit(STAGES[k]).alias("stage"), F.coalesce(c(f"r{k}"), zero).alias("rows"), c(f"e{j}").alias("episodes"), F.coalesce(c(f"x{j}"), F.lit(0.0)).alias("exposure"))

    return one.select(F.explode(F.array(*[cell(k) for k in range(last + 1)])).alias("s")).select("s.*")


def cleaned(raw: DataFrame, cfg: Config) -> DataFrame:
    """Rows that pass every stage, with their episode's name and the derived columns."""
    c = F.col
    d = staged(raw, cfg).filter(c("leaves") == KEEP)
    from dusklark.operators.sessions import hour_text

    name = F.concat_ws("|", c("sku_id").cast("string"), c("fc"), hour_text(c("new_episode")))
    return d.select(
        name.alias("episode_id"), "sku_id", "fc", F.date_from_unix_date(F.floor(c("at_hour") / 24).cast("int")).alias("date"), F.pmod("at_hour", F.lit(24)).alias("hour_of_day"),
        "starting_inventory", "units_sold", "ending_inventory", "hours_remaining", "total_discount", "original_price", "applied_price", "cost", "category", "subcategory",
        reference_discount(c("category"), cfg).alias("d_ref"), (1 - c("cost") / c("original_price")).alias("d_max"), (c("original_price") * (1 - c("total_discount"))).alias("offered_price"),
    )


def reference_discount(category: Column, cfg: Config) -> Column:
    """The category's reference discount, or the default."""
    pairs = F.create_map(*[F.lit(x) for kv in cfg.reference.items() for x in kv]) if cfg.reference else None
    return F.lit(cfg.default_reference) if pairs is None else F.coalesce(pairs[category], F.lit(cfg.default_reference))


def stage_costs(w: DataFrame) -> DataFrame:
    """A waterfall with what each stage took: besides its columns ``share_left, rows_dropped, episodes_dropped, exposure_dropped, share_dropped``.

    Shares are of the exposure of the first stage, which itself takes nothing (NULL). Cutting episodes anew adds some, so
    what it takes is negative.
    """
    c = F.col
    order = W.orderBy("stage_no")  # one row per stage
    drop = [(F.lag(x, 1).over(order) - c(x)).alias(f"{x}_dropped") for x in ("rows", "episodes", "exposure")]
    out = w.select("*", *drop, F.first("exposure").over(order).alias("_raw"))
    share = lambda x: F.when(c("_raw") != 0, c(x) / c("_raw"))
    return out.withColumns({"share_left": share("exposure"), "share_dropped": share("exposure_dropped")}).drop("_raw")
