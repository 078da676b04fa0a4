"""Queries over the raw hourly rows: load, filter chain, waterfall, cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dusklark.config import Config
from dusklark.operators import quality
from dusklark.session import table

CFG = Config()


def proj_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed and typed rows, summed per site and category."""
    d = quality.loaded(table(spark, sf_dir, "flc_raw"))
    return d.groupBy("fc", "category").agg(F.count(F.lit(1)).alias("row_count"), F.sum("starting_inventory").alias("stock"), F.round(F.sum("total_discount"), 4).alias("discount_sum"), F.sum("ending_inventory").alias("ending_stock"))


def filt_unique_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that occur once, of repeated hours none."""
    return quality.unique_hours(quality.loaded(table(spark, sf_dir, "flc_raw"))).select("sku_id", "fc", "at_hour", "units_sold")


def epi_two_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes cut where the clock or the countdown breaks: start and length."""
    d = quality._with_start(quality.unique_hours(quality.loaded(table(spark, sf_dir, "flc_raw"))), "hours_remaining", "episode")
    return d.groupBy("sku_id", "fc", "episode").agg(F.count(F.lit(1)).alias("row_count"))


def rep_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, episodes and exposure after each stage of the filter chain; what each stage took is in ``rep_waterfall_costs``."""
    w = quality.waterfall(table(spark, sf_dir, "flc_raw"), CFG)
    return w.select("stage_no", "stage", "rows", "episodes", F.round("exposure", 2).alias("exposure"))


def rep_waterfall_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, episodes and exposure after each stage of the filter chain, with what each stage took and its share of the raw exposure."""
    w = quality.waterfall(table(spark, sf_dir, "flc_raw"), CFG).withColumn("exposure", F.round("exposure", 2))
    rounded = [F.round(c, n).alias(c) for c, n in (("share_left", 6), ("exposure_dropped", 2), ("share_dropped", 6))]
    return quality.stage_costs(w).select("stage_no", "stage", "rows", "episodes", "exposure", "rows_dropped", "episodes_dropped", *rounded)


def rep_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass the chain, with derived columns."""
    d = quality.cleaned(table(spark, sf_dir, "flc_raw"), CFG)
    rounded = [F.round(c, 6).alias(c) for c in ("d_ref", "d_max", "offered_price", "total_discount")]
    return d.select("episode_id", "date", "hour_of_day", "starting_inventory", "units_sold", "hours_remaining", "category", *rounded)


QUERIES = {f.__name__: f for f in (proj_loaded, filt_unique_hours, epi_two_signal, rep_waterfall, rep_waterfall_costs, rep_cleaned)}


def _finite(c: str) -> str:
    return f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"


def _label(c: str) -> str:
    return rf"nullif(upper(trim(regexp_replace({c}, '[\s_]+', ' ', 'g'))), '')"


LOADED = rf"""l AS (SELECT sku_id, nullif(upper(trim(fc, ' 	')), '') AS fc, date_diff('day', DATE '1970-01-01', date) * 24 + hour_of_day AS at_hour,
  CAST(round_even({_finite("inventory")}, 0) AS BIGINT) AS starting_inventory, ({_finite("discount")}) / 100.0 AS total_discount, units_sold,
  {_finite("normal_asp")} AS original_price, {_finite("cogs_wo_vat")} AS cost, CAST(round_even({_finite("ending_inventory")}, 0) AS BIGINT) AS ending_inventory,
  {_finite("hours_remaining")} AS hours_remaining, {_label("category")} AS category, {_label("subcategory")} AS subcategory FROM flc_raw),
u AS (SELECT * FROM l WHERE sku_id IS NOT NULL AND fc IS NOT NULL AND at_hour IS NOT NULL QUALIFY count(*) OVER (PARTITION BY sku_id, fc, at_hour) = 1)"""


def _cut(source: str, name: str, column: str) -> str:
    return f"""{name}_g AS (SELECT *, coalesce(at_hour - lag(at_hour) OVER w = 1 AND hours_remaining - lag(hours_remaining) OVER w = -1, false) AS goes_on
  FROM {source} WINDOW w AS (PARTITION BY sku_id, fc ORDER BY at_hour)),
{name} AS (SELECT * EXCLUDE (goes_on), last_value(CASE WHEN NOT goes_on THEN at_hour END IGNORE NULLS) OVER (PARTITION BY sku_id, fc ORDER BY at_hour ROWS UNBOUNDED PRECEDING) AS {column} FROM {name}_g)"""


def _scoped(source: str, name: str, bad: str, ep: str = "ep") -> str:
    return f"{name} AS (SELECT * FROM {source} QUALIFY NOT bool_or(coalesce({bad}, false)) OVER (PARTITION BY sku_id, fc, {ep}))"


_LEFT = "greatest(starting_inventory - units_sold, 0)"
CHAIN = ",\n".join(
    [
        LOADED,
        _cut("u", "s1", "ep"),
        _scoped("s1", "s2", f"DATE '1970-01-01' + CAST(floor(at_hour / 24) AS INT) BETWEEN DATE '{CFG.exclusion_start}' AND DATE '{CFG.exclusion_end}'"),
        _scoped("s2", "s3", "NOT coalesce(total_discount BETWEEN 0 AND 1, false)"),
        _scoped("s3", "s4", "coalesce(starting_inventory < 0, false) OR coalesce(units_sold < 0, false) OR coalesce(cost <= 0, false)"),
        "s5 AS (SELECT * FROM s4 WHERE category IS NOT NULL AND subcategory IS NOT NULL)",
        """s6 AS (SELECT * FROM (SELECT * EXCLUDE (original_price), coalesce(last_value(nullif(original_price, 0) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(nullif(original_price, 0) IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS original_price FROM s5 WINDOW w AS (PARTITION BY sku_id, fc, ep ORDER BY at_hour)) WHERE original_price > 0)""",
        f"""s7 AS (SELECT * EXCLUDE (hours_remaining, entry, size, place), CASE WHEN entry < 0 AND size <= {CFG.recovery_hours} THEN {CFG.recovery_hours - 1} - place ELSE hours_remaining END AS hours_remaining
  FROM (SELECT *, first_value(hours_remaining IGNORE NULLS) OVER (PARTITION BY sku_id, fc, ep ORDER BY at_hour ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS entry,
  count(*) OVER (PARTITION BY sku_id, fc, ep) AS size, row_number() OVER (PARTITION BY sku_id, fc, ep ORDER BY at_hour) - 1 AS place FROM s6))""",
        _scoped("s7", "s8", "hours_remaining < 0"),
        _scoped("s8", "s9", f"hours_remaining > {CFG.max_window_hours}"),
        _scoped("s9", "s10", "original_price * (1 - total_discount) < cost - 1e-9"),
        _scoped("s10", "s11", "cost >= original_price"),
        _scoped("s11", "s12", "units_sold > starting_inventory"),
        _scoped("s12", "s13", f"NOT (coalesce(starting_inventory - units_sold = ending_inventory, false) OR coalesce(ending_inventory > {_LEFT}, false) OR coalesce(ending_inventory = 0 AND {_LEFT} > 0, false))"),
        _cut("s13", "s14", "ne"),
        f"s15_f AS (SELECT *, lead(starting_inventory) OVER (PARTITION BY sku_id, fc, ne ORDER BY at_hour) > {_LEFT} AS rise FROM s14)",
        _scoped("s15_f", "s15", "rise", "ne"),
        f"z AS (SELECT sku_id, fc, ne, at_hour, hours_remaining, ending_inventory, {_LEFT} AS left_units FROM s15 QUALIFY row_number() OVER (PARTITION BY sku_id, fc, ne ORDER BY at_hour DESC) = 1)",
        "facts AS (SELECT max(at_hour) AS at_end, coalesce(bool_or(ending_inventory = 0 AND left_units > 0), false) AS writes_off FROM z)",
        """cut AS (SELECT sku_id, fc, ne FROM z, facts WHERE writes_off AND left_units > 0 AND NOT coalesce(ending_inventory = 0, false)
  AND (at_hour + greatest(coalesce(hours_remaining, 0), 0) > at_end OR at_hour >= at_end))""",
        "s16 AS (SELECT * FROM s15 ANTI JOIN cut USING (sku_id, fc, ne))",
    ]
)


def _measure(k: int) -> str:
    source, ep = f"s{max(k, 1)}", "ne" if k >= 14 else "ep"
    rows = "(SELECT count(*) FROM flc_raw)" if k == 0 else "coalesce(sum(n), 0)"
    return f"""SELECT {k} AS stage_no, '{quality.STAGES[k]}' AS stage, CAST({rows} AS BIGINT) AS rows, count(*) AS episodes, round(coalesce(sum(m), 0), 2) AS exposure
FROM (SELECT count(*) AS n, arg_min_null(cost * starting_inventory, at_hour) AS m FROM {source} GROUP BY sku_id, fc, {ep})"""


SQL = {
    "proj_loaded": f"WITH {LOADED} SELECT fc, category, count(*) AS row_count, CAST(sum(starting_inventory) AS BIGINT) AS stock, round(sum(total_discount), 4) AS discount_sum, CAST(sum(ending_inventory) AS BIGINT) AS ending_stock FROM l GROUP BY fc, category",
    "filt_unique_hours": f"WITH {LOADED} SELECT sku_id, fc, at_hour, units_sold FROM u",
    "epi_two_signal": f"WITH {LOADED}, {_cut('u', 's1', 'ep')} SELECT sku_id, fc, ep AS episode, count(*) AS row_count FROM s1 GROUP BY sku_id, fc, ep",
    "rep_waterfall": f"WITH {CHAIN}\n" + "\nUNION ALL ".join(_measure(k) for k in range(17)),
    "rep_waterfall_costs": f"WITH {CHAIN},\nw AS (" + "\nUNION ALL ".join(_measure(k) for k in range(17)) + """)
SELECT stage_no, stage, rows, episodes, exposure, lag(rows) OVER o - rows AS rows_dropped, lag(episodes) OVER o - episodes AS episodes_dropped,
  round(exposure / nullif(first_value(exposure) OVER o, 0), 6) AS share_left, round(lag(exposure) OVER o - exposure, 2) AS exposure_dropped,
  round((lag(exposure) OVER o - exposure) / nullif(first_value(exposure) OVER o, 0), 6) AS share_dropped
FROM w WINDOW o AS (ORDER BY stage_no)""",
    "rep_cleaned": f"""WITH {CHAIN} SELECT concat_ws('|', CAST(sku_id AS VARCHAR), fc, strftime(TIMESTAMP '1970-01-01' + to_hours(CAST(ne AS BIGINT)), '%Y-%m-%dT%H')) AS episode_id,
  DATE '1970-01-01' + CAST(floor(at_hour / 24) AS INT) AS date, at_hour % 24 AS hour_of_day, starting_inventory, units_sold, hours_remaining, category,
  round(CASE WHEN category IN ('RED MEAT', 'POULTRY', 'SIDE PLATE') THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.30 AS DOUBLE) END, 6) AS d_ref, round(1 - cost / original_price, 6) AS d_max,
  round(original_price * (1 - total_discount), 6) AS offered_price, round(total_discount, 6) AS total_discount FROM s16""",
}
