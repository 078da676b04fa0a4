"""Queries over the prepared hourly rows: projections, episodes, joins, aggregates, windows and the measurement suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.config import Config
from dusklark.functions.numbers import finite, holds, ratio
from dusklark.functions.text import label
from dusklark.operators import episodes as E
from dusklark.operators import measures as M
from dusklark.operators.quality import reference_discount
from dusklark.plans.quality import _finite, _label
from dusklark.session import table

CFG = Config()
EP = ["episode_id"]
c = F.col


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared rows with finite numbers, one spelling of each category, and no derived columns trusted."""
    t = table(spark, sf_dir, "prepared")
    d = t.select(
        "date", "hour_of_day", "sku_id", "fc", "starting_inventory", finite(c("total_discount")).alias("total_discount"), "units_sold",
        finite(c("original_price")).alias("original_price"), finite(c("cost")).alias("cost"), "ending_inventory", finite(c("hours_remaining")).alias("hours_remaining"),
        label(c("category")).alias("category"), label(c("subcategory")).alias("subcategory"), "episode_id",
    )
    return d.withColumn("d_ref", reference_discount(c("category"), CFG))


H = f"""h AS (SELECT date, hour_of_day, sku_id, fc, starting_inventory, {_finite("total_discount")} AS total_discount, units_sold, {_finite("original_price")} AS original_price,
  {_finite("cost")} AS cost, ending_inventory, {_finite("hours_remaining")} AS hours_remaining, {_label("category")} AS category, {_label("subcategory")} AS subcategory, episode_id,
  CASE WHEN {_label("category")} IN ('RED MEAT', 'POULTRY', 'SIDE PLATE') THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.30 AS DOUBLE) END AS d_ref FROM prepared)"""
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def r(x, n: int = 6):
    return F.round(x, n)


def count(predicate=None):
    return F.count(F.lit(1) if predicate is None else F.when(predicate, 1))


# -- projections and filters -------------------------------------------------------------------------------------------
@query(f"WITH {H} SELECT category, isodow(date) - 1 AS dow, day(date) AS day_of_month, count(*) AS row_count, round(min(d_ref), 6) AS d_ref FROM h GROUP BY 1, 2, 3")
def proj_calendar(spark, d):
    """Calendar features and the category's reference discount."""
    x = hours(spark, d).withColumn("dow", F.weekday("date").cast("long")).withColumn("day_of_month", F.dayofmonth("date").cast("long"))
    return x.groupBy("category", "dow", "day_of_month").agg(count().alias("row_count"), r(F.min("d_ref")).alias("d_ref"))


@query(f"WITH {H} SELECT category, count(*) FILTER (abs(total_discount - d_ref) <= 0.025 + 1e-9 AND starting_inventory >= 1) AS anchor_rows, count(*) FILTER (date BETWEEN DATE '2025-12-01' AND DATE '2025-12-31') AS december_rows FROM h GROUP BY 1")
def filt_anchor_band(spark, d):
    """Rows inside the tolerance band, and rows of a date range."""
    near = (F.abs(c("total_discount") - c("d_ref")) <= CFG.anchor_band + 1e-9) & (c("starting_inventory") >= 1)
    return hours(spark, d).groupBy("category").agg(count(near).alias("anchor_rows"), count(c("date").between("2025-12-01", "2025-12-31")).alias("december_rows"))


@query(f"WITH {H} SELECT category, count(*) AS row_count, count(DISTINCT episode_id) AS episodes FROM (SELECT * FROM h QUALIFY NOT bool_or(coalesce(cost <= 0, false) OR NOT coalesce(total_discount BETWEEN 0 AND 1, false)) OVER (PARTITION BY episode_id)) GROUP BY 1")
def filt_episode_scoped(spark, d):
    """Rows of episodes none of whose rows is bad."""
    bad = holds(c("cost") <= 0) | ~holds(c("total_discount").between(0, 1))
    x = hours(spark, d).withColumn("_bad", F.max(bad).over(W.partitionBy(*EP))).filter("NOT _bad")
    return x.groupBy("category").agg(count().alias("row_count"), F.count_distinct("episode_id").alias("episodes"))


_L = "greatest(starting_inventory - units_sold, 0)"
_LU = f"CASE WHEN starting_inventory IS NOT NULL AND units_sold IS NOT NULL THEN {_L} END"


@query(f"""WITH {H}, k AS (SELECT *, {_LU} AS lu FROM h) SELECT CASE WHEN ending_inventory > lu THEN 'intraday_restock' WHEN ending_inventory = 0 AND lu > 0 THEN 'episode_close_write_off' END AS reason,
  count(*) AS row_count, CAST(sum(lu) AS BIGINT) AS left_units FROM k GROUP BY 1""")
def proj_inventory_break(spark, d):
    """Why stock doesn't reconcile, with the units left over."""
    left = E.leftover(c("starting_inventory"), c("units_sold"))
    why = E.inventory_break(c("starting_inventory"), c("units_sold"), c("ending_inventory"))
    return hours(spark, d).groupBy(why.alias("reason")).agg(count().alias("row_count"), F.sum(left).alias("left_units"))


# -- episodes ----------------------------------------------------------------------------------------------------------
_LAST = "SELECT * FROM h WHERE episode_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY date DESC, hour_of_day DESC) = 1"
_FIRST = "SELECT * FROM h WHERE episode_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY date, hour_of_day) = 1"
_END = f"""last AS (SELECT *, {_LU} AS left_units FROM ({_LAST})), conv AS (SELECT coalesce(bool_or(ending_inventory = 0 AND left_units > 0), false) AS w FROM last),
ended AS (SELECT *, CASE WHEN left_units <= 0 THEN 'sold_out' WHEN coalesce(ending_inventory = 0, false) OR NOT w THEN 'completed' ELSE 'not_closed' END AS ending FROM last, conv),
endings AS (SELECT *, CASE ending WHEN 'completed' THEN left_units WHEN 'sold_out' THEN 0 END AS scrap_units FROM ended)"""


@query(f"WITH {H} SELECT episode_id, date, hour_of_day, starting_inventory, ending_inventory FROM ({_LAST})")
def epi_last_rows(spark, d):
    return E.edge_rows(hours(spark, d), EP, ["starting_inventory", "ending_inventory"])


@query(f"WITH {H} SELECT episode_id, date, hour_of_day, starting_inventory FROM ({_FIRST})")
def epi_first_rows(spark, d):
    return E.edge_rows(hours(spark, d), EP, ["starting_inventory"], last=False)


@query(f"WITH {H} SELECT fc, count(*) AS episodes, round(sum(cost * starting_inventory), 2) AS exposure FROM ({_FIRST}) GROUP BY 1")
def epi_opening_exposure(spark, d):
    return E.opening_exposure(hours(spark, d), EP, ["fc"]).withColumn("exposure", r("exposure", 2))


@query(f"WITH {H}, {_END} SELECT episode_id, ending, left_units, scrap_units FROM endings")
def epi_endings(spark, d):
    """How each episode ended; scrap is NULL where it didn't."""
    return E.endings(hours(spark, d), EP).select("episode_id", "ending", "left_units", "scrap_units")


@query(f"WITH {H}, n AS (SELECT episode_id, lead(starting_inventory) OVER (PARTITION BY episode_id ORDER BY date, hour_of_day) > {_LU} AS rise FROM h) SELECT DISTINCT episode_id FROM n WHERE rise AND episode_id IS NOT NULL")
def epi_restocked(spark, d):
    return E.restocked(hours(spark, d), EP)


@query(f"""WITH {H}, {_END}, t AS (SELECT *, date_diff('day', DATE '1970-01-01', date) * 24 + hour_of_day AS at_hour FROM endings)
SELECT episode_id FROM t WHERE ending = 'not_closed' AND (at_hour + greatest(coalesce(hours_remaining, 0), 0) > (SELECT max(at_hour) FROM t) OR at_hour >= (SELECT max(at_hour) FROM t))""")
def epi_edge_truncated(spark, d):
    """Unclosed episodes whose countdown reaches past the end of the extract."""
    e = E.endings(hours(spark, d), EP).withColumn("_at", F.unix_date("date").cast("long") * 24 + c("hour_of_day"))
    end = e.agg(F.max("_at").alias("_end"))  # one row
    over = (c("_at") + F.greatest(F.coalesce("hours_remaining", F.lit(0.0)), F.lit(0.0)) > c("_end")) | (c("_at") >= c("_end"))
    return e.crossJoin(F.broadcast(end)).filter((c("ending") == E.NOT_CLOSED) & over).select("episode_id")


@query(f"""WITH {H}, o AS (SELECT *, min(date) OVER (PARTITION BY episode_id) AS opened FROM h)
SELECT CASE WHEN opened BETWEEN DATE '{CFG.train_start}' AND DATE '{CFG.train_end}' THEN 'train' WHEN opened BETWEEN DATE '{CFG.calib_start}' AND DATE '{CFG.calib_end}' THEN 'calib' ELSE 'test' END AS split,
  count(*) AS row_count, count(DISTINCT episode_id) AS episodes FROM o WHERE opened BETWEEN DATE '{CFG.train_start}' AND DATE '{CFG.test_end}' GROUP BY 1""")
def epi_splits(spark, d):
    """Train, calibration and test parts, by the opening date of whole episodes."""
    parts = []
    for name in ("train", "calib", "test"):
        x = E.opened_between(hours(spark, d), EP, getattr(CFG, f"{name}_start"), getattr(CFG, f"{name}_end"))
        parts.append(x.agg(F.lit(name).alias("split"), count().alias("row_count"), F.count_distinct("episode_id").alias("episodes")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {H}, last AS ({_LAST}), made AS (SELECT episode_id, unnest(range(1, CAST(hours_remaining AS BIGINT) + 1)) AS k, hours_remaining, {_LU} AS stock FROM last WHERE hours_remaining >= 1)
SELECT episode_id, count(*) AS added, CAST(max(stock) AS BIGINT) AS stock, min(hours_remaining - k) AS lowest FROM made GROUP BY 1""")
def epi_extended(spark, d):
    """Hours that the countdown names but the data lacks."""
    x = E.extended(hours(spark, d), EP, ["category", "fc", "sku_id"], 24 * 60).filter("NOT is_observed")
    return x.groupBy("episode_id").agg(count().alias("added"), F.max("starting_inventory").alias("stock"), F.min("hours_remaining").alias("lowest"))


@query(f"WITH {H} SELECT episode_id, date, hour_of_day, row_number() OVER (PARTITION BY episode_id ORDER BY date, hour_of_day) - 1 AS place FROM h")
def epi_positions(spark, d):
    return hours(spark, d).select("episode_id", "date", "hour_of_day", E.position(EP).cast("long").alias("place"))


@query(f"""WITH {H} SELECT episode_id, date, hour_of_day, round(coalesce(last_value(nullif(original_price, 0) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(nullif(original_price, 0) IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS price FROM h WINDOW w AS (PARTITION BY episode_id ORDER BY date, hour_of_day)""")
def win_fill(spark, d):
    """Prices filled forwards, then backwards, inside each episode."""
    known = F.when(c("original_price") != 0, c("original_price"))
    return hours(spark, d).select("episode_id", "date", "hour_of_day", r(E.filled(known, EP)).alias("price"))


# -- joins and trailing windows ----------------------------------------------------------------------------------------
_ANCHOR = "abs(total_discount - d_ref) <= 0.025 + 1e-9 AND starting_inventory >= 1"
_DAY = f"day AS (SELECT sku_id, fc, date, CAST(coalesce(sum(units_sold) FILTER ({_ANCHOR}), 0) AS BIGINT) AS sold, count(*) FILTER ({_ANCHOR}) AS hrs FROM h GROUP BY 1, 2, 3)"


def _rate(keys: str) -> str:
    w = f"(PARTITION BY {keys} ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    return f"sum(sold) OVER {w} / nullif(sum(hrs) OVER {w}, 0)"


def _anchor_days(x: DataFrame) -> DataFrame:
    near = holds((F.abs(c("total_discount") - c("d_ref")) <= CFG.anchor_band + 1e-9) & (c("starting_inventory") >= 1))
    return x.groupBy("sku_id", "fc", "date").agg(F.coalesce(F.sum(F.when(near, c("units_sold"))), F.lit(0)).alias("sold"), count(near).alias("hrs"))


def _trailing(day: DataFrame, keys: list[str]):
    w = W.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(1 - CFG.rate_window_days, -1)
    hrs = F.sum("hrs").over(w)
    return F.when(hrs > 0, F.sum("sold").over(w) / hrs)


@query(f"""WITH {H}, {_DAY}, a AS (SELECT *, {_rate('sku_id, fc')} AS own FROM day), s AS (SELECT sku_id, date, sum(sold) AS sold, sum(hrs) AS hrs FROM day GROUP BY 1, 2), p AS (SELECT sku_id, date, {_rate('sku_id')} AS pooled FROM s)
SELECT a.sku_id, fc, a.date, round(own, 6) AS own, round(pooled, 6) AS pooled, round(coalesce(own, pooled), 6) AS rate FROM a JOIN p ON a.sku_id = p.sku_id AND a.date = p.date""")
def join_trailing_rate(spark, d):
    """Trailing rate per article and site, falling back to the article's rate over all sites (aggregated to days first)."""
    day = _anchor_days(hours(spark, d))
    own = day.withColumn("own", _trailing(day, ["sku_id", "fc"]))
    pooled = day.groupBy("sku_id", "date").agg(F.sum("sold").alias("sold"), F.sum("hrs").alias("hrs"))
    pooled = pooled.select("sku_id", "date", _trailing(pooled, ["sku_id"]).alias("pooled"))
    x = own.join(pooled, ["sku_id", "date"], "left")
    return x.select("sku_id", "fc", "date", r("own").alias("own"), r("pooled").alias("pooled"), r(F.coalesce("own", "pooled")).alias("rate"))


@query(f"""WITH {H}, {_DAY}, a AS (SELECT *, {_rate('sku_id, fc')} AS own FROM day), o AS (SELECT episode_id, min(sku_id) AS sku_id, min(fc) AS fc, min(date) AS date FROM h GROUP BY 1)
SELECT episode_id, o.date AS opened, round(own, 6) AS rate FROM o JOIN a ON o.sku_id = a.sku_id AND o.fc = a.fc AND o.date = a.date""")
def join_point_in_time(spark, d):
    """Each episode's rate as of its first date, so that none reads its own sales."""
    x = hours(spark, d)
    day = _anchor_days(x)
    rates = day.select("sku_id", "fc", "date", _trailing(day, ["sku_id", "fc"]).alias("rate"))
    opened = x.groupBy("episode_id").agg(F.min("sku_id").alias("sku_id"), F.min("fc").alias("fc"), F.min("date").alias("date"))
    return opened.join(rates, ["sku_id", "fc", "date"], "left").select("episode_id", c("date").alias("opened"), r("rate").alias("rate"))


@query(f"""WITH {H}, e AS (SELECT episode_id, min(sku_id) AS sku_id, min(fc) AS fc, min(date) AS start, sum(units_sold) FILTER ({_ANCHOR}) / nullif(count(*) FILTER ({_ANCHOR}), 0) AS rate FROM h GROUP BY 1)
SELECT episode_id, round(lag(rate) OVER (PARTITION BY sku_id, fc ORDER BY start, episode_id), 6) AS prior_rate FROM e""")
def join_prior_episode(spark, d):
    """The rate of the same article's preceding episode at the same site."""
    near = holds((F.abs(c("total_discount") - c("d_ref")) <= CFG.anchor_band + 1e-9) & (c("starting_inventory") >= 1))
    n = count(near)
    e = hours(spark, d).groupBy("episode_id").agg(F.min("sku_id").alias("sku_id"), F.min("fc").alias("fc"), F.min("date").alias("start"), F.when(n > 0, F.sum(F.when(near, c("units_sold"))) / n).alias("rate"))
    w = W.partitionBy("sku_id", "fc").orderBy("start", "episode_id")
    return e.select("episode_id", r(F.lag("rate").over(w)).alias("prior_rate"))


@query(f"""WITH {H}, s AS (SELECT category, subcategory, avg(units_sold) AS m FROM h WHERE category IS NOT NULL AND subcategory IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 200), k AS (SELECT category, avg(units_sold) AS m FROM h WHERE category IS NOT NULL GROUP BY 1 HAVING count(*) >= 500), g AS (SELECT avg(units_sold) AS m FROM h)
SELECT h.category, h.subcategory, round(max(coalesce(s.m, k.m, g.m)), 6) AS level, count(*) AS row_count FROM h LEFT JOIN s ON h.category = s.category AND h.subcategory = s.subcategory LEFT JOIN k ON h.category = k.category, g GROUP BY 1, 2""")
def join_hierarchy(spark, d):
    """A level for every row from its subcategory, else its category, else all rows, depending on how many rows each has."""
    x = hours(spark, d)
    sub = x.dropna(subset=["category", "subcategory"]).groupBy("category", "subcategory").agg(F.avg("units_sold").alias("ms"), count().alias("ns")).filter("ns >= 200").drop("ns")
    cat = x.dropna(subset=["category"]).groupBy("category").agg(F.avg("units_sold").alias("mc"), count().alias("nc")).filter("nc >= 500").drop("nc")
    all_ = x.agg(F.avg("units_sold").alias("mg"))  # one row
    y = x.groupBy("category", "subcategory").agg(count().alias("row_count"))
    y = y.join(sub, ["category", "subcategory"], "left").join(cat, "category", "left").crossJoin(F.broadcast(all_))
    return y.select("category", "subcategory", r(F.coalesce("ms", "mc", "mg")).alias("level"), "row_count")


@query(f"""WITH {H}, w AS (SELECT category, date_trunc('week', date) AS week, sum(units_sold) AS sold, sum(starting_inventory) AS stock FROM h WHERE category IS NOT NULL GROUP BY 1, 2), n AS (SELECT *, dense_rank() OVER (ORDER BY week) AS i FROM w)
SELECT category, CAST(week AS DATE) AS week, round(sum(sold) OVER v / nullif(sum(stock) OVER v, 0), 6) AS trailing_ratio FROM n WINDOW v AS (PARTITION BY category ORDER BY i RANGE BETWEEN 4 PRECEDING AND 1 PRECEDING)""")
def join_trailing_weeks(spark, d):
    """Each week with the four observed weeks before it, counted by their place among all weeks."""
    w = hours(spark, d).dropna(subset=["category"]).groupBy("category", F.date_trunc("week", "date").cast("date").alias("week")).agg(F.sum("units_sold").alias("sold"), F.sum("starting_inventory").alias("stock"))
    # weeks are few, however many rows there are; their places are joined instead of ranking all rows in one task
    places = w.select("week").distinct().withColumn("i", F.dense_rank().over(W.orderBy("week")))
    v = W.partitionBy("category").orderBy("i").rangeBetween(-4, -1)
    stock = F.sum("stock").over(v)
    return w.join(F.broadcast(places), "week").select("category", "week", r(F.when(stock != 0, F.sum("sold").over(v) / stock)).alias("trailing_ratio"))


@query("""WITH d AS (SELECT date, fc, sku_id, sum(units_sold) AS sold FROM prepared GROUP BY 1, 2, 3),
a AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(sku_id AS VARCHAR), fc)), 1, 8) AS BIGINT) / 4294967296.0 < 0.5 THEN 'treatment' ELSE 'control' END AS arm FROM d),
s AS (SELECT date, arm, avg(sold) AS m FROM a GROUP BY 1, 2)
SELECT t.date, round(t.m - c.m, 6) AS gap FROM s t JOIN s c ON t.date = c.date AND t.arm = 'treatment' AND c.arm = 'control'""")
def join_arm_days(spark, d):
    """Daily gap between the hashed arms, on dates that both have."""
    day = table(spark, d, "prepared").groupBy("date", "fc", "sku_id").agg(F.sum("units_sold").alias("sold"))
    arms = day.withColumn("arm", M.arm([c("sku_id").cast("string"), c("fc")], CFG.arm_allocation))
    s = arms.groupBy("date").agg(F.avg(F.when(c("arm") == "treatment", c("sold"))).alias("t"), F.avg(F.when(c("arm") == "control", c("sold"))).alias("k"), F.max(F.when(c("arm") == "treatment", 1)).alias("ht"), F.max(F.when(c("arm") == "control", 1)).alias("hk"))
    return s.filter("ht = 1 AND hk = 1").select("date", r(c("t") - c("k")).alias("gap"))


# -- aggregates --------------------------------------------------------------------------------------------------------
@query(f"""WITH {H} SELECT episode_id, arg_min_null(category, (date, hour_of_day)) AS category, arg_max_null(units_sold, (date, hour_of_day)) AS last_sold, CAST(sum(units_sold) AS BIGINT) AS sold, count(*) AS row_count, round(stddev_samp(total_discount), 6) AS spread, count(DISTINCT total_discount) AS levels FROM h GROUP BY 1""")
def agg_first_last(spark, d):
    """Order-sensitive and plain aggregates of each episode."""
    at = F.struct("date", "hour_of_day")
    return hours(spark, d).groupBy("episode_id").agg(
        F.min_by("category", at).alias("category"), F.max_by("units_sold", at).alias("last_sold"), F.sum("units_sold").alias("sold"), count().alias("row_count"),
        r(F.stddev_samp("total_discount")).alias("spread"), F.count_distinct("total_discount").alias("levels"),
    )


@query(f"WITH {H} SELECT sku_id, fc, date, CAST(sum(units_sold) AS BIGINT) AS sold, count(*) AS row_count FROM h GROUP BY ROLLUP (sku_id, fc, date)")
def agg_day_levels(spark, d):
    """Sums per article, site and day, and their totals."""
    return hours(spark, d).rollup("sku_id", "fc", "date").agg(F.sum("units_sold").alias("sold"), count().alias("row_count"))


@query(f"WITH {H} SELECT count(*) AS row_count, count(DISTINCT episode_id) AS episodes, count(DISTINCT sku_id) AS skus, count(DISTINCT fc) AS fcs, min(date) AS first_date, max(date) AS last_date, round(avg(CASE WHEN total_discount > 0 THEN 1.0 ELSE 0.0 END), 6) AS discounted, round(avg(CASE WHEN category IS NULL THEN 1.0 ELSE 0.0 END), 6) AS no_category FROM h")
def scan_profile(spark, d):
    """Profile of an extract: counts, distinct counts, range, shares."""
    return hours(spark, d).agg(
        count().alias("row_count"), F.count_distinct("episode_id").alias("episodes"), F.count_distinct("sku_id").alias("skus"), F.count_distinct("fc").alias("fcs"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), r(M.share(c("total_discount") > 0)).alias("discounted"), r(M.share(c("category").isNull())).alias("no_category"),
    )


_LOSS = f"""{_END}, e AS (SELECT episode_id, min(sku_id) AS sku_id, min(fc) AS fc, arg_min_null(category, (date, hour_of_day)) AS category, arg_min_null(original_price, (date, hour_of_day)) AS price,
  arg_min_null(cost, (date, hour_of_day)) AS cost, sum(original_price * total_discount * units_sold) AS given, sum(units_sold) AS sold FROM h GROUP BY 1),
loss AS (SELECT e.*, CAST(coalesce(given, 0) + coalesce(e.cost * scrap_units, 0) AS DOUBLE) AS il, CAST(coalesce(price * sold, 0) AS DOUBLE) AS denom FROM e JOIN endings USING (episode_id) WHERE scrap_units IS NOT NULL)"""


def _losses(x: DataFrame) -> DataFrame:
    """Discounts given and scrap at cost per closed episode (``il``), with price times units sold (``denom``)."""
    at = F.struct("date", "hour_of_day")
    e = x.groupBy("episode_id").agg(
        F.min("sku_id").alias("sku_id"), F.min("fc").alias("fc"), F.min_by("category", at).alias("category"), F.min_by("original_price", at).alias("price"), F.min_by("cost", at).alias("cost"),
        F.sum(c("original_price") * c("total_discount") * c("units_sold")).alias("given"), F.sum("units_sold").alias("sold"),
    )
    z = E.endings(x, EP).filter("scrap_units IS NOT NULL").select("episode_id", "scrap_units")
    y = e.join(z, "episode_id")
    il = F.coalesce("given", F.lit(0.0)) + F.coalesce(c("cost") * c("scrap_units"), F.lit(0.0))
    return y.withColumn("il", il).withColumn("denom", F.coalesce(c("price") * c("sold"), F.lit(0.0)))


@query(f"""WITH {H}, {_LOSS} SELECT category, fc, CAST(grouping_id(category, fc) AS BIGINT) AS cut, round(sum(il), 0) AS numerator, round(sum(denom), 0) AS denominator, round(CASE WHEN sum(denom) > 0 THEN sum(il) / sum(denom) END, 6) AS ratio
FROM loss GROUP BY GROUPING SETS ((), (category), (fc))""")
def rep_loss_ratio(spark, d):
    """Ratio of sums of losses to sales, overall, per category and per site."""
    x = M.ratio_cuts(_losses(hours(spark, d)), "il", "denom", [[], ["category"], ["fc"]])
    return x.select("category", "fc", c("cut").cast("long").alias("cut"), r("numerator", 0).alias("numerator"), r("denominator", 0).alias("denominator"), r("ratio").alias("ratio"))


@query(f"""WITH {H}, {_LOSS}, u AS (SELECT sku_id, fc, sum(il) AS y, sum(denom) AS x FROM loss GROUP BY 1, 2), t AS (SELECT sum(y) / sum(x) AS q, count(*) AS n, avg(x) AS mx FROM u)
SELECT any_value(n) AS units, round(any_value(q), 6) AS ratio, round(sqrt(var_samp(y - q * x) / (any_value(n) * any_value(mx) * any_value(mx))), 6) AS se FROM u, t""")
def agg_clustered_ratio(spark, d):
    """The ratio with its error clustered by article and site."""
    return M.clustered_ratio(_losses(hours(spark, d)), ["sku_id", "fc"], "il", "denom").select("units", r("ratio").alias("ratio"), r("se").alias("se"))


def _pcts(x: str) -> str:
    return ", ".join(f"round(quantile_cont({x}, {p}), 6) AS p{round(p * 100)}" for p in M.PERCENTS)


@query(f"WITH {H}, f AS ({_FIRST}) SELECT category, count(*) AS episodes, {_pcts('cost / original_price')}, round(avg(CASE WHEN 1 - cost / original_price < 0.15 THEN 1.0 ELSE 0.0 END), 6) AS below FROM f WHERE original_price > 0 AND cost IS NOT NULL GROUP BY 1")
def rep_cost_ratio(spark, d):
    """Cost ratio of each episode at its first row, its percentiles and share of low ceilings per category."""
    f = E.edge_rows(hours(spark, d), EP, ["category", "cost", "original_price"], last=False).filter("original_price > 0 AND cost IS NOT NULL")
    q = c("cost") / c("original_price")
    return f.groupBy("category").agg(count().alias("episodes"), *[r(p).alias(n) for p, n in zip([F.percentile(q, F.lit(x)) for x in M.PERCENTS], ["p10", "p25", "p50", "p75", "p90"])], r(M.share(1 - q < 0.15)).alias("below"))


@query(f"""WITH {H}, g AS (SELECT category, hour_of_day, 100 * stddev_samp(total_discount) AS s, count(DISTINCT total_discount) AS levels, count(DISTINCT episode_id) AS eps FROM h WHERE category IS NOT NULL GROUP BY 1, 2)
SELECT category, count(*) AS cells, round(median(s), 6) AS median_spread, round(median(levels), 6) AS median_levels, round(median(eps), 6) AS median_episodes, round(avg(CASE WHEN s < 0.5 THEN 1.0 ELSE 0.0 END), 6) AS weak FROM g GROUP BY 1""")
def rep_same_hour_variation(spark, d):
    """Spread of discounts inside cells of category and hour."""
    g = hours(spark, d).dropna(subset=["category"]).groupBy("category", "hour_of_day").agg((100 * F.stddev_samp("total_discount")).alias("s"), F.count_distinct("total_discount").alias("levels"), F.count_distinct("episode_id").alias("eps"))
    return g.groupBy("category").agg(count().alias("cells"), r(F.median("s")).alias("median_spread"), r(F.median("levels")).alias("median_levels"), r(F.median("eps")).alias("median_episodes"), r(M.share(c("s") < 0.5)).alias("weak"))


@query(f"""WITH {H}, b AS (SELECT *, units_sold - avg(units_sold) OVER (PARTITION BY category, hour_of_day) AS resid FROM h), k AS (SELECT * FROM b QUALIFY count(resid) OVER (PARTITION BY episode_id) >= 3),
m AS (SELECT episode_id, avg(resid) AS m FROM k GROUP BY 1), v AS (SELECT var_samp(m) AS between_ FROM m), t AS (SELECT var_samp(resid) AS total, count(resid) AS n FROM k), z AS (SELECT count(*) / count(DISTINCT episode_id) AS size FROM h)
SELECT round(least(greatest(between_ / total, 0), 0.95), 6) AS rho, n AS row_count, round(greatest(1, 1 + (size - 1) * least(greatest(between_ / total, 0), 0.95)), 6) AS effect FROM v, t, z""")
def rep_intra_episode(spark, d):
    """Correlation of residuals inside episodes and the design effect it implies."""
    x = hours(spark, d)
    base = x.groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("base"))
    y = x.join(base, c("category").eqNullSafe(c("_k")) & (c("hour_of_day") == c("_h"))).withColumn("resid", c("units_sold") - c("base"))
    size = x.agg((count() / F.count_distinct("episode_id")).alias("size"))
    rho = M.intra_class(y, EP, "resid").crossJoin(size)
    return rho.select(r("rho").alias("rho"), c("rows").alias("row_count"), r(M.design_effect(c("rho"), c("size"))).alias("effect"))


@query(f"WITH {H} SELECT category, count(*) AS row_count, round(avg(CASE WHEN units_sold = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share, round(avg(units_sold), 6) AS mean_sold, round(quantile_cont(units_sold, 0.5), 6) AS p50, round(quantile_cont(units_sold, 0.9), 6) AS p90, round(avg(CASE WHEN units_sold >= starting_inventory THEN 1.0 ELSE 0.0 END), 6) AS censored FROM h GROUP BY 1")
def rep_demand_density(spark, d):
    """Density of sales and share of censored hours per category."""
    return hours(spark, d).groupBy("category").agg(
        count().alias("row_count"), r(M.share(c("units_sold") == 0)).alias("zero_share"), r(F.avg("units_sold")).alias("mean_sold"), r(F.percentile("units_sold", F.lit(0.5))).alias("p50"),
        r(F.percentile("units_sold", F.lit(0.9))).alias("p90"), r(M.share(c("units_sold") >= c("starting_inventory"))).alias("censored"),
    )


@query(f"WITH {H}, w AS (SELECT category, date_trunc('week', date) AS week, count(DISTINCT episode_id) AS n FROM h WHERE category IS NOT NULL GROUP BY 1, 2) SELECT category, round(median(n), 6) AS mid, min(n) AS low, max(n) AS high, count(*) AS weeks FROM w GROUP BY 1")
def rep_weekly_episodes(spark, d):
    """Episodes per category and week."""
    w = hours(spark, d).dropna(subset=["category"]).groupBy("category", F.date_trunc("week", "date").alias("week")).agg(F.count_distinct("episode_id").alias("n"))
    return w.groupBy("category").agg(r(F.median("n")).alias("mid"), F.min("n").alias("low"), F.max("n").alias("high"), count().alias("weeks"))


@query(f"WITH {H}, f AS ({_FIRST}) SELECT category, {_pcts('hour_of_day')}, round(stddev_samp(hour_of_day), 6) AS spread, count(DISTINCT hour_of_day) AS hours FROM f GROUP BY 1")
def rep_entry_hour(spark, d):
    """Opening hour of episodes (by date and hour, so that windows over midnight count at their start)."""
    f = E.edge_rows(hours(spark, d), EP, ["category"], last=False)
    return f.groupBy("category").agg(*[r(F.percentile("hour_of_day", F.lit(p))).alias(f"p{round(p * 100)}") for p in M.PERCENTS], r(F.stddev_samp("hour_of_day")).alias("spread"), F.count_distinct("hour_of_day").alias("hours"))


_EDGE = "CASE " + " ".join(f"WHEN gap > CAST({M.GAP_EDGES[i]!r} AS DOUBLE) AND gap <= CAST({M.GAP_EDGES[i + 1]!r} AS DOUBLE) THEN {i}" for i in range(8)) + " END"


@query(f"WITH {H}, g AS (SELECT *, total_discount - d_ref AS gap FROM h) SELECT CAST({_EDGE} AS INTEGER) AS bin, count(*) AS row_count, CAST(sum(units_sold) AS BIGINT) AS sold, round(sum(units_sold) / nullif(sum(starting_inventory), 0), 6) AS ratio FROM g GROUP BY 1")
def agg_bins(spark, d):
    """Sales ratio by right-closed bins of the discount gap."""
    gap = M.right_closed_bin(c("total_discount") - c("d_ref"), M.GAP_EDGES)
    return hours(spark, d).groupBy(gap.alias("bin")).agg(count().alias("row_count"), F.sum("units_sold").alias("sold"), r(ratio(F.sum("units_sold"), F.sum("starting_inventory"))).alias("ratio"))


@query(f"WITH {H}, {_END} SELECT ending, count(*) AS episodes, round(count(*) / sum(count(*)) OVER (), 6) AS share, CAST(sum(left_units) AS BIGINT) AS left_units FROM endings GROUP BY 1")
def rep_endings(spark, d):
    """Shares of the ways in which episodes end, with the units left."""
    e = E.endings(hours(spark, d), EP).groupBy("ending").agg(count().alias("episodes"), F.sum("left_units").alias("left_units"))
    total = e.agg(F.sum("episodes").alias("_t"))  # one row
    return e.crossJoin(F.broadcast(total)).select("ending", "episodes", r(c("episodes") / c("_t")).alias("share"), "left_units")


@query(f"""WITH {H}, {_END}, k AS (SELECT coalesce(category, 'NONE') AS category, count(*) AS episodes, CAST(sum(left_units) AS BIGINT) AS left_units FROM endings JOIN (SELECT episode_id AS i FROM endings) ON i = episode_id WHERE left_units > 0 GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY left_units DESC, category) AS rn FROM k) SELECT CASE WHEN rn <= 8 THEN category ELSE 'other' END AS category, CAST(sum(episodes) AS BIGINT) AS episodes, CAST(sum(left_units) AS BIGINT) AS left_units FROM o GROUP BY 1""")
def agg_top_other(spark, d):
    """Categories with the most units left, the rest put together."""
    e = E.endings(hours(spark, d), EP, ["category"]).filter("left_units > 0")
    k = e.groupBy(F.coalesce("category", F.lit("NONE")).alias("category")).agg(count().alias("episodes"), F.sum("left_units").alias("left_units"))
    return M.top_with_other(k, "category", ["episodes", "left_units"], "left_units", 8)


@query(f"WITH {H}, p AS (SELECT *, avg(units_sold) OVER (PARTITION BY category, hour_of_day) AS guess FROM h) SELECT category, round(avg(abs(guess - units_sold)), 6) AS mae, round(sqrt(avg((guess - units_sold) * (guess - units_sold))), 6) AS rmse, round(avg(guess - units_sold), 5) AS bias, round(avg(CASE WHEN (guess < 0.5) = (units_sold = 0) THEN 1.0 ELSE 0.0 END), 6) AS zero_accuracy FROM p GROUP BY 1")
def agg_fidelity(spark, d):
    """Errors of a constant prediction per category and hour."""
    x = hours(spark, d)
    base = x.groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("guess"))
    y = x.join(base, c("category").eqNullSafe(c("_k")) & (c("hour_of_day") == c("_h")))
    e = c("guess") - c("units_sold")
    return y.groupBy("category").agg(r(F.avg(F.abs(e))).alias("mae"), r(F.sqrt(F.avg(e * e))).alias("rmse"), r(F.avg(e), 5).alias("bias"), r(M.share((c("guess") < 0.5) == (c("units_sold") == 0))).alias("zero_accuracy"))


@query(f"WITH {H} SELECT category, round(coalesce(sum(total_discount * units_sold) / nullif(sum(units_sold) FILTER (total_discount IS NOT NULL), 0), avg(total_discount)), 6) AS mean_discount FROM h WHERE units_sold >= 0 GROUP BY 1")
def agg_weighted(spark, d):
    """Discount weighted by units sold; unweighted where nothing was sold."""
    x = hours(spark, d).filter("units_sold >= 0")
    weight = F.sum(F.when(c("total_discount").isNotNull(), c("units_sold")))
    return x.groupBy("category").agg(r(F.coalesce(F.when(weight != 0, F.sum(c("total_discount") * c("units_sold")) / weight), F.avg("total_discount"))).alias("mean_discount"))


# -- daily series ------------------------------------------------------------------------------------------------------
_SERIES = "s AS (SELECT date, sum(units_sold) / nullif(sum(starting_inventory), 0) AS v FROM h GROUP BY 1)"


def _series(x: DataFrame) -> DataFrame:
    return x.groupBy("date").agg(ratio(F.sum("units_sold"), F.sum("starting_inventory")).alias("v"))


@query(f"""WITH {H}, {_SERIES}, k AS (SELECT date, CASE WHEN count(v) OVER w = 7 THEN avg(v) OVER w END AS smooth FROM s WHERE v IS NOT NULL WINDOW w AS (ORDER BY date ROWS 6 PRECEDING))
SELECT date, round(smooth, 6) AS smooth, round(lag(smooth, 7) OVER (ORDER BY date), 6) AS smooth_before FROM k""")
def win_smoothed(spark, d):
    """Daily ratio, smoothed over full weeks and compared with the week before. One row per day, so one task holds it."""
    s = _series(hours(spark, d)).filter("v IS NOT NULL")
    return M.smoothed(s, "date", "v", CFG.smoothing_days).select("date", r("smooth").alias("smooth"), r("smooth_before").alias("smooth_before"))


@query(f"""WITH {H}, {_SERIES}, m AS (SELECT median(v) AS m FROM s), q AS (SELECT 1.4826 * median(abs(v - m)) AS q FROM s, m)
SELECT round(any_value(m), 6) AS median, round(any_value(q), 6) AS robust_sigma, round(stddev_samp(v), 6) AS sigma, count(*) FILTER (abs(v - m) > 3 * q) AS outliers FROM s, m, q""")
def agg_robust_spread(spark, d):
    """Robust and plain spread of the daily ratio."""
    x = M.robust_spread(_series(hours(spark, d)), "v")
    return x.select(r("median").alias("median"), r("robust_sigma").alias("robust_sigma"), r("sigma").alias("sigma"), "outliers")


@query(f"""WITH {H}, s AS (SELECT fc, date, sum(units_sold) / nullif(sum(starting_inventory), 0) AS v FROM h GROUP BY 1, 2), o AS (SELECT *, coalesce(v > 0.05, false) AS over FROM s), k AS (SELECT fc, max(date) FILTER (NOT over) AS calm FROM o GROUP BY 1)
SELECT o.fc, count(*) FILTER (calm IS NULL OR date > calm) AS streak FROM o JOIN k ON o.fc = k.fc GROUP BY 1""")
def agg_streak(spark, d):
    """Latest days in a row on which a site's ratio lies above a threshold."""
    s = hours(spark, d).groupBy("fc", "date").agg(ratio(F.sum("units_sold"), F.sum("starting_inventory")).alias("v"))
    return M.trailing_streak(s, ["fc"], "date", c("v") > 0.05)


@query(f"""WITH {H}, w AS (SELECT category, date_trunc('week', date) AS week, sum(units_sold) AS sold, sum(starting_inventory) AS stock FROM h WHERE category IS NOT NULL GROUP BY 1, 2), k AS (SELECT category, sum(sold) / sum(stock) AS f FROM w GROUP BY 1)
SELECT CAST(week AS DATE) AS week, round(sum(sold) / sum(stock), 6) AS raw_ratio, round(sum(stock * f) / sum(stock), 6) AS mix_ratio FROM w JOIN k ON w.category = k.category GROUP BY 1""")
def rep_mix(spark, d):
    """Weekly ratio and what the week's mix of categories alone would give."""
    w = hours(spark, d).dropna(subset=["category"]).groupBy("category", F.date_trunc("week", "date").cast("date").alias("week")).agg(F.sum("units_sold").alias("sold"), F.sum("starting_inventory").alias("stock"))
    f = w.groupBy("category").agg((F.sum("sold") / F.sum("stock")).alias("f"))
    x = w.join(f, "category")
    return x.groupBy("week").agg(r(F.sum("sold") / F.sum("stock")).alias("raw_ratio"), r(F.sum(c("stock") * c("f")) / F.sum("stock")).alias("mix_ratio"))


# -- order, sample, sets -----------------------------------------------------------------------------------------------
@query(f"WITH {H}, k AS (SELECT subcategory, avg(units_sold) AS m FROM h GROUP BY 1), g AS (SELECT avg(units_sold) AS g FROM h) SELECT subcategory, round(m / g, 6) AS factor FROM k, g ORDER BY abs(m / g - 1) DESC, subcategory LIMIT 12")
def top_deviation(spark, d):
    """The twelve subcategories farthest from the overall level."""
    x = hours(spark, d)
    k = x.groupBy("subcategory").agg(F.avg("units_sold").alias("m")).crossJoin(F.broadcast(x.agg(F.avg("units_sold").alias("g"))))  # one row
    return k.withColumn("f", c("m") / c("g")).orderBy(F.abs(c("f") - 1).desc(), "subcategory").limit(12).select("subcategory", r("f").alias("factor"))


@query("SELECT DISTINCT sku_id FROM prepared INTERSECT SELECT DISTINCT sku_id FROM flc_raw")
def set_intersect(spark, d):
    return table(spark, d, "prepared").select("sku_id").intersect(table(spark, d, "flc_raw").select("sku_id"))


@query("SELECT DISTINCT sku_id FROM prepared EXCEPT SELECT DISTINCT sku_id FROM flc_raw")
def set_except(spark, d):
    return table(spark, d, "prepared").select("sku_id").distinct().join(table(spark, d, "flc_raw").select("sku_id").distinct(), "sku_id", "left_anti")


@query("SELECT sku_id, fc, count(*) AS row_count FROM (SELECT sku_id, fc FROM prepared UNION ALL SELECT sku_id, upper(trim(fc, ' \t')) FROM flc_raw) GROUP BY 1, 2")
def set_union_all(spark, d):
    from dusklark.functions.text import code

    a = table(spark, d, "prepared").select("sku_id", "fc")
    b = table(spark, d, "flc_raw").select("sku_id", code(c("fc")).alias("fc"))
    return a.unionByName(b).groupBy("sku_id", "fc").agg(count().alias("row_count"))


@query(f"WITH {H}, k AS (SELECT DISTINCT episode_id FROM h WHERE episode_id IS NOT NULL), s AS (SELECT episode_id FROM k ORDER BY md5(concat_ws('|', episode_id, '7')), episode_id LIMIT 500) SELECT h.* FROM h JOIN s ON h.episode_id = s.episode_id")
def sample_hashed(spark, d):
    """Rows of 500 episodes drawn by hash: a semi-join on a list of fixed size."""
    x = hours(spark, d)
    return x.join(F.broadcast(M.hash_sample(x, "episode_id", 500, 7)), "episode_id", "left_semi")
