"""Queries over the at-least-once feeds, the hourly rows and the prepared table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dusklark.functions.text import identifier, instant
from dusklark.operators import once, orphans, rolling, sessions
from dusklark.session import scratch, table, written

#: Each feed's batches are taken in as this many groups, the later ones against the history of the earlier.
VERSIONS = 2


def _feeds() -> dict[str, tuple[str, list]]:
    return {
        "decision_log": ("decision_id", [F.col("received_at")]),
        "outcome_log": ("outcome_id", [instant(F.col("finalized_at")), F.col("received_at")]),
    }


def _store(spark: SparkSession, sf_dir: str, feed: str) -> once.OnceStore:
    key, rank = _feeds()[feed]
    store = once.OnceStore(spark, scratch(spark, f"once-{feed}"), key, "delivery_id", "received_at", rank)
    once.ingest_in_batches(store, table(spark, sf_dir, feed), "batch_id", "received_at", VERSIONS)
    return store


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that aren't kept: what the store of each feed, holding whole messages, doesn't hold once all its batches are in."""
    parts = []
    for feed in _feeds():
        kept = _store(spark, sf_dir, feed).current().select("delivery_id")
        left = table(spark, sf_dir, feed).select("delivery_id").join(kept, "delivery_id", "left_anti")
        parts.append(left.select(F.lit(feed).alias("feed"), "delivery_id"))
    return parts[0].unionByName(parts[1])


def p1_kept_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept outcomes in full."""
    return _store(spark, sf_dir, "outcome_log").current()


def p1_kept_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept decisions in full."""
    return _store(spark, sf_dir, "decision_log").current()


def p2_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selling episodes with start, end, duration in hours and row count."""
    e = sessions.selling_episodes(table(spark, sf_dir, "flc_raw"))
    return e.select("sku_id", "fc", sessions.hour_text(F.col("start")).alias("start_hour"), sessions.hour_text(F.col("end")).alias("end_hour"), F.col("duration").alias("duration_hours"), F.col("events").alias("row_count"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_episodes(spark, sf_dir).select("sku_id", "fc", "start_hour", "end_hour")


def _existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    return orphans.record_deltas(t("decision_log"), "decision_id", "received_at", t("decision_voids"), "decision_id", "voided_at")


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes, ledger = table(spark, sf_dir, "outcome_log"), table(spark, sf_dir, "spread_ledger")
    c = F.col
    a = orphans.references("outcome_log", outcomes, identifier(c("outcome_id")), c("decision_id"), c("received_at"), c("delivery_id"))
    b = orphans.references("spread_ledger", ledger, c("ledger_id").cast("string"), c("decision_id"), c("received_at"), F.lit(None))
    return written(a.unionByName(b), "references")  # read for the counts and again for what they name


def _counts(spark: SparkSession, sf_dir: str, refs: DataFrame) -> DataFrame:
    """The stored counts after the decisions' and the references' deltas."""
    store = orphans.CountStore(spark, scratch(spark, "counts"))
    store.apply(1, _existence(spark, sf_dir))
    store.apply(2, orphans.deltas(refs, refs=F.lit(1)))
    return store.state()


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _references(spark, sf_dir)
    return orphans.orphan_references(refs, written(_counts(spark, sf_dir, refs), "state"))  # read for hot keys, their rows and the rest


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("child_table", "child_id", "kind").distinct()


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month and kind; every delivery of an outcome without identifier counts."""
    return orphans.orphan_report(_orphans(spark, sf_dir))


def p4_current_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that outcomes or ledger rows reference now and that don't exist now, from the signed counts."""
    return orphans.orphan_keys(_counts(spark, sf_dir, _references(spark, sf_dir)))


def p5_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages of units sold over the trailing 7 and 30 days, for each day of each sku and site up to the pair's own last; the days after it are in ``p5_trailing_all``."""
    out = rolling.trailing_totals(table(spark, sf_dir, "prepared"), ["sku_id", "fc"], "date", "units_sold", [7, 30])
    return out.drop("first_day")


def p5_trailing_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages of units sold over the trailing 7 and 30 days, for each day of each sku and site from its first to the table's last."""
    out = rolling.trailing_totals(table(spark, sf_dir, "prepared"), ["sku_id", "fc"], "date", "units_sold", [7, 30], to_end=True)
    return out.drop("first_day")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rolling.stale_rates(table(spark, sf_dir, "prepared"), ["sku_id", "fc"], "date", "units_sold", "sku_ref_sales_rate_30d")
    return bad.select("sku_id", "fc", F.date_format("date", "yyyy-MM-dd").alias("day"))


QUERIES = {f.__name__: f for f in (p1_found, p1_kept_outcomes, p1_kept_decisions, p2_found, p2_episodes, p4_found, p4_report, p4_current_keys, p5_found, p5_trailing, p5_trailing_all)}

# White space around identifiers, as the Spark side strips it.
_BLANK = r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _same(column: str) -> str:
    return f"nullif(lower(regexp_replace({column}, '^{_BLANK}|{_BLANK}$', '', 'g')), '')"


_INSTANT = """CASE WHEN regexp_matches(finalized_at, '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN CAST(finalized_at AS TIMESTAMPTZ)
    ELSE CAST(finalized_at || '+00:00' AS TIMESTAMPTZ) END"""

_LOSERS = f"""
WITH d AS (SELECT delivery_id, received_at, coalesce({_same("decision_id")}, chr(1) || delivery_id) AS k FROM decision_log),
o AS (SELECT delivery_id, received_at, {_INSTANT} AS fin, coalesce({_same("outcome_id")}, chr(1) || delivery_id) AS k FROM outcome_log),
dr AS (SELECT delivery_id, row_number() OVER (PARTITION BY k ORDER BY received_at NULLS LAST, delivery_id) AS rn FROM d),
orr AS (SELECT delivery_id, row_number() OVER (PARTITION BY k ORDER BY fin NULLS LAST, received_at NULLS LAST, delivery_id) AS rn FROM o)
"""

_EPISODES = """
WITH h AS (
  SELECT sku_id, nullif(upper(trim(fc, ' \t\n')), '') AS fc, date_diff('day', DATE '1970-01-01', date) * 24 + hour_of_day AS t, hours_remaining AS c, loaded_at, row_id
  FROM flc_raw WHERE sku_id IS NOT NULL AND fc IS NOT NULL AND hour_of_day IS NOT NULL),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku_id, fc, t ORDER BY loaded_at DESC, row_id DESC) AS rn FROM h) WHERE rn = 1),
g AS (SELECT *, lag(t) OVER w AS pt, lag(c) OVER w AS pc FROM one WINDOW w AS (PARTITION BY sku_id, fc ORDER BY t)),
f AS (SELECT *, CASE WHEN pt = t - 1 AND (c IS NULL OR pc IS NULL OR c < 0 OR pc < 0 OR c = pc - 1) THEN 0 ELSE 1 END AS opens FROM g),
s AS (SELECT *, sum(opens) OVER (PARTITION BY sku_id, fc ORDER BY t) AS n FROM f),
e AS (SELECT sku_id, fc, min(t) AS a, max(t) AS z, count(*) AS row_count FROM s GROUP BY sku_id, fc, n)
SELECT sku_id, fc, strftime(TIMESTAMP '1970-01-01' + to_hours(CAST(a AS BIGINT)), '%Y-%m-%dT%H') AS start_hour,
  strftime(TIMESTAMP '1970-01-01' + to_hours(CAST(z AS BIGINT)), '%Y-%m-%dT%H') AS end_hour"""

_ORPHANS = f"""
WITH born AS (SELECT {_same("decision_id")} AS k, min(received_at) AS b FROM decision_log GROUP BY 1),
gone AS (SELECT {_same("decision_id")} AS k, min(voided_at) AS v FROM decision_voids GROUP BY 1),
o AS (SELECT {_same("outcome_id")} AS child_id, coalesce({_same("outcome_id")}, chr(1) || delivery_id) AS who, {_same("decision_id")} AS k, received_at FROM outcome_log),
m AS (SELECT who, min(received_at) AS moment FROM o GROUP BY 1),
refs AS (SELECT DISTINCT 'outcome_log' AS child_table, o.child_id, who, o.k, m.moment FROM o JOIN m USING (who) WHERE o.k IS NOT NULL
  UNION ALL SELECT 'spread_ledger', CAST(ledger_id AS VARCHAR), CAST(ledger_id AS VARCHAR), {_same("decision_id")}, received_at FROM spread_ledger WHERE {_same("decision_id")} IS NOT NULL),
found AS (SELECT child_table, child_id, refs.k, moment, CASE WHEN b IS NULL THEN 'missing' WHEN v <= moment THEN 'deleted' WHEN b > moment THEN 'late' END AS kind
  FROM refs LEFT JOIN born ON refs.k = born.k LEFT JOIN gone ON refs.k = gone.k)
"""

_TRAILING = """
WITH daily AS (SELECT sku_id, fc, date, CAST(sum(coalesce(units_sold, 0)) AS BIGINT) AS total FROM prepared
  WHERE sku_id IS NOT NULL AND fc IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2, 3),
cal AS (SELECT sku_id, fc, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily GROUP BY 1, 2)
SELECT c.sku_id, c.fc, c.date,
  CAST(coalesce(sum(d.total) FILTER (WHERE d.date > c.date - 7), 0) AS BIGINT) AS total_7d, CAST(coalesce(sum(d.total), 0) AS BIGINT) AS total_30d,
  coalesce(sum(d.total) FILTER (WHERE d.date > c.date - 7), 0) / 7.0 AS mean_7d, coalesce(sum(d.total), 0) / 30.0 AS mean_30d
FROM cal c LEFT JOIN daily d ON d.sku_id = c.sku_id AND d.fc = c.fc AND d.date <= c.date AND d.date > c.date - 30
GROUP BY 1, 2, 3"""

_TRAILING_ALL = """
WITH daily AS (SELECT sku_id, fc, date, CAST(sum(coalesce(units_sold, 0)) AS BIGINT) AS total FROM prepared
  WHERE sku_id IS NOT NULL AND fc IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2, 3),
cal AS (SELECT sku_id, fc, CAST(unnest(generate_series(min(date), (SELECT max(date) FROM daily), INTERVAL 1 DAY)) AS DATE) AS date FROM daily GROUP BY 1, 2)
SELECT c.sku_id, c.fc, c.date,
  CAST(coalesce(sum(d.total) FILTER (WHERE d.date > c.date - 7), 0) AS BIGINT) AS total_7d, CAST(coalesce(sum(d.total), 0) AS BIGINT) AS total_30d,
  coalesce(sum(d.total) FILTER (WHERE d.date > c.date - 7), 0) / 7.0 AS mean_7d, coalesce(sum(d.total), 0) / 30.0 AS mean_30d
FROM cal c LEFT JOIN daily d ON d.sku_id = c.sku_id AND d.fc = c.fc AND d.date <= c.date AND d.date > c.date - 30
GROUP BY 1, 2, 3"""

_STALE = """
WITH daily AS (SELECT sku_id, fc, date, sum(coalesce(units_sold, 0)) AS total, min(sku_ref_sales_rate_30d) AS lo, max(sku_ref_sales_rate_30d) AS hi,
  min(date) OVER (PARTITION BY sku_id, fc) AS first_day FROM prepared GROUP BY 1, 2, 3),
w AS (SELECT *, coalesce(sum(total) OVER (PARTITION BY sku_id, fc ORDER BY date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) / 30.0 AS want FROM daily)
SELECT sku_id, fc, strftime(date, '%Y-%m-%d') AS day FROM w
WHERE hi IS NOT NULL AND (date = first_day OR hi - want > 1e-6 OR want - lo > 1e-6)"""

SQL = {
    "p1_found": _LOSERS + "SELECT 'decision_log' AS feed, delivery_id FROM dr WHERE rn > 1 UNION ALL SELECT 'outcome_log', delivery_id FROM orr WHERE rn > 1",
    "p1_kept_outcomes": _LOSERS + "SELECT outcome_log.* FROM outcome_log JOIN orr USING (delivery_id) WHERE rn = 1",
    "p1_kept_decisions": _LOSERS + "SELECT decision_log.* FROM decision_log JOIN dr USING (delivery_id) WHERE rn = 1",
    "p2_found": _EPISODES + " FROM e",
    "p2_episodes": _EPISODES + ", CAST(z - a AS BIGINT) AS duration_hours, row_count FROM e",
    "p4_found": _ORPHANS + "SELECT DISTINCT child_table, child_id, kind FROM found WHERE kind IS NOT NULL",
    "p4_report": _ORPHANS + "SELECT child_table, strftime(moment, '%Y-%m') AS period, kind, count(*) AS orphans, count(DISTINCT k) AS keys FROM found WHERE kind IS NOT NULL GROUP BY 1, 2, 3",
    "p4_current_keys": _ORPHANS + "SELECT refs.k AS key, count(*) AS refs FROM refs LEFT JOIN born ON refs.k = born.k LEFT JOIN gone ON refs.k = gone.k WHERE b IS NULL OR v IS NOT NULL GROUP BY 1",
    "p5_found": _STALE,
    "p5_trailing": _TRAILING,
    "p5_trailing_all": _TRAILING_ALL,
}
