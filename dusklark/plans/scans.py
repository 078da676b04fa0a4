"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from dusklark.schema import outcome_schema, raw_schema
from dusklark.session import scratch, table
from dusklark.sources import files, synthetic

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT date, hour_of_day, sku_id, upper(fc) AS fc, inventory, discount, units_sold FROM flc_raw WHERE date BETWEEN DATE '2026-03-15' AND DATE '2026-07-15' AND NOT (date BETWEEN DATE '2026-04-25' AND DATE '2026-06-03')")
def scan_extract(spark, d):
    """A generated extract query over the checked scan; range and columns reach the parquet reader."""
    files.scan_parquet(spark, f"{d}/flc_raw.parquet", raw_schema()).createOrReplaceTempView("flc_raw_source")
    return spark.sql(files.extract_sql("flc_raw_source", "2026-03-15", "2026-07-15", ("2026-04-25", "2026-06-03")))


@query("SELECT outcome_id, decision_id, units_sold, starting_inventory, ending_inventory, applied_price, is_stockout, execution_status, finalized_at FROM outcome_log")
def scan_json_events(spark, d):
    """Outcomes appended as JSON lines and read back under the schema."""
    path = scratch(spark, "events")
    names = ["outcome_id", "decision_id", "units_sold", "starting_inventory", "ending_inventory", "applied_price", "is_stockout", "execution_status", "finalized_at"]
    files.append_json_lines(table(spark, d, "outcome_log").select(*names), path)
    schema = outcome_schema()
    good, _ = files.scan_json_lines(spark, path, type(schema)([schema[n] for n in names]))
    return good


@query("SELECT date, count(*) AS row_count, CAST(sum(units_sold) AS BIGINT) AS sold FROM prepared WHERE date BETWEEN DATE '2025-12-01' AND DATE '2025-12-31' GROUP BY 1")
def sink_partitioned(spark, d):
    """A table written by date and read back for one month: only its folders are opened."""
    path = scratch(spark, "by-date")
    files.write_parquet(table(spark, d, "prepared").select("date", "sku_id", "units_sold"), path, ["date"])
    x = spark.read.parquet(path).filter(F.col("date").between("2025-12-01", "2025-12-31"))
    return x.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"), F.sum("units_sold").alias("sold"))


@query(None)
def gen_hours(spark, d):
    """Made-up hourly rows of 500 articles over 60 days."""
    return synthetic.hourly_rows(spark, 500, 60)
