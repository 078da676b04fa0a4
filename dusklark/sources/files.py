"""Scans and sinks: parquet, JSON lines, JDBC, reports."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dusklark.config import iso_date
from dusklark.schema import missing_columns
from dusklark.session import SharedFiles

CORRUPT = "_corrupt_record"


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet scan; with a schema, its columns must be there. Pruning and push-down are the planner's."""
    df = spark.read.parquet(path)
    if schema is not None and (gone := missing_columns(df.columns, schema)):
        raise ValueError(f"{path} lacks {gone}")
    return df


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A parquet sink; partition folders get one writer per value instead of one file per task and value."""
    if by:
        df.repartition(*by).write.mode(mode).partitionBy(*by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines: readable rows, and lines that aren't JSON or don't fit the schema (column ``line``)."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"))
    good = parsed.filter(F.col(f"j.{CORRUPT}").isNull()).select(*[F.col(f"j.{f.name}") for f in schema.fields])
    return good, parsed.filter(F.col(f"j.{CORRUPT}").isNotNull()).select(F.col("value").alias("line"))


def append_json_lines(df: DataFrame, path: str) -> None:
    """Append events as JSON lines; the commit protocol shows a batch whole or not at all."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def extract_sql(table: str, start: str, end: str, exclude: tuple[str, str] | None = None) -> str:
    """The query of an extract: projection, date range, and a span left out. Dates are checked, names must be plain."""
    if not all(part.isidentifier() for part in table.split(".")):
        raise ValueError(f"{table!r} is no table name")
    a, z = iso_date(start, "start"), iso_date(end, "end")
    out = f"SELECT date, hour_of_day, sku_id, UPPER(fc) AS fc, inventory, discount, units_sold FROM {table} WHERE date BETWEEN DATE '{a}' AND DATE '{z}'"
    if exclude:
        out += f" AND NOT (date BETWEEN DATE '{iso_date(exclude[0], 'exclude start')}' AND DATE '{iso_date(exclude[1], 'exclude end')}')"
    return out


def scan_jdbc(spark: SparkSession, url: str, query: str, partitions: int = 1, column: str | None = None, bounds: tuple[str, str] | None = None) -> DataFrame:
    """A JDBC scan; user and password come from JDBC_USER and JDBC_PASSWORD. With a column and bounds it is read in parallel."""
    options = {"url": url, "dbtable": f"({query}) AS extract", "user": os.environ.get("JDBC_USER", ""), "password": os.environ.get("JDBC_PASSWORD", ""), "fetchsize": "10000"}
    if column and bounds:
        options |= {"partitionColumn": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(**options).load()


def write_report(spark: SparkSession, df: DataFrame, path: str, limit: int = 10_000) -> None:
    """A small aggregate as one JSON document that takes the place of an earlier one in one step; refused above ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report of more than {limit} rows is a table; write it as one")
    SharedFiles(spark, path).replace(path, json.dumps([r.asDict(recursive=True) for r in rows], default=str, ensure_ascii=False))
