"""Queries of the text and percentile operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dusklark.functions.text import label
from dusklark.llm import digest, leakage, packing, pii
from dusklark.session import table, written

METRICS = ["cost", "original_price", "total_discount"]
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def _certified(df: DataFrame, digests: DataFrame) -> DataFrame:
    found = written(digest.estimates(digests, PROBS), "estimates")
    out = digest.certify(df, label(F.col("category")), METRICS, found, PROBS)
    return out.select(F.col("grp").alias("category"), "metric", "p", "value", "n", "rank_low", "rank_high", "rank_error")


def p3_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of cost, price and discount per category, each with its counted rank error."""
    df = table(spark, sf_dir, "prepared")
    parts = digest.build_digests(df, label(F.col("category")), METRICS)
    return _certified(df, digest.merge_digests(parts))


def p3_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from digests of single months, written apart and put together afterwards."""
    df = table(spark, sf_dir, "prepared")
    month = F.concat_ws("\u0001", F.date_format("date", "yyyy-MM"), F.coalesce(label(F.col("category")), F.lit(digest.NULL_GROUP)))
    monthly = written(digest.merge_digests(digest.build_digests(df, month, METRICS)), "monthly")
    lane = F.abs(F.hash("grp")).cast("long")
    parts = monthly.withColumn("lane", lane).withColumn("grp", F.substring_index("grp", "\u0001", -1))
    return _certified(df, digest.merge_digests(parts))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of 2048 tokens with the documents in them."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "heldout_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p7_removal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character spans to cut from each document concerned."""
    return leakage.removal_spans(_spans(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_mentions(table(spark, sf_dir, "documents")).select("doc_id", "kind", "mention").distinct()


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with typed placeholders in place of personal information."""
    return pii.redact(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p3_percentiles, p3_combined, p6_containers, p7_found, p7_removal_spans, p8_found, p8_redacted)}
SQL: dict[str, str] = {}
