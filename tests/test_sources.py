import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from dusklark.config import Config
from dusklark.functions.text import code, identifier, instant, label
from dusklark.operators import quality
from dusklark.operators.events import outcome_problems
from dusklark.operators.once import OnceStore
from dusklark.schema import outcome_schema, raw_schema
from dusklark.session import CHECKPOINT_KEY, scratch, shared_dir
from dusklark.sources import files, synthetic
from dusklark.streaming.ingest import ingest_stream


def test_spellings(spark):
    df = spark.createDataFrame([(" aB\t",), (" x　",), (" ",), (None,)], "s string")
    assert [r[0] for r in df.select(identifier(F.col("s"))).collect()] == ["ab", "x", None, None]
    assert [r[0] for r in df.select(code(F.col("s"))).collect()] == ["AB", "X", None, None]
    assert spark.createDataFrame([("red__ Meat ",)], "s string").select(label(F.col("s"))).first()[0] == "RED MEAT"
    t = spark.createDataFrame([("2026-08-01T10:00:00+09:00",), ("2026-08-01 01:00:00",), ("2026-08-01T01:00:00.000Z",), ("later",), (None,)], "s string")
    got = [r[0] for r in t.select(instant(F.col("s"))).collect()]
    assert got[0] == got[1] == got[2] is not None and got[3] is got[4] is None


def test_json_lines_keep_bad_lines_apart(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"outcome_id": "a", "units_sold": 1}\nnot json\n{"outcome_id": "b", "units_sold": "x"}\n')
    good, bad = files.scan_json_lines(spark, str(tmp_path), outcome_schema())
    assert [r["outcome_id"] for r in good.collect()] == ["a"] and bad.count() == 2


def test_missing_column_fails_at_once(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="lacks"):
        files.scan_parquet(spark, str(tmp_path / "t"), raw_schema())


def test_extract_sql_is_guarded():
    assert "NOT (date BETWEEN DATE '2026-04-25'" in files.extract_sql("s.t", "2026-03-01", "2026-03-31", ("2026-04-25", "2026-06-03"))
    for args in (("t; DROP", "2026-03-01", "2026-03-31"), ("t", "2026-03-01'", "2026-03-31")):
        with pytest.raises(ValueError):
            files.extract_sql(*args)


def test_report_is_replaced_whole_and_bounded(spark, tmp_path):
    path = "file://" + str(tmp_path / "r.json")
    files.write_report(spark, spark.range(2), path)
    files.write_report(spark, spark.range(3), path)
    assert json.loads((tmp_path / "r.json").read_text()) == [{"id": 0}, {"id": 1}, {"id": 2}]
    with pytest.raises(ValueError):
        files.write_report(spark, spark.range(5), path, limit=4)


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["scan_extract"](spark, entry.SF_SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "cogs_wo_vat" not in plan.split("ReadSchema")[1]


def test_made_up_rows_are_the_same_for_any_partitioning(spark):
    a = synthetic.hourly_rows(spark, 20, 5)
    assert sorted(map(str, a.collect())) == sorted(map(str, synthetic.hourly_rows(spark, 20, 5).repartition(9).collect()))
    w = quality.waterfall(a.withColumn("row_id", F.lit(1)), Config()).collect()
    assert w[0]["rows"] > w[-1]["rows"] > 0


def test_shared_folder_is_the_clusters(spark):
    root = shared_dir(spark)
    assert spark.conf.get(CHECKPOINT_KEY) == root and scratch(spark, "x").startswith(root)


def test_stream_into_the_store(spark, tmp_path):
    schema = outcome_schema()
    rows = [
        dict(delivery_id=1, batch_id="b", received_at=None, outcome_id="A", decision_id="d", units_sold=1, starting_inventory=2, ending_inventory=1, applied_price=1.0, is_stockout=False, execution_status="ok", finalized_at="2026-01-01", adjustment_reason=None, execution_failure_reason=None),
        dict(delivery_id=2, batch_id="b", received_at=None, outcome_id=" a", decision_id="d", units_sold=1, starting_inventory=2, ending_inventory=1, applied_price=1.0, is_stockout=False, execution_status="ok", finalized_at="2026-01-02", adjustment_reason=None, execution_failure_reason=None),
        dict(delivery_id=3, batch_id="b", received_at=None, outcome_id="c", decision_id="d", units_sold=-1, starting_inventory=2, ending_inventory=1, applied_price=1.0, is_stockout=False, execution_status="ok", finalized_at="2026-01-02", adjustment_reason=None, execution_failure_reason=None),
    ]
    spark.createDataFrame(rows, schema).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    store = OnceStore(spark, scratch(spark, "stream"), "outcome_id", "delivery_id", "received_at", [instant(F.col("finalized_at"))])
    for _ in range(2):  # the second run finds nothing new
        ingest_stream(stream, store, outcome_problems(), str(tmp_path / "q"), str(tmp_path / "cp")).awaitTermination(120)
    assert [r["delivery_id"] for r in store.current().collect()] == [1]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)


def test_workers_find_the_package(spark):
    from dusklark.session import importable

    importable(spark)
    importable(spark)
    paths = spark.sparkContext.environment["PYTHONPATH"].split(":")
    assert len(paths) == len(set(paths)) and any(p and __import__("os").path.isdir(f"{p}/dusklark") for p in paths)
