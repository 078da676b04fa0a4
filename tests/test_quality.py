import datetime as dt

import pytest
from pyspark.sql import functions as F

from dusklark.config import Config, iso_date, load_config
from dusklark.operators import episodes as E
from dusklark.operators import quality as Q

RAW = "row_id long, date date, hour_of_day long, sku_id long, fc string, inventory double, discount double, units_sold long, normal_asp double, final_price double, cogs_wo_vat double, ending_inventory double, hours_remaining double, category string, subcategory string, loaded_at timestamp, leaves string, episode string"
NAMES = [x.split()[0] for x in RAW.split(", ")]


def clean(skus=6, hours=6):
    rows = []
    for s in range(skus):
        for k in range(hours):
            last = k == hours - 1
            rows.append(dict(row_id=len(rows), date=dt.date(2026, 3, 2 + s), hour_of_day=10 + k, sku_id=s, fc="AA1", inventory=10.0 - k, discount=20.0, units_sold=1, normal_asp=1000.0, final_price=800.0,
                             cogs_wo_vat=500.0, ending_inventory=0.0 if last else 9.0 - k, hours_remaining=float(hours - 1 - k), category="DAIRY", subcategory="CREAM", loaded_at=None, leaves="x", episode="y"))
    return rows


def run(spark, rows, cfg=Config()):
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], RAW)
    return {r["stage"]: (r["rows"], r["episodes"], r["exposure"]) for r in Q.waterfall(df, cfg).collect()}


@pytest.fixture(scope="module")
def base(spark):
    return run(spark, clean())


def test_clean_rows_pass_every_stage(base):
    assert list(base) == Q.STAGES
    assert set(base.values()) == {(36, 6, 6 * 10 * 500.0)}


@pytest.mark.parametrize("column,value,row,stage", [
    ("date", dt.date(2026, 5, 1), None, "exclusion_window_removed"),
    ("discount", 140.0, 8, "discount_out_of_range_dropped"),
    ("discount", None, 8, "discount_out_of_range_dropped"),
    ("units_sold", -1, 8, "negative_quantities_dropped"),
    ("cogs_wo_vat", 0.0, 8, "negative_quantities_dropped"),
    ("hours_remaining", 500.0, None, "window_too_long_dropped"),
    ("discount", 60.0, 8, "below_cost_dropped"),
    ("cogs_wo_vat", 1000.0, None, "below_cost_dropped"),
    ("ending_inventory", 3.0, 8, "chain_break_dropped"),
])
def test_one_fault_removes_one_episode_at_its_stage(spark, column, value, row, stage):
    rows = clean()
    for i, r in enumerate(rows):
        if i == row or row is None and r["sku_id"] == 1:
            r[column] = value + r["hours_remaining"] if column == "hours_remaining" else value
    out = run(spark, rows)
    at = Q.STAGES.index(stage)
    assert out[Q.STAGES[at - 1]][:2] == (36, 6)
    assert out[stage][:2] == (30, 5)
    assert out[Q.STAGES[-1]][:2] == (30, 5)


def test_repeated_hours_lose_every_copy(spark):
    rows = clean()
    rows.append(dict(rows[8]))
    out = run(spark, rows)
    assert out["raw"][0] == 37 and out["duplicate_hour_rows_dropped"][:2] == (35, 7)


def test_null_category_price_fill_and_recovery(spark):
    rows = clean()
    rows[0]["category"] = None
    rows[6]["normal_asp"] = 0.0
    for r in rows:
        if r["sku_id"] == 2:
            r["hours_remaining"] -= 50
    out = run(spark, rows)
    assert out["null_category_dropped"][0] == 35 and out["null_category_dropped"][2] == 5 * 5000.0 + 9 * 500.0
    assert out["zero_base_price_dropped"][0] == 35
    assert out["negative_window_dropped"][0] == 35


def test_edge_truncation_needs_the_write_off_mark(spark):
    rows = clean()
    rows[-1]["ending_inventory"] = 4.0  # the last hour of the extract, stock left, not zeroed
    assert run(spark, rows)["edge_truncated_episodes_dropped"][:2] == (30, 5)
    assert run(spark, rows, Config(drop_edge_truncated=False)).get("edge_truncated_episodes_dropped") is None
    for r in rows:
        if r["hours_remaining"] == 0:
            r["ending_inventory"] = 4.0
    assert run(spark, rows)["edge_truncated_episodes_dropped"][:2] == (36, 6)


def test_empty_and_unplaceable_rows(spark):
    assert run(spark, [])["raw"] == (0, 0, 0.0)
    rows = clean(1)
    rows[0]["sku_id"] = rows[1]["fc"] = rows[2]["hour_of_day"] = None
    assert run(spark, rows)["duplicate_hour_rows_dropped"][0] == 3


def test_partitioning_does_not_matter(spark, base):
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in clean()], RAW).repartition(7, F.rand(1))
    assert {r["stage"]: (r["rows"], r["episodes"], r["exposure"]) for r in Q.waterfall(df, Config()).collect()} == base


def frame(spark, rows):
    return spark.createDataFrame([(e, dt.date(2026, 8, 3), h, hr, s, u, z) for e, h, hr, s, u, z in rows], "episode_id string, date date, hour_of_day long, hours_remaining double, starting_inventory long, units_sold long, ending_inventory long")


FINAL = [("a", 10, 4.0, 7, 0, 0), ("b", 10, 28.0, 9, 4, 0), ("c", 10, 4.0, 5, 5, 0), ("d", 10, 6.0, 9, 4, 5), (None, 10, 1.0, 1, 1, 1)]


def test_endings_and_scrap(spark):
    got = {r["episode_id"]: (r["ending"], r["scrap_units"]) for r in E.endings(frame(spark, FINAL), ["episode_id"]).collect()}
    assert got == {"a": ("completed", 7), "b": ("completed", 5), "c": ("sold_out", 0), "d": ("not_closed", None)}
    honest = E.endings(frame(spark, [("d", 10, 6.0, 9, 4, 5)]), ["episode_id"]).collect()
    assert [(r["ending"], r["scrap_units"]) for r in honest] == [("completed", 5)]


def test_extension_runs_the_countdown_out(spark):
    rows = [("a", 22 + k, 7.0 - k, 5 - k, 1, 4 - k) for k in range(2)] + [("b", 5, 0.0, 1, 0, 1), ("c", 5, None, 1, 0, 1)]
    x = E.extended(frame(spark, rows), ["episode_id"], [], 120)
    made = x.filter("NOT is_observed").orderBy("date", "hour_of_day").collect()
    assert [(r["hour_of_day"], r["hours_remaining"], r["starting_inventory"], r["units_sold"]) for r in made] == [(k, 5.0 - k, 3, 0) for k in range(6)]
    assert made[0]["date"] == dt.date(2026, 8, 4)
    # a wrong counter adds nothing and is listed instead
    assert E.extended(frame(spark, rows), ["episode_id"], [], 3).filter("NOT is_observed").count() == 0
    assert E.overlong(frame(spark, rows), ["episode_id"], 3).count() == 1 and E.overlong(frame(spark, rows), ["episode_id"], 120).count() == 0


def test_inventory_breaks(spark):
    df = spark.createDataFrame([(9, 4, 5), (9, 4, 6), (9, 4, 0), (9, 4, 3), (4, 9, 0), (None, 1, 1)], "s long, u long, e long")
    assert [r[0] for r in df.select(E.inventory_break(F.col("s"), F.col("u"), F.col("e"))).collect()] == [None, "intraday_restock", "episode_close_write_off", None, None, None]


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("max_window_hours: 60\nexclusion_start: 2026-04-20\n")
    assert load_config(str(p)).max_window_hours == 60
    p.write_text("max_windw: 1\n")
    with pytest.raises(ValueError):
        load_config(str(p))
    assert load_config(str(p), strict=False) == Config()
    for bad in ("2026-1-2", "2026-02-30", "x' OR 1=1"):
        with pytest.raises(ValueError):
            iso_date(bad, "d")
    with pytest.raises(ValueError):
        Config(train_start="2026-01-01", train_end="2025-01-01")


def test_stages_are_given_what_they_took(spark):
    w = spark.createDataFrame([(1, "b", 9, 4, 150.0), (0, "a", 10, 4, 200.0), (3, "d", 2, 1, 30.0), (2, "c", 9, 6, 170.0)], "stage_no int, stage string, rows long, episodes long, exposure double")
    columns = ["rows_dropped", "episodes_dropped", "exposure_dropped", "share_dropped", "share_left"]
    got = [tuple(r) for r in Q.stage_costs(w).orderBy("stage_no").select(*columns).collect()]
    assert got == [(None, None, None, None, 1.0), (1, 0, 50.0, 0.25, 0.75), (0, -2, -20.0, -0.1, 0.85), (7, 5, 140.0, 0.7, 0.15)]
    assert [r["share_dropped"] for r in Q.stage_costs(w.withColumn("exposure", F.lit(0.0))).collect()] == [None] * 4
