"""Audits: every rule fails on data that break it, and only errors stop a job."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floe.operators import audit
from floe.sinks.writers import with_metadata

D = [dt.date(2000, 1, 1), dt.date(2000, 2, 1), dt.date(2000, 3, 1)]
TYPES = {"thetao": "double", "so": "double", "ice_draft": "double", "clamped_depth": "double", "mascon_id": "double", "dist_to_ocean": "double", "time": "date"}


def ok(report):
    return {r.check_name: r.ok for r in report.collect()}


def ocean(spark, change=lambda d: d, **kw):
    rows = [(iy, 0, t, 0.5, 34.0, -200.0, 300.0, 7.0, 1000.0 * iy) for iy in range(3) for t in D]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, thetao double, so double, ice_draft double, clamped_depth double, mascon_id double, dist_to_ocean double")
    pix = df.select("iy", "ix").distinct()
    df = with_metadata(change(df), {"thetao": {"units": "degC"}})
    args = {"types": TYPES, "shelf": pix, "grid": pix, "times": spark.createDataFrame([(t,) for t in D], "time date"), "max_depth": 500.0, "units": ("thetao",)} | kw
    return ok(audit.ocean_audit(df, **args))


def at(name, value, where="iy = 1"):
    """Changes one column at the second pixel (or where told)."""
    return lambda d: d.withColumn(name, F.when(F.expr(where), F.lit(value)).otherwise(F.col(name)))


def test_a_clean_ocean_table_passes(spark):
    assert all(ocean(spark).values())


@pytest.mark.parametrize("change,broken", [
    (at("dist_to_ocean", -1.0), {"dist_bounds"}),
    (at("dist_to_ocean", 1.5e6), {"dist_bounds"}),
    (at("clamped_depth", 501.5), {"depth_bounds"}),
    (at("clamped_depth", -0.5), {"depth_bounds"}),
    (at("ice_draft", -3001.0), {"draft_bounds"}),
    (at("thetao", 6.5), {"thetao_bounds"}),
    (at("so", 20.0), {"so_bounds"}),
    (at("mascon_id", 7.5), {"mascon_whole"}),
    (at("mascon_id", None), {"null_pattern_mascon_id"}),
    (at("ice_draft", None), {"null_pattern_ice_draft"}),
    (at("clamped_depth", None), {"null_pattern_clamped_depth"}),
    (at("so", None), {"null_pattern_pair"}),
    (at("so", float("nan")), {"nan_values", "so_bounds"}),
    (at("thetao", None, "iy = 1 AND time = DATE'2000-02-01'"), {"null_pattern_pair", "shelf_pixels_with_time_gaps"}),
    (lambda d: d.where((F.col("iy") != 1) | (F.col("time") != D[1])), {"shelf_pixels_with_time_gaps"}),
    (lambda d: d.where("iy <> 1"), {"grid_pixels_lacking", "shelf_without_data", "shelf_pixels_with_time_gaps"}),
    (lambda d: d.unionByName(d.where("iy = 1").withColumn("iy", F.lit(9))), {"pixels_not_in_grid", "data_outside_shelf"}),
    (lambda d: d.where(F.col("time") != D[0]), {"time_differs"}),
    (lambda d: d.withColumn("thetao", F.when(F.col("time") != D[0], F.col("thetao"))), {"null_pattern_pair", "min_valid_per_step", "shelf_pixels_with_time_gaps"}),
    (lambda d: d.withColumn("so", F.col("so").cast("float")), {"column_types"}),
])
def test_each_fault_breaks_its_rules(spark, change, broken):
    assert {n for n, x in ocean(spark, change).items() if not x} == broken


def test_schema_faults(spark):
    assert ocean(spark, lambda d: d.drop("so")) == {"required_columns": False}
    assert not ocean(spark, units=("thetao", "so"))["units_missing"]


def test_anomaly_audit_rules_fail(spark):
    good = spark.createDataFrame([(m, t, float(m + i)) for m in (1, 2) for i, t in enumerate(D)], "mascon_id int, time date, lwe double")
    assert all(ok(audit.anomaly_audit(good, ["mascon_id", "time"], "lwe")).values())
    bad = good.withColumn("lwe", F.when(F.col("mascon_id") == 1, 5.0).otherwise(F.col("lwe") * 1000)).unionByName(
        good.withColumn("time", F.date_add("time", 400))).unionByName(good.where("mascon_id = 1").limit(1))
    failed = {n for n, x in ok(audit.anomaly_audit(bad, ["mascon_id", "time"], "lwe")).items() if not x}
    assert failed >= {"keys_unique", "within_typical", "large_time_gaps", "max_gap_days", "max_temporal_std"}
    flat = good.withColumn("lwe", F.lit(1.0))
    assert not ok(audit.anomaly_audit(flat, ["mascon_id", "time"], "lwe"))["regions_vary"]
    sparse = good.withColumn("lwe", F.lit(None).cast("double"))
    assert not ok(audit.anomaly_audit(sparse, ["mascon_id", "time"], "lwe"))["coverage_pct"]


def test_merge_rules_fail(spark):
    rows = [(iy, ix, D[0], 500.0 * ix, -500.0 * iy, 1.0) for iy in range(3) for ix in range(3)]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, x double, y double, v double")
    assert all(ok(audit.merge_validation(df, "v", 9)).values())
    bad = lambda c, e: {n for n, x in ok(audit.merge_validation(df.withColumn(c, e), "v", 9)).items() if not x}
    assert bad("y", F.col("y") * -1) == {"y_monotonic"}
    assert bad("x", F.col("x") * -1) == {"x_monotonic"}
    assert "x_single" in bad("x", F.col("x") + F.col("iy")) and "y_single" in bad("y", F.col("y") + F.col("ix"))
    assert bad("iy", F.lit(0)) >= {"unique_keys", "y_single"}
    assert bad("v", F.lit(None).cast("double")) == {"coverage_first_pct"}


def test_only_errors_stop(spark):
    rows = spark.createDataFrame([(900.0, 1.0)], "dh double, ice_area double")
    audit.assert_ok(audit.physics(rows, ["dh"]))  # a warning
    with pytest.raises(ValueError, match="ice_area_non_negative"):
        audit.assert_ok(audit.physics(rows.withColumn("ice_area", F.lit(-1.0)), ["dh"]))


def gridded(spark, change=lambda d: d):
    """20 x 20 cells, 3 monthly steps; every rule holds."""
    rows = [(iy, ix, 500.0 * ix, -500.0 * iy, t, float(iy + ix + i)) for iy in range(20) for ix in range(20) for i, t in enumerate(D)]
    df = spark.createDataFrame(rows, "iy int, ix int, x double, y double, time date, lwe double")
    grid = df.select("iy", "ix", "x", "y").distinct()
    return ok(audit.gridded_anomaly_audit(change(df), grid, "lwe", 20, 20, every=1, every_cell=10))


def test_a_clean_gridded_table_passes(spark):
    got = gridded(spark)
    assert len(got) == 29 and all(got.values())


@pytest.mark.parametrize("change,broken", [
    (lambda d: d.where("iy <> 3"), {"rows_match"}),
    (lambda d: d.where("ix <> 3"), {"columns_match"}),
    (at("x", 999.0, "ix = 1 AND iy = 5"), {"x_matches"}),
    (at("y", 999.0, "ix = 1 AND time = DATE'2000-02-01' AND iy = 5"), {"y_matches"}),
    (lambda d: d.unionByName(d.where("iy = 2 AND ix = 2").limit(1)), {"keys_unique"}),
    (at("lwe", None, "time = DATE'2000-01-01'"), {"first_step_pct"}),
    (at("lwe", None, "time = DATE'2000-02-01'"), {"middle_step_pct"}),
    (at("lwe", None, "time = DATE'2000-03-01'"), {"last_step_pct"}),
    (at("lwe", None, "iy % 10 = 0 AND ix % 10 = 0"), {"sample_size", *(f"sample_{c}" for c in ("min", "max", "mean", "median", "std"))}),
    (at("lwe", 5000.0, "iy = 10 AND ix = 10 AND time = DATE'2000-02-01'"), {"sample_max", "sample_mean", "sample_std", "quadrant_SE_std"} - {"quadrant_SE_std"}),
    (at("lwe", -900.0, "iy = 0 AND ix = 0"), {"sample_min", "sample_mean", "sample_std"}),
    (lambda d: d.withColumn("time", F.when(F.col("time") == D[2], F.date_add("time", 100)).otherwise(F.col("time"))), {"large_time_gaps", "max_gap_days"}),
    (at("lwe", None, "iy < 10 AND ix >= 10"), {"quadrant_NE_pixels", "quadrant_NE_mean", "quadrant_NE_std"}),
    (at("lwe", 1000.0, "iy >= 10 AND ix < 9 AND ix > 0 AND iy <> 10"), {"quadrant_SW_mean", "quadrant_SW_std"}),
])
def test_each_gridded_fault_breaks_its_rules(spark, change, broken):
    assert {n for n, x in gridded(spark, change).items() if not x} == broken


def test_steps_of_less_than_a_day(spark):
    from pyspark.sql.types import TimestampNTZType
    hours = lambda d: d.withColumn("time", (F.col("time").cast(TimestampNTZType()))).withColumn(
        "time", F.when(F.month("time") == 2, F.expr("timestamp_ntz'2000-01-01 05:00:00'")).otherwise(F.col("time")))
    assert {n for n, x in gridded(spark, hours).items() if not x} >= {"min_gap_days"}
