"""Batch jobs over stored tables give the same rows as the registered queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from floe.functions.grid import FIXTURE_GRID
from floe.plans import jobs
from floe.session import scratch_path
from floe.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _store(spark, df, name):
    p = scratch_path(spark, name)
    df.write.parquet(p)
    return p


def _rows(df, cols):
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_run_long_sparse_equals_query(spark):
    d = SF_SMALL
    paths = {n: _store(spark, f(spark, d), n) for n, f in
             [("static", fx.fx_static), ("alt", fx.fx_icesat), ("ocean", fx.fx_ocean), ("grace", fx.fx_grace)]}
    out = scratch_path(spark, "lsp")
    got = jobs.run_long_sparse(spark, paths["static"], paths["alt"], paths["ocean"], paths["grace"], out,
                               FIXTURE_GRID, sum_scale=2)
    want = E.queries()["b5_long_sparse"](spark, d)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert _rows(got, cols) == _rows(want, cols)


def test_run_mosaic_from_raw_coordinates(spark):
    d = SF_SMALL
    t = fx.fx_tiles(spark, d)
    tiles = {}
    for i in range(4):
        part = t.where(F.col("tile_order") == i).select(
            "time", "delta_h", "delta_h_sigma",
            (FIXTURE_GRID.x("ix") + F.lit(3.0 * i)).alias("x"), (FIXTURE_GRID.y("iy") - F.lit(2.0)).alias("y"))
        tiles[f"A{i + 1}"] = _store(spark, part, f"tile{i}")
    got = jobs.run_mosaic(spark, tiles, "delta_h_sigma", scratch_path(spark, "mosaic"), FIXTURE_GRID)
    want = E.queries()["m1_mosaic"](spark, d)
    cols = ["iy", "ix", "time", "delta_h", "delta_h_sigma", "tile_order"]
    assert _rows(got, cols) == _rows(want, cols)


def test_run_mosaics_lays_products_on_one_canvas(spark):
    """Each product by its own sigma, on the extent of all tiles; cells without a tile are rows with nulls; complete outputs stay."""
    g = FIXTURE_GRID
    day = dt.date(2020, 1, 1)

    def tile(cells, name):
        rows = [(g.x0 + g.res * ix + 3.0, g.y0 - g.res * iy - 2.0, day, v, s) for iy, ix, v, s in cells]
        return _store(spark, spark.createDataFrame(rows, f"x double, y double, time date, {name} double, {name}_sigma double"), "tile")
    products = {"a": ({"A1": tile([(0, 0, 1.0, 0.5), (0, 1, 2.0, 0.5)], "a"), "A2": tile([(0, 1, 9.0, 0.1)], "a")}, "a_sigma"),
                "b": ({"A1": tile([(2, 2, 7.0, None)], "b"), "A2": tile([(2, 2, 8.0, 0.3)], "b")}, "b_sigma")}
    out = {n: scratch_path(spark, n) for n in products}
    got = jobs.run_mosaics(spark, products, out, g)
    a = {(r.iy, r.ix): (r.a, r.x, r.y) for r in got["a"].collect()}
    assert len(a) == 9 and a[0, 0][0] == 1.0 and a[0, 1][0] == 9.0
    assert {k for k, v in a.items() if v[0] is None} == {(iy, ix) for iy in range(3) for ix in range(3)} - {(0, 0), (0, 1)}
    assert a[2, 2][1:] == (g.x0 + 2 * g.res, g.y0 - 2 * g.res)
    b = {(r.iy, r.ix): r.b for r in got["b"].collect()}
    assert len(b) == 9 and [k for k, v in b.items() if v is not None] == [(2, 2)] and b[2, 2] == 8.0
    before = {n: sorted(p.name for p in __import__("pathlib").Path(o.removeprefix("file:")).iterdir()) for n, o in out.items()}
    jobs.run_mosaics(spark, products, out, g)
    assert before == {n: sorted(p.name for p in __import__("pathlib").Path(o.removeprefix("file:")).iterdir()) for n, o in out.items()}


def test_run_thermodynamics_and_audit(spark):
    from floe.plans import q_io
    p = _store(spark, q_io.ocean_match(spark, SF_SMALL), "om")
    written, report = jobs.run_thermodynamics(spark, p, scratch_path(spark, "thermo"))
    assert written.schema["T_f"].metadata.get("units") == "degC"
    assert all(r.ok for r in report.collect())


def test_run_upsample_and_flatten(spark):
    d = SF_SMALL
    c = _store(spark, fx.fx_coarse(spark, d), "coarse")
    up = jobs.run_upsample(spark, c, "v", scratch_path(spark, "up"))
    want = E.queries()["b8_upsample"](spark, d)
    assert _rows(up, ["iy", "ix", "v"]) == _rows(want, ["iy", "ix", "v"])
    s = fx.fx_static(spark, d)
    topo = _store(spark, s.select("iy", "ix", "x", "y", "surface", "bed", "thickness", "mask"), "topo")
    masc = _store(spark, s.where(F.col("mascon_id").isNotNull()).select("iy", "ix", "mascon_id"), "masc")
    flat = jobs.run_flatten_static(spark, {"topo": topo, "mascons": masc}, scratch_path(spark, "flat"))
    assert flat.count() == s.where(F.col("mask").isin(1, 3)).count()


def test_run_features_equals_queries(spark):
    d = SF_SMALL
    s = _store(spark, fx.fx_static(spark, d), "static")
    a = _store(spark, fx.fx_icesat(spark, d), "alt")
    st, dyn = jobs.run_features(spark, s, a, scratch_path(spark, "fs"), scratch_path(spark, "fd"),
                                fx.grid_rows(spark, d), fx.NX)
    want_s = E.queries()["b9_features_static"](spark, d)
    want_d = E.queries()["b9_features_dynamic"](spark, d)
    cs = ["iy", "ix", "bed_slope", "dist_to_grounding_line"]
    cd = ["iy", "ix", "time", "h_surface_dynamic", "surface_slope"]
    assert _rows(st, cs) == _rows(want_s, cs)
    assert _rows(dyn, cd) == _rows(want_d, cd)


def test_run_flatten_dynamic_equals_altimetry_rows(spark):
    d = SF_SMALL
    s = _store(spark, fx.fx_static(spark, d), "static")
    a = _store(spark, fx.fx_icesat(spark, d).select("iy", "ix", "time", "delta_h", "ice_area"), "alt")
    got = jobs.run_flatten_dynamic(spark, {"alt": a}, s, "delta_h", scratch_path(spark, "flatdyn"))
    ice = fx.fx_static(spark, d).where(F.col("mask").isin(1, 3)).select("iy", "ix")
    want = fx.fx_icesat(spark, d).join(ice, ["iy", "ix"], "left_semi").where(F.col("delta_h").isNotNull())
    cols = ["iy", "ix", "time", "delta_h", "ice_area"]
    assert _rows(got, cols) == _rows(want, cols)


def test_run_anomaly_regrid_reuses_weights(spark):
    from floe.operators import regrid
    d = SF_SMALL
    nrows = fx.grid_rows(spark, d)
    dlat = 40.0 / nrows
    grid = fx.fx_source_ll(spark, d, nrows)
    g = _store(spark, grid.select("src_id", "si", "sj", "lat", "lon"), "sgrid")
    src = grid.select("src_id", F.lit(None).cast("date").alias("t0"), F.col("v").alias("lwe"))
    steps = [F.to_date(F.lit("2001-01-01")), F.to_date(F.lit("2001-04-01"))]
    src = src.withColumn("time", steps[0]).unionByName(
        src.withColumn("time", steps[1]).withColumn("lwe", F.col("lwe") * 10)).drop("t0")
    s = _store(spark, src, "src")
    t = _store(spark, fx.fx_target_xy(spark, d, nrows).select("dst_id", F.col("tx").alias("x"), F.col("ty").alias("y")), "tgt")
    wpath = scratch_path(spark, "weights")
    out, counters = jobs.run_anomaly_regrid(spark, s, g, t, wpath, scratch_path(spark, "regrid"),
                                            -90.0 + dlat / 2, dlat, -176.4, 7.2, nrows, fx.NX, lo=-5000.0, hi=12000.0)
    nn = E.queries()["j11_nearest_neighbour"](spark, d)
    want = {r.dst_id: r.v for r in nn.collect()}
    got0 = {r.dst_id: r.lwe for r in out.where(F.col("time") == steps[0]).collect()}
    assert got0 == {k: (v if v is not None and -5000 < v < 12000 else None) for k, v in want.items()}
    assert counters.count() == 2
    # weights are read, not rebuilt, on the next run
    called = []
    mark = regrid.grid_fingerprint("nearest", g, t, -90.0 + dlat / 2, dlat, -176.4, 7.2, nrows, fx.NX)
    regrid.weights_table(spark, wpath, lambda: called.append(1), mark)
    assert not called


def test_a_warning_does_not_stop_the_mosaic_and_an_error_does(spark):
    def store(dh, area):
        return _store(spark, spark.createDataFrame([(-3071750.0, 3071750.0, None, dh, 0.1, area)],
                                                   "x double, y double, time date, delta_h double, delta_h_sigma double, ice_area double"), "tile")
    from floe.functions.grid import FIXTURE_GRID
    out = scratch_path(spark, "warned")
    assert jobs.run_mosaic(spark, {"A1": store(900.0, 1.0)}, "delta_h_sigma", out, FIXTURE_GRID).count() == 1
    # a complete output is returned as it is, whatever the inputs say now
    assert jobs.run_mosaic(spark, {"A1": store(1.0, -1.0)}, "delta_h_sigma", out, FIXTURE_GRID).first().delta_h == 900.0
    with pytest.raises(ValueError, match="ice_area_non_negative"):
        jobs.run_mosaic(spark, {"A1": store(1.0, -1.0)}, "delta_h_sigma", scratch_path(spark, "failed"), FIXTURE_GRID)


def test_one_failing_product_does_not_stop_the_others(spark):
    good = _store(spark, fx.fx_coarse(spark, SF_SMALL), "coarse")
    said = jobs.run_upsample_products(spark, {"bad": (good + "-none", "v", scratch_path(spark, "p")), "good": (good, "v", scratch_path(spark, "p"))})
    assert said["good"] == "written" and said["bad"].startswith("FileNotFoundError")
    with pytest.raises(RuntimeError):
        jobs.run_upsample_products(spark, {"bad": (good + "-none", "v", "x")})
