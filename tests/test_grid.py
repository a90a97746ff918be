"""Regridding and stencils against brute-force NumPy references on small grids."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.operators import regrid, stencil


def _nodes(spark, arr):
    rows = [(int(cy), int(cx), None if np.isnan(arr[cy, cx]) else float(arr[cy, cx]))
            for cy in range(arr.shape[0]) for cx in range(arr.shape[1])]
    return spark.createDataFrame(rows, "cy int, cx int, v double")


def test_bilinear_reproduces_a_plane_and_nulls(spark):
    ny, nx = 5, 6
    yy, xx = np.mgrid[0:ny, 0:nx]
    arr = 2.0 + 0.5 * xx - 1.25 * yy
    arr[4, 5] = np.nan
    nodes = _nodes(spark, arr)
    pts = [(i, fy, fx) for i, (fy, fx) in enumerate([(0.25, 0.75), (1.5, 2.5), (3.25, 3.5), (3.5, 4.5), (4.5, 1.0), (0.0, 0.0)])]
    t = spark.createDataFrame(pts, "tid int, fy double, fx double")
    got = {r.tid: r.v for r in regrid.bilinear(nodes, t, ["tid"]).collect()}
    for tid, fy, fx in pts[:3]:
        assert abs(got[tid] - (2.0 + 0.5 * fx - 1.25 * fy)) < 1e-12
    assert got[3] is None      # corner (4,5) missing
    assert got[4] is None      # outside the lattice
    assert abs(got[5] - 2.0) < 1e-12


def test_weights_apply_equals_bilinear(spark):
    rng = np.random.default_rng(1)
    arr = rng.normal(size=(4, 4))
    nodes = _nodes(spark, arr)
    pts = [(i, float(fy), float(fx)) for i, (fy, fx) in enumerate(rng.uniform(0, 2.99, size=(20, 2)))]
    t = spark.createDataFrame(pts, "dst_id int, fy double, fx double")
    w = regrid.bilinear_weights(t, "dst_id", "fy", "fx", lambda sy, sx: sy * 100 + sx)
    src = nodes.select((F.col("cy") * 100 + F.col("cx")).alias("src_id"), "v")
    a = {r.dst_id: r.v for r in regrid.apply_weights(src, w).collect()}
    b = {r.dst_id: r.v for r in regrid.bilinear(nodes, t, ["dst_id"]).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


@pytest.mark.parametrize("kept,ids", [(0.85, "ascending"), (1.0, "ascending"), (0.3, "ascending"), (0.85, "shuffled")])
def test_nearest_equals_brute_force_with_holes(spark, kept, ids):
    """Full, holed and nearly empty lattices, ids that don't follow the lattice; at the pole, the date line and on exact ties."""
    rng = np.random.default_rng(7)
    n_lat, n_lon, lat0, dlat, lon0, dlon = 12, 20, -89.0, 2.0, -171.0, 18.0
    number = rng.permutation(n_lat * n_lon) if ids == "shuffled" else np.arange(n_lat * n_lon) + 5
    src = [(int(number[i * n_lon + j]), i, j, lat0 + i * dlat, lon0 + j * dlon, float(rng.normal()))
           for i in range(n_lat) for j in range(n_lon) if rng.uniform() <= kept]
    tgt = [(k, float(rng.uniform(-90, -65)), float(rng.uniform(-180, 180))) for k in range(150)]
    tgt += [(200 + k, la, lo) for k, (la, lo) in enumerate((la, lo) for la in (-90.0, -89.99, -88.0, -70.0, -60.0) for lo in (-180.0, 179.999, 180.0, -171.0, 0.0, 171.0))]
    s = spark.createDataFrame(src, "src_id int, si int, sj int, lat double, lon double, v double")
    t = spark.createDataFrame(tgt, "dst_id int, lat double, lon double")
    got = {r.dst_id: r.src_id for r in regrid.nearest_regular(s, t, lat0, dlat, lon0, dlon, n_lat, n_lon).collect()}

    def unit(lat, lon):
        la, lo = math.radians(lat), math.radians(lon)
        return np.array([math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)])
    S = np.array([unit(r[3], r[4]) for r in src])
    for k, la, lo in tgt:
        d = ((S - unit(la, lo)) ** 2).sum(axis=1)
        best = min(range(len(src)), key=lambda i: (d[i], src[i][0]))
        assert got[k] == src[best][0]


@pytest.mark.parametrize("kept", [1.0, 0.95])
def test_nearest_on_axes_too_long_for_a_plan(spark, monkeypatch, kept):
    """Long axes give the rows of the short ones, ties, pole, holes, repeated and null targets included, and no search by windows on a whole lattice."""
    n_lat, n_lon, lat0, dlat, lon0, dlon = 40, 20, -89.5, 1.0, -171.0, 18.0
    rng = np.random.default_rng(9)
    src = [(i * n_lon + j, i, j, lat0 + i * dlat, lon0 + j * dlon, float(i)) for i in range(n_lat) for j in range(n_lon) if rng.uniform() <= kept]
    tgt = [(k, float(rng.uniform(-90, -52)), float(rng.uniform(-180, 180))) for k in range(120)]
    tgt += [(200 + k, la, lo) for k, (la, lo) in enumerate((la, lo) for la in (-90.0, -89.0, -70.0) for lo in (-180.0, 180.0, -162.0, 0.0, 171.0))]
    tgt += [(7, -90.0, 0.0), (7, -90.0, 0.0), (None, -60.2, 3.0)] + ([(8, None, None)] if kept == 1.0 else [])
    s = spark.createDataFrame(src, "src_id int, si int, sj int, lat double, lon double, v double")
    t = spark.createDataFrame(tgt, "dst_id int, lat double, lon double")

    def rows():
        return sorted(map(tuple, regrid.nearest_regular(s, t, lat0, dlat, lon0, dlon, n_lat, n_lon).collect()), key=str)
    want = rows()
    monkeypatch.setattr(regrid, "MAX_AXES", 10)
    if kept == 1.0:
        monkeypatch.setattr(regrid, "nearest_by_windows", lambda *a, **k: pytest.fail("a whole lattice needs no windows"))
    assert rows() == want and len(want) == len(tgt)


def test_nearest_cell_needs_no_shuffle(spark):
    src = spark.range(240).select(F.col("id").cast("int").alias("src_id"), (F.col("id") / 20).cast("int").alias("si"), (F.col("id") % 20).cast("int").alias("sj"))
    src = src.select("*", (F.lit(-89.0) + F.col("si") * 2.0).alias("lat"), (F.lit(-171.0) + F.col("sj") * 18.0).alias("lon"), F.lit(1.0).alias("v"))
    t = spark.range(500).select(F.col("id").alias("dst_id"), (F.lit(-90.0) + F.col("id") * 0.04).alias("lat"), (F.col("id") % 360 - 180).cast("double").alias("lon"))
    axes = regrid.lattice_axes(src, -89.0, 2.0, -171.0, 18.0, 12, 20)
    assert axes.full
    plan = regrid.nearest_regular(src, t, -89.0, 2.0, -171.0, 18.0, 12, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and "Generate" not in plan and "Python" not in plan


def test_slope_equals_numpy_gradient_with_edge_padding(spark):
    rng = np.random.default_rng(3)
    ny, nx = 7, 9
    arr = rng.normal(size=(ny, nx)) * 100
    rows = [(i, j, float(arr[i, j])) for i in range(ny) for j in range(nx)]
    df = spark.createDataFrame(rows, "iy int, ix int, v double")
    got = {(r.iy, r.ix): r.slope for r in stencil.slope(df, "v", ny, nx).collect()}
    pad = np.pad(arr, 1, mode="edge")
    gy, gx = np.gradient(pad, 500.0, 500.0)
    ref = np.sqrt(gx ** 2 + gy ** 2)[1:-1, 1:-1].astype(np.float32)
    for (i, j), v in got.items():
        assert abs(v - ref[i, j]) <= 1e-6 * max(1.0, abs(ref[i, j]))


def test_slope_missing_interior_neighbour_is_null(spark):
    rows = [(i, j, float(i + j)) for i in range(3) for j in range(3) if (i, j) != (1, 2)]
    df = spark.createDataFrame(rows, "iy int, ix int, v double")
    got = {(r.iy, r.ix): r.slope for r in stencil.slope(df, "v", 3, 3).collect()}
    assert got[(1, 1)] is None          # right neighbour absent inside the grid
    assert got[(0, 0)] is not None      # border cell: edge replicate


def test_distance_transform_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    for trial in range(4):
        ny, nx = 9, 13
        mask = rng.uniform(size=(ny, nx)) < (0.08 if trial else 0.0)
        present = rng.uniform(size=(ny, nx)) < 0.85
        rows = [(i, j, bool(mask[i, j])) for i in range(ny) for j in range(nx) if present[i, j] or mask[i, j]]
        df = spark.createDataFrame(rows, "iy int, ix int, g boolean")
        got = {(r.iy, r.ix): r.dist for r in stencil.distance_to_sources(df, F.col("g"), ny).collect()}
        src = [(i, j) for i in range(ny) for j in range(nx) if mask[i, j]]
        for (i, j, g) in rows:
            if not src:
                assert got[(i, j)] is None
                continue
            d2 = min((i - a) ** 2 + (j - b) ** 2 for a, b in src)
            assert got[(i, j)] == np.float32(math.sqrt(d2) * 500.0)


def test_slope_with_small_tiles_equals_numpy(spark):
    """Halo copies across many small tiles give the same slopes as one tile."""
    rng = np.random.default_rng(5)
    ny, nx = 11, 13
    arr = rng.normal(size=(ny, nx)) * 50
    rows = [(i, j, float(arr[i, j])) for i in range(ny) for j in range(nx) if (i, j) != (5, 6)]
    df = spark.createDataFrame(rows, "iy int, ix int, v double")
    small = {(r.iy, r.ix): r.slope for r in stencil.slope(df, "v", ny, nx, block=3).collect()}
    big = {(r.iy, r.ix): r.slope for r in stencil.slope(df, "v", ny, nx, block=2048).collect()}
    assert small == big and len(small) == len(rows)
    pad = np.pad(arr, 1, mode="edge")
    gy, gx = np.gradient(pad, 500.0, 500.0)
    ref = np.sqrt(gx ** 2 + gy ** 2)[1:-1, 1:-1].astype(np.float32)
    near_hole = {(5, 5), (5, 7), (4, 6), (6, 6)}
    for (i, j), val in small.items():
        if (i, j) in near_hole:
            assert val is None
        else:
            assert abs(val - ref[i, j]) <= 1e-6 * max(1.0, abs(ref[i, j]))
