"""Batch jobs over stored tables: the entry points a user runs (paths in, tables out).

Each job checks its inputs first (S7, all missing paths reported at once),
reads with NaN -> NULL and time sanitising (S1, S8), builds the plan from the
operators and writes with the tiled layout (K11) or per-step folders (K2).
Outputs go to new paths; nothing is written over its own input (K6).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.functions import thermo
from floe.functions.grid import Grid
from floe.functions.timefn import days_to_timestamp
from floe.operators import audit, joins, mosaic, regrid, select, stencil
from floe.plans import lsp
from floe.session import materialize
from floe.sinks import writers
from floe.sources import readers


def _read(spark: SparkSession, path: str) -> DataFrame:
    return readers.sanitize_time(readers.read_table(spark, path), "time")


def run_long_sparse(spark: SparkSession, static: str, altimetry: str, ocean: str, anomaly: str,
                    out: str, grid: Grid, sum_scale: int | None = None) -> DataFrame:
    """Flat static/altimetry/ocean/anomaly tables -> the long sparse table at ``out``."""
    readers.validate_inputs(spark, [static, altimetry, ocean, anomaly])
    st, alt, oc, an = (_read(spark, p) for p in (static, altimetry, ocean, anomaly))
    lsp_df = lsp.build_long_sparse(alt, oc, st, an, grid, sum_scale=sum_scale)
    writers.write_layout(lsp_df, out, keys=("time",))
    return spark.read.parquet(out)


def run_flatten_static(spark: SparkSession, sources: dict[str, str], out: str) -> DataFrame:
    """B1: align static layers by pixel (J4), keep ice (P5), write; returns the table."""
    readers.validate_inputs(spark, list(sources.values()))
    frames = [_read(spark, p) for p in sources.values()]
    flat = select.keep_codes(joins.outer_align(frames, ["iy", "ix"]))
    writers.write_layout(flat, out, keys=())
    return spark.read.parquet(out)


def run_flatten_dynamic(spark: SparkSession, sources: dict[str, str], static: str, value: str, out: str) -> DataFrame:
    """Align dynamic layers (J5), keep ice pixels (J7), drop rows without ``value`` (P7), per-step folders (K2)."""
    readers.validate_inputs(spark, [*sources.values(), static])
    frames = [_read(spark, p) for p in sources.values()]
    aligned = joins.outer_align(frames, ["iy", "ix", "time"], partition_by=["iy", "ix"])
    ice = select.keep_codes(_read(spark, static)).select("iy", "ix")
    rows = select.drop_null(joins.mask_semi(aligned, ice, ["iy", "ix"]), value)
    writers.write_steps(rows, out, "time")
    return spark.read.parquet(out)


def run_mosaic(spark: SparkSession, tiles: dict[str, str], sigma: str, out: str, grid: Grid) -> DataFrame:
    """Snap tile coordinates to the grid (F1), lowest-sigma mosaic (M1), physics gate (V1), write if absent (K5).

    Nothing is computed when a complete output exists; else the mosaic is computed once, audited
    (warnings don't stop the job) and written.
    """
    readers.validate_inputs(spark, list(tiles.values()))

    def build():
        frames = {}
        for tid, p in tiles.items():
            t = _read(spark, p)
            frames[tid] = t.withColumns({"iy": grid.iy("y"), "ix": grid.ix("x")}).drop("x", "y")
        m = materialize(mosaic.mosaic(mosaic.union_tiles(frames, list(tiles)).drop("tile_id"), sigma), "mosaic")
        values = [c for c in m.columns if c not in ("iy", "ix", "time", "tile_order") and "sigma" not in c
                  and "ice_area" not in c]
        audit.assert_ok(audit.physics(m, values, area="ice_area" if "ice_area" in m.columns else None))
        return m.withColumns({"x": grid.x("ix"), "y": grid.y("iy")})
    writers.write_if_absent(build, out, spark=spark)
    return spark.read.parquet(out)


def run_mosaics(spark: SparkSession, products: dict[str, tuple[dict[str, str], str]], out: dict[str, str], grid: Grid) -> dict[str, DataFrame]:
    """B7, whole: ``products`` are ``{product: ({tile: path}, sigma column)}``, each with its own sigma.

    The canvas is the extent of the snapped tiles of all products (S6, F1). Each product is mosaicked (M1), audited (V1),
    laid on the canvas (J8: uncovered cells are rows with nulls) and written unless a complete output is
    there (K5); the canvas is measured only if some product has to be built.
    """
    readers.validate_inputs(spark, [p for tiles, _ in products.values() for p in tiles.values()])

    def snapped(path):
        t = _read(spark, path)
        return t.withColumns({"iy": grid.iy("y"), "ix": grid.ix("x")}).drop("x", "y")
    extent = []

    def canvas():
        if not extent:
            cells = [snapped(p).select("iy", "ix") for tiles, _ in products.values() for p in tiles.values()]
            extent.append(readers.canvas_from_extent(reduce(lambda a, b: a.unionByName(b), cells)))
        return extent[0]

    def build(tiles, sigma):
        m = materialize(mosaic.mosaic(mosaic.union_tiles({t: snapped(p) for t, p in tiles.items()}, list(tiles)).drop("tile_id"), sigma), "mosaic")
        values = [c for c in m.columns if c not in ("iy", "ix", "time", "tile_order") and "sigma" not in c and "ice_area" not in c]
        audit.assert_ok(audit.physics(m, values, area="ice_area" if "ice_area" in m.columns else None))
        return mosaic.on_canvas(m, canvas()).withColumns({"x": grid.x("ix"), "y": grid.y("iy")})
    for name, (tiles, sigma) in products.items():
        writers.write_if_absent(lambda tiles=tiles, sigma=sigma: build(tiles, sigma), out[name], spark=spark)
    return {name: spark.read.parquet(out[name]) for name in products}


def run_upsample(spark: SparkSession, coarse: str, value: str, out: str, units: str = "m") -> DataFrame:
    """1 km lattice (cy, cx[, time]) -> 500 m cells by bilinear interpolation, FLOAT with units."""
    readers.validate_inputs(spark, [coarse])

    def build():
        c = _read(spark, coarse)
        by = ("time",) if "time" in c.columns else ()
        up = regrid.upsample2x(c, value=value, by=by)
        return writers.with_metadata(writers.narrow_floats(up), {value: {"units": units}})
    writers.write_if_absent(build, out, spark=spark)
    return spark.read.parquet(out)


def run_upsample_products(spark: SparkSession, products: dict[str, tuple[str, str, str]], src_res: float = 1000.0,
                          dst_res: float = 500.0) -> dict[str, str]:
    """B8 over several products ``name -> (coarse path, value column, output path)``: each is checked (V2: its lattice
    against the nominal spacing) and refined by itself; one that fails doesn't stop the others.

    Returns ``name -> "written"`` or the error, and raises only when every product failed.
    """
    said = {}
    for name, (coarse, value, out) in products.items():
        try:
            readers.validate_inputs(spark, [coarse])
            c = _read(spark, coarse)
            src = c.select((F.col("cx") * src_res).cast("double").alias("x")).distinct()
            dst = src.select(F.explode(F.array(F.col("x") - dst_res / 2, F.col("x") + dst_res / 2)).alias("x"))
            audit.assert_ok(audit.grid_compat(src, dst, src_res, dst_res))
            run_upsample(spark, coarse, value, out)
            said[name] = "written"
        except Exception as e:  # reported per product
            said[name] = f"{type(e).__name__}: {e}"
    if products and all(x != "written" for x in said.values()):
        raise RuntimeError(f"no product was written: {said}")
    return said


def run_features(spark: SparkSession, static: str, altimetry: str, out_static: str, out_dynamic: str,
                 ny: int, nx: int) -> tuple[DataFrame, DataFrame]:
    """Bed slope, distance to grounding line, dynamic surface and its slope, null outside ice."""
    readers.validate_inputs(spark, [static, altimetry])
    s = _read(spark, static)
    bs = stencil.slope(s.select("iy", "ix", "bed"), "bed", ny, nx, out="bed_slope").select("iy", "ix", "bed_slope")
    gl = stencil.distance_to_sources(s.select("iy", "ix", "mask"), F.col("mask") == 1, ny,
                                     out="dist_to_grounding_line")
    f = select.null_outside(gl.join(bs, ["iy", "ix"], "left"), ["bed_slope", "dist_to_grounding_line"],
                            F.col("mask").isin(1, 3)).drop("mask")
    # features are stored as FLOAT; heights and slopes are computed in DOUBLE
    writers.write_even(f, out_static, files=max(1, spark.sparkContext.defaultParallelism))
    a = _read(spark, altimetry)
    h = a.join(s.select("iy", "ix", "surface", "mask"), ["iy", "ix"]).select(
        "iy", "ix", "time", "mask", thermo.dynamic_surface().alias("h_surface_dynamic"))
    h = stencil.slope(h, "h_surface_dynamic", ny, nx, by=("time",), out="surface_slope")
    h = select.null_outside(h, ["h_surface_dynamic", "surface_slope"], F.col("mask").isin(1, 3)).drop("mask")
    writers.write_steps(writers.narrow_floats(h), out_dynamic, "time")
    return spark.read.parquet(out_static), spark.read.parquet(out_dynamic)


def run_thermodynamics(spark: SparkSession, ocean_match: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Add pressure, T_f, T_star to a copy of the ocean match table (K6) and audit it (V8)."""
    readers.validate_inputs(spark, [ocean_match])
    meta = {"T_f": {"long_name": "Freezing point", "units": "degC"},
            "T_star": {"long_name": "Thermal driving", "units": "degC"}}
    o = _read(spark, ocean_match).withColumn("pressure", thermo.base_pressure())
    o = o.withColumn("T_f", thermo.freezing_point()).withColumn("T_star", thermo.thermal_driving())
    writers.write_layout(writers.with_metadata(o, meta), out, keys=("time",))
    written = spark.read.parquet(out)
    return written, audit.post_write(written, ["T_f", "T_star"])


def run_anomaly_regrid(spark: SparkSession, source: str, source_grid: str, targets: str, weights: str,
                       out: str, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int, n_lon: int,
                       value: str = "lwe", lo: float | None = None, hi: float | None = None,
                       epoch: str | None = None, first_day: str | None = None, last_day: str | None = None,
                       ) -> tuple[DataFrame, DataFrame]:
    """Anomaly on a regular lat/lon grid -> target cells, every step, with QC.

    ``source``: ``(src_id, time, value)``, ``time`` in days since ``epoch`` if that is given (F3);
    ``source_grid``: ``(src_id, si, sj, lat, lon)``; ``targets``: ``(dst_id, x, y)`` in EPSG:3031 metres.
    Steps from ``first_day`` to ``last_day`` (P8). Nearest-neighbour weights (J11) are built once
    into ``weights`` and reused (J13). Values outside the open QC range become null (P11) and are counted per
    step (A10) from the same regridded table; steps are written as regions (K4), so a rerun replaces its own.
    """
    from floe import constants as C
    from floe.functions.proj import xy_to_latlon
    from floe.operators import stats
    lo = C.QC_LWE_MIN if lo is None else lo
    hi = C.QC_LWE_MAX if hi is None else hi
    readers.validate_inputs(spark, [source, source_grid, targets])

    def build():
        lat, lon = xy_to_latlon("x", "y")
        t = _read(spark, targets).select("dst_id", lat.alias("lat"), lon.alias("lon"))
        g = _read(spark, source_grid).withColumn("_v", F.lit(None).cast("double"))
        nn = regrid.nearest_regular(g, t, lat0, dlat, lon0, dlon, n_lat, n_lon, value="_v")
        return regrid.nearest_weights(nn)
    mark = regrid.grid_fingerprint("nearest", source_grid, targets, lat0, dlat, lon0, dlon, n_lat, n_lon)
    w = regrid.weights_table(spark, weights, build, mark)
    src = spark.read.parquet(source) if epoch else _read(spark, source)
    if epoch:
        src = src.withColumn("time", days_to_timestamp("time", epoch).cast("date"))
    if first_day and last_day:
        src = select.time_slice(src, "time", first_day, last_day)
    raw = materialize(regrid.apply_weights(src, w, value=value, by=("time",)), "regridded")
    writers.overwrite_regions(select.qc_null_out(raw, value, lo, hi), out, ("time",))
    return spark.read.parquet(out), stats.qc_counters(raw, value, lo, hi, by="time")
