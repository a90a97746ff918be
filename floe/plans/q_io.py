"""Registered queries: sinks (K1-K11), step directories (S2) and incremental loading.

Each query writes to a fresh folder under the cluster's shared checkpoint
directory and returns the table read back, so the check covers the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions import thermo
from floe.plans.registry import query
from floe.session import materialize, scratch_path
from floe.sinks import writers
from floe.sources import fixtures as fx
from floe.sources import readers
from floe.streaming import incremental, versioned

W = fx.ctes

_ICESAT_SCHEMA = T.StructType([
    T.StructField("ix", T.IntegerType()), T.StructField("iy", T.IntegerType()),
    T.StructField("delta_h", T.DoubleType()), T.StructField("delta_h_sigma", T.DoubleType()),
    T.StructField("ice_area", T.DoubleType()), T.StructField("time", T.DateType())])


def _read(spark, path, schema=None):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


@query("k1_write_even_files", W("fx_static") + "SELECT * FROM fx_static")
def k1_write_even_files(spark, d):
    p = scratch_path(spark, "k1")
    writers.write_even(fx.fx_static(spark, d), p, files=4)
    return _read(spark, p)


@query("k2_write_per_step", W("fx_icesat") + "SELECT * FROM fx_icesat")
def k2_write_per_step(spark, d):
    p = scratch_path(spark, "k2")
    writers.write_steps(fx.fx_icesat(spark, d), p, "time")
    return readers.read_steps(spark, p, _ICESAT_SCHEMA)


@query("s2_step_directory", W("fx_icesat") + "SELECT * FROM fx_icesat WHERE time >= DATE '1997-01-01'")
def s2_step_directory(spark, d):
    """Read a directory of per-step parts; the time filter prunes step folders."""
    p = scratch_path(spark, "s2")
    writers.write_steps(fx.fx_icesat(spark, d), p, "time")
    return readers.read_steps(spark, p, _ICESAT_SCHEMA).where(F.col("time") >= F.lit("1997-01-01").cast("date"))


@query("k3_create_then_append", W("fx_icesat") + "SELECT * FROM fx_icesat")
def k3_create_then_append(spark, d):
    p = scratch_path(spark, "k3")
    a = fx.fx_icesat(spark, d)
    cut = F.lit("1998-01-01").cast("date")
    writers.write_steps(a.where(F.col("time") < cut), p, "time")
    writers.append_steps(a.where(F.col("time") >= cut), p, "time")
    return readers.read_steps(spark, p, _ICESAT_SCHEMA)


_FOLDERED = T.StructType(_ICESAT_SCHEMA.fields + [T.StructField(c, T.IntegerType()) for c in ("tile_y", "tile_x", "folder_y", "folder_x")])


@query("k4_region_overwrite", W("fx_icesat") + """
SELECT ix, iy, CASE WHEN time = (SELECT MIN(time) FROM fx_icesat) THEN delta_h * 2 ELSE delta_h END AS delta_h,
       delta_h_sigma, ice_area, time FROM fx_icesat""")
def k4_region_overwrite(spark, d):
    """K4: rewrite the regions (time step x tile) of one step in place; all other regions stay. A folder holds 64 x 64 tiles of a step."""
    p = scratch_path(spark, "k4")
    keys, folders = ["time", "tile_y", "tile_x"], ["time", "folder_y", "folder_x"]
    a = materialize(writers.with_folders(writers.with_tiles(fx.fx_icesat(spark, d), tile=32)), "k4-in")
    writers.overwrite_regions(a, p, keys, folders)
    first = a.agg(F.min("time")).first()[0]
    fixed = a.where(F.col("time") == F.lit(first)).withColumn("delta_h", F.col("delta_h") * 2)
    writers.overwrite_regions(fixed, p, keys, folders)
    writers.overwrite_regions(fixed, p, keys, folders)  # replay: idempotent
    return readers.read_steps(spark, p, _FOLDERED).drop("tile_y", "tile_x", "folder_y", "folder_x")


@query("k5_skip_existing", W("fx_static") + "SELECT * FROM fx_static")
def k5_skip_existing(spark, d):
    p = scratch_path(spark, "k5")
    s = fx.fx_static(spark, d)
    writers.write_if_absent(s, p)
    writers.write_if_absent(s.withColumn("surface", F.lit(-1.0)), p)  # skipped: output exists
    return _read(spark, p)


_THERMO_SQL = """
, om AS (SELECT o.iy, o.ix, o.time, o.thetao, o.so, s.surface - s.thickness AS ice_draft
         FROM fx_ocean o JOIN fx_static s ON o.iy = s.iy AND o.ix = s.ix),
pr AS (SELECT *, CASE WHEN ice_draft IS NOT NULL THEN GREATEST(-ice_draft, CAST(0 AS DOUBLE)) END AS pressure FROM om),
tf AS (SELECT *, CAST(CAST('-0.0575' AS DOUBLE) * so + CAST('0.0901' AS DOUBLE) + CAST('-0.000761' AS DOUBLE) * pressure AS FLOAT) AS T_f FROM pr),
th AS (SELECT iy, ix, time, thetao, so, ice_draft, pressure, T_f, CAST(thetao - CAST(T_f AS DOUBLE) AS FLOAT) AS T_star FROM tf)
"""


def ocean_match(spark, d):
    o = fx.fx_ocean(spark, d)
    s = fx.fx_static(spark, d).select("iy", "ix", thermo.ice_draft().alias("ice_draft"))
    return o.join(s, ["iy", "ix"])


@query("k6_add_columns", W("fx_static", "fx_ocean") + _THERMO_SQL + "SELECT * FROM th")
def k6_add_columns(spark, d):
    """K6 (B10 core): add T_f and T_star to a copy of the ocean table."""
    src, dst = scratch_path(spark, "k6-in"), scratch_path(spark, "k6-out")
    writers.write_layout(ocean_match(spark, d), src, keys=("time",))
    return writers.add_columns(src, dst, spark, {"pressure": thermo.base_pressure(), "T_f": thermo.freezing_point(),
                                                 "T_star": thermo.thermal_driving()})


@query("k7_overwrite", W("fx_static") + "SELECT ix, iy, x, y, surface * 2 AS surface, thickness, bed, mask, mascon_id FROM fx_static")
def k7_overwrite(spark, d):
    p = scratch_path(spark, "k7")
    s = fx.fx_static(spark, d)
    writers.write_even(s, p, files=2)
    writers.write_even(s.withColumn("surface", F.col("surface") * 2), p, files=2)
    return _read(spark, p)


_K8_COLUMNS = ["iy", "ix", "time", "thetao", "so", "ice_draft", "pressure", "T_f", "T_star"]


@query("k8_column_metadata", W("fx_static", "fx_ocean") + _THERMO_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {repr('degC') if c in ('T_f', 'T_star') else 'NULL'} AS unit, COUNT({c}) AS n FROM th" for c in _K8_COLUMNS))
def k8_column_metadata(spark, d):
    """K8: attributes written with the data and read back, and the values of each column counted."""
    p = scratch_path(spark, "k8")
    meta = {"T_f": {"long_name": "Freezing point", "units": "degC"},
            "T_star": {"long_name": "Thermal driving", "units": "degC"}}
    o = ocean_match(spark, d).withColumn("pressure", thermo.base_pressure())
    o = o.withColumn("T_f", thermo.freezing_point()).withColumn("T_star", thermo.thermal_driving())
    writers.write_layout(writers.with_metadata(o, meta), p, keys=("time",))
    back = _read(spark, p)
    rows = writers.metadata_report(back)
    each = [F.struct(F.lit(c).alias("column_name"), F.lit(u).cast("string").alias("unit"), F.count(c).alias("n")) for c, u in rows]
    return back.agg(F.array(*each).alias("r")).select(F.inline("r"))


@query("k9_narrow_floats", W("fx_ocean") + """
SELECT ix, iy, time, CAST(thetao AS FLOAT) AS thetao, CAST(so AS FLOAT) AS so FROM fx_ocean""")
def k9_narrow_floats(spark, d):
    p = scratch_path(spark, "k9")
    writers.write_layout(writers.narrow_floats(fx.fx_ocean(spark, d)), p, keys=("time",))
    return _read(spark, p)


@query("k10_timestamp_micros", "SELECT event_id, ts, user_id FROM events")
def k10_timestamp_micros(spark, d):
    p = scratch_path(spark, "k10")
    e = fx.table(spark, d, "events").select("event_id", "ts", "user_id")
    with writers.micros_timestamps(spark):
        writers.write_even(e, p, files=2)
    return _read(spark, p)


@query("k11_chunk_layout", W("fx_icesat") + "SELECT * FROM fx_icesat")
def k11_chunk_layout(spark, d):
    p = scratch_path(spark, "k11")
    writers.write_layout(fx.fx_icesat(spark, d), p, keys=("time",))
    return _read(spark, p)


@query("t1_incremental_load", W("fx_icesat") + """
SELECT ix, iy, CASE WHEN time = (SELECT MAX(time) FROM fx_icesat) THEN delta_h + 1 ELSE delta_h END AS delta_h,
       delta_h_sigma, ice_area, time FROM fx_icesat""")
def t1_incremental_load(spark, d):
    """Steps arrive in two drops plus a corrected re-delivery of the last step."""
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("t1-in", "t1-out", "t1-ckpt"))
    a = fx.fx_icesat(spark, d)
    cut = F.lit("1998-01-01").cast("date")
    last = a.agg(F.max("time")).first()[0]
    a.where(F.col("time") < cut).write.parquet(f"{inbox}/drop1")
    incremental.load_new_steps(spark, inbox, _ICESAT_SCHEMA, target, ckpt)
    a.where(F.col("time") >= cut).write.parquet(f"{inbox}/drop2")
    a.where(F.col("time") == F.lit(last)).withColumn("delta_h", F.col("delta_h") + 1).write.parquet(f"{inbox}/drop3")
    incremental.load_new_steps(spark, inbox, _ICESAT_SCHEMA, target, ckpt)
    return readers.read_steps(spark, target, _ICESAT_SCHEMA)


@query("t1_versioned_load", W("fx_icesat") + """
SELECT ix, iy, CASE WHEN time = (SELECT MAX(time) FROM fx_icesat) THEN delta_h + 1 ELSE delta_h END AS delta_h,
       delta_h_sigma, ice_area, time FROM fx_icesat""")
def t1_versioned_load(spark, d):
    """T1 as deltas behind a manifest: two loads of three drops, the steps that both hold compacted, the newest version read."""
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("t1v-in", "t1v-out", "t1v-ckpt"))
    a = fx.fx_icesat(spark, d)
    cut = F.lit("1998-01-01").cast("date")
    last = a.agg(F.max("time")).first()[0]
    a.where(F.col("time") < cut).write.parquet(f"{inbox}/drop1")
    a.where(F.col("time") == F.lit(last)).write.parquet(f"{inbox}/drop2")
    versioned.load_versioned(spark, inbox, _ICESAT_SCHEMA, target, ckpt)
    a.where((F.col("time") >= cut) & (F.col("time") < F.lit(last))).write.parquet(f"{inbox}/drop3")
    a.where(F.col("time") == F.lit(last)).withColumn("delta_h", F.col("delta_h") + 1).write.parquet(f"{inbox}/drop4")
    versioned.load_versioned(spark, inbox, _ICESAT_SCHEMA, target, ckpt)
    versioned.compact(spark, target, _ICESAT_SCHEMA, deltas=1)
    return versioned.read_versioned(spark, target, _ICESAT_SCHEMA)


@query("s4_grouped_product_read", W("fx_tiles") + """
SELECT iy, ix, time, delta_h, delta_h_sigma, 'A' || CAST(tile_order + 1 AS VARCHAR) AS tile_id FROM fx_tiles""")
def s4_grouped_product_read(spark, d):
    """One stored table per (product, tile), read back by a config and stacked per product."""
    t = fx.fx_tiles(spark, d)
    config = {"delta_h": {}}
    for i in range(4):
        p = scratch_path(spark, f"s4-A{i + 1}")
        writers.write_even(t.where(F.col("tile_order") == i).drop("tile_order"), p, files=1)
        config["delta_h"][f"A{i + 1}"] = p
    return readers.read_products(spark, config)["delta_h"]
