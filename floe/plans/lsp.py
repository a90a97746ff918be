"""The long sparse table, one row per (pixel, time) observed by any sensor.

backbone (J1) -> static (J2) -> anomaly (J3) -> forward fill (W1) -> fusion (W2, W3)

Plan shape (``build_filled``): altimetry, ocean and static rows share one
shuffle by pixel; one sort; one window fills sensor and static columns; the
anomaly table is broadcast after a size check; a second window (same
partitioning and order, so no exchange and no sort) fills ``lwe_length``.
Then the filled table is written once to the shared checkpoint folder, and the
mascon totals - a small partial aggregate over three columns - are joined
back by broadcast (salted shuffle join above the size budget).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe import constants as C
from floe.functions.grid import Grid
from floe.operators import fuse

def build_backbone(altimetry: DataFrame, ocean: DataFrame) -> DataFrame:
    return fuse.backbone(altimetry, ocean)


def build_enriched(altimetry, ocean, static, anomaly) -> DataFrame:
    bb = build_backbone(altimetry, ocean)
    st = fuse.enrich_static(bb, static.drop("x", "y"))
    return fuse.attach_anomaly(st, anomaly)


def build_filled_joins(altimetry, ocean, static, anomaly) -> DataFrame:
    """W1 after J2 and J3 written as joins (the literal order; two sorts of the backbone at scale)."""
    return fuse.forward_fill(build_enriched(altimetry, ocean, static, anomaly))


def build_filled(altimetry, ocean, static, anomaly, max_bytes: int = fuse.DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """J1 + J2 + J3 + W1 with one shuffle and one sort of the backbone.

    Static columns enter the pixel shuffle as one extra, flagged row per pixel,
    which sorts first. The fill window then carries the filled sensor columns and
    the static ones alike (the static row is the only one holding static values). The flagged
    rows are dropped; pixels without observations disappear, exactly as in a
    left join from the backbone. Every input column is kept (of columns that
    static shares with a sensor, the sensor's), and so are sensor rows without
    a time. The anomaly join (broadcast after a size check) keeps the
    partitioning and ordering, so the second fill (``lwe_length``) needs no
    exchange and no sort.
    """
    st = static.drop("x", "y", "time")
    st_cols = [c for c in st.columns if c not in fuse.PIXEL and c not in altimetry.columns and c not in ocean.columns]
    st = st.select(*fuse.PIXEL, *st_cols).withColumns(
        {"time": F.lit(None).cast(altimetry.schema["time"].dataType), "_static": F.lit(True)})
    merged = fuse.outer_align([altimetry, ocean, st], fuse.CELL_TIME, partition_by=fuse.PIXEL)
    sensors = [c for c in C.FFILL_COLS if c in merged.columns and c not in st_cols]
    order = [F.col("_static").desc_nulls_last(), F.col("time").asc_nulls_first()]
    w = fuse.pixel_window(order=order)
    filled = merged.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in sensors + st_cols})
    filled = filled.where(F.col("_static").isNull())
    return fuse.forward_fill(fuse.attach_anomaly(filled, anomaly, max_bytes=max_bytes), ["lwe_length"], order=order).drop("_static")


def build_long_sparse(altimetry: DataFrame, ocean: DataFrame, static: DataFrame,
                      anomaly: DataFrame, grid: Grid, sum_scale: int | None = None,
                      cut_lineage: bool = True) -> DataFrame:
    filled = build_filled(altimetry, ocean, static, anomaly)
    filled = filled.withColumns({"x": grid.x("ix"), "y": grid.y("iy")})
    return fuse.fuse_signal(filled, sum_scale=sum_scale, cut_lineage=cut_lineage)
