"""Regridding as joins: bilinear (J12), stored weights (J13), nearest neighbour."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions.grid import dense_run
from floe.functions.proj import unit_vector
from floe.operators.joins import DEFAULT_SALT_BUCKETS, salted_sides, sized_join, spread
from floe.session import materialize

_CORNERS = [(0, 0), (0, 1), (1, 0), (1, 1)]  # (dy, dx)


def corner_cells(nodes: DataFrame, value: str = "v", node_keys=("cy", "cx"), by=()) -> DataFrame:
    """Cells of a node lattice with their four corner values.

    Each node is sent to the four cells it is a corner of (``explode``), then
    one grouped aggregate gathers ``v00, v01, v10, v11`` per cell anchor
    ``(sy, sx)``; ``n_valid`` counts the corners that exist with a value.
    One shuffle; a cell receives exactly four rows, so no key can be hot.
    """
    cy, cx = node_keys
    offs = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in _CORNERS])
    e = nodes.select(*by, F.col(cy).alias("_cy"), F.col(cx).alias("_cx"), F.col(value).alias("_v"),
                     F.explode(offs).alias("o"))
    e = e.select(*by, (F.col("_cy") - F.col("o.dy")).alias("sy"), (F.col("_cx") - F.col("o.dx")).alias("sx"),
                 (F.col("o.dy") * 2 + F.col("o.dx")).alias("corner"), "_v")
    aggs = [F.max(F.when(F.col("corner") == dy * 2 + dx, F.col("_v"))).alias(f"v{dy}{dx}") for dy, dx in _CORNERS]
    return spread(e, *by, "sy", "sx", grow=len(_CORNERS)).groupBy(*by, "sy", "sx").agg(*aggs, F.count("_v").alias("n_valid"),
                                          F.bool_or(F.col("corner") == 0).alias("has00"))


def bilinear_value(fy: Column, fx: Column, sy: Column, sx: Column) -> Column:
    """w00*v00 + w01*v01 + w10*v10 + w11*v11, fixed term order, all four corners required."""
    wy, wx = fy - sy, fx - sx
    w = {(0, 0): (F.lit(1.0) - wy) * (F.lit(1.0) - wx), (0, 1): (F.lit(1.0) - wy) * wx,
         (1, 0): wy * (F.lit(1.0) - wx), (1, 1): wy * wx}
    total = None
    for dy, dx in _CORNERS:
        term = w[(dy, dx)] * F.col(f"v{dy}{dx}")
        total = term if total is None else total + term
    return F.when(F.col("n_valid") == 4, total)


def bilinear(nodes: DataFrame, targets: DataFrame, target_keys: list[str], fy: str = "fy", fx: str = "fx",
             value: str = "v", node_keys=("cy", "cx"), by=()) -> DataFrame:
    """Planar bilinear interpolation of node values at fractional node coordinates.

    ``targets`` carry ``(target_keys..., fy, fx)`` in node-index units. A
    target outside the lattice, or with any missing corner (even one with a
    zero weight), gets null. Targets are joined to cells on the integer anchor
    (and on ``by``, e.g. time, which targets must then carry).
    """
    cells = corner_cells(nodes, value, node_keys, by)
    t = targets.select(*target_keys, *by, F.col(fy).alias("_fy"), F.col(fx).alias("_fx"),
                       F.floor(F.col(fy)).cast("int").alias("sy"), F.floor(F.col(fx)).cast("int").alias("sx"))
    j = t.join(cells, ["sy", "sx", *by], "left")
    return j.select(*target_keys, *by, bilinear_value(F.col("_fy"), F.col("_fx"), F.col("sy"), F.col("sx")).alias(value))


def upsample2x(nodes: DataFrame, value: str = "v", node_keys=("cy", "cx"), by=()) -> DataFrame:
    """J12 on the master grid: a 1 km lattice refined to 500 m cell centres.

    Target ``(2*cy + a, 2*cx + b)`` sits at node units ``(cy + .25 + .5a, cx + .25 + .5b)``,
    always inside the cell anchored at node ``(cy, cx)``, with weights .25/.75.
    Targets are therefore emitted straight from the cells (four per cell whose
    anchor node exists): one shuffle in total and no join with a target table.
    """
    cells = corner_cells(nodes, value, node_keys, by).where(F.col("has00"))
    ab = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    t = cells.select("*", F.explode(ab).alias("o"))
    fy = F.col("sy").cast("double") + F.lit(0.25) + F.lit(0.5) * F.col("o.a").cast("double")
    fx = F.col("sx").cast("double") + F.lit(0.25) + F.lit(0.5) * F.col("o.b").cast("double")
    return t.select((F.col("sy") * 2 + F.col("o.a")).cast("int").alias("iy"),
                    (F.col("sx") * 2 + F.col("o.b")).cast("int").alias("ix"), *by,
                    bilinear_value(fy, fx, F.col("sy"), F.col("sx")).alias(value))


def bilinear_weights(targets: DataFrame, dst: str, fy: str, fx: str, node_id) -> DataFrame:
    """Weights table ``(dst_id, src_id, w)`` of bilinear interpolation (for J13 reuse)."""
    sy, sx = F.floor(F.col(fy)).cast("int"), F.floor(F.col(fx)).cast("int")
    wy, wx = F.col(fy) - sy, F.col(fx) - sx
    parts = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"),
                               ((wy if dy else F.lit(1.0) - wy) * (wx if dx else F.lit(1.0) - wx)).alias("w"))
                      for dy, dx in _CORNERS])
    e = targets.select(F.col(dst).alias("dst_id"), sy.alias("_sy"), sx.alias("_sx"), F.explode(parts).alias("p"))
    return e.select("dst_id", node_id(F.col("_sy") + F.col("p.dy"), F.col("_sx") + F.col("p.dx")).alias("src_id"),
                    F.col("p.w").alias("w"))


#: Consecutive source ids of one block of the sparse matrix product.
SOURCE_BLOCK = 4096
#: Steps that count for one in the number of tasks of a product for many steps.
STEPS_OF_TASK = 16


def apply_weights(src: DataFrame, weights: DataFrame, value: str = "v", by=(), block: int = SOURCE_BLOCK) -> DataFrame:
    """Sparse matrix product ``sum(w * v)`` per destination (and per ``by`` that the sources hold, e.g. time).

    Every destination has a row for every ``by``; it is null when any of its
    weighted sources is missing or null. Without ``by``, hot sources (one coarse cell feeding
    many targets) are spread by ``sized_join`` (broadcast within its budget, salted by destination
    beyond). With ``by``, the product is blocked: see ``_blocked_product``.
    """
    if by and isinstance(src.schema["src_id"].dataType, T.IntegralType):
        return _blocked_product(src, weights, value, list(by), block)
    n_w = weights.groupBy("dst_id").agg(F.count(F.lit(1)).alias("_n_w"))
    if by:
        # the steps as one value: an array as long as the time axis
        steps = src.agg(F.collect_set(F.struct(*by)).alias("_steps")).scalar()
        n_w = n_w.select("dst_id", "_n_w", F.explode(steps).alias("_by")).select("dst_id", "_n_w", "_by.*")
        j = weights.join(src.select("src_id", *by, value), "src_id", "inner")
    else:
        j = sized_join(weights, src.select("src_id", value), ["src_id"], "inner", salt_by=["dst_id"])
    agg = j.groupBy("dst_id", *by).agg(F.sum(F.col("w") * F.col(value)).alias("_s"),
                                       F.count(value).alias("_n"))
    keys = ["dst_id", *by]
    same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return (n_w.alias("t").join(agg.alias("a"), same, "left")
            .select(*[F.col(f"t.{k}").alias(k) for k in keys], F.when(F.col("_n") == F.col("_n_w"), F.col("_s")).alias(value)))


def _blocked_product(src: DataFrame, weights: DataFrame, value: str, by: list[str], block: int) -> DataFrame:
    """J13 for many steps: weights and sources are partitioned alike, by blocks of consecutive source ids.

    * Sources become one array per (block, step), so a shuffled source row is a block's step, not a cell's.
      Blocks without a source at a step get an empty one, which makes the sums there null.
    * A weight is shuffled once, not once per step. Its products are summed in the task of the join, and one
      partial sum per destination, step and block goes on: the only shuffle that grows with the steps.
    * A block with more weights than its share (a hot source) is cut by destination into 64 parts, and only such
      blocks' arrays are copied (``salted_sides``).

    A source id held twice at a step is an error. Ids should be numbered along the grid (rows of a lattice do):
    an array is as long as the span of the ids in its block.
    """
    place = F.expr(f"pmod(src_id, {block})").cast("int")
    number = F.expr(f"(src_id - pmod(src_id, {block})) div {block}")
    w = weights.select("dst_id", "w", F.coalesce(number, F.lit(0)).alias("_block"), place.alias("_place"))
    steps = src.agg(F.collect_set(F.struct(*by)).alias("_steps")).scalar()  # an array as long as the time axis
    cells = src.where(F.col("src_id").isNotNull()).select(
        number.alias("_block"), *by, F.struct(place.alias("p"), F.col(value).cast("double").alias("v")).alias("_e"))
    empty = (w.select("_block").distinct().select("_block", F.explode(steps).alias("_by"))
             .select("_block", "_by.*", F.lit(None).cast(cells.schema["_e"].dataType).alias("_e")))
    span = F.col("_last") - F.col("_first") + 1
    arrays = (cells.unionByName(empty).groupBy("_block", *by)
              .agg(F.collect_list("_e").alias("_es"), F.min("_e.p").alias("_first"), F.max("_e.p").alias("_last"))
              .select("_block", *by, "_first", dense_run("_es", F.col("_first"), span, F.lit(None).cast("double")).alias("_values")))
    salt = F.pmod(F.xxhash64("dst_id"), F.lit(DEFAULT_SALT_BUCKETS))
    w, arrays = salted_sides(w, arrays, ["_block"], salt, DEFAULT_SALT_BUCKETS)
    w = spread(w, "_block", "_salt", grow=STEPS_OF_TASK)  # every weight becomes a product for each step
    v = F.get(F.col("_values"), F.col("_place") - F.col("_first"))
    products = w.join(arrays, ["_block", "_salt"]).select("dst_id", *by, "w", v.alias("_v"))
    sums = products.groupBy("dst_id", *by).agg(F.sum(F.col("w") * F.col("_v")).alias("_s"), F.count("_v").alias("_n"), F.count(F.lit(1)).alias("_n_w"))
    return sums.select("dst_id", *by, F.when(F.col("_n") == F.col("_n_w"), F.col("_s")).alias(value))


# ----------------------------------------------------------- nearest (J11) ---

def _chord2(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    return ((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2]))


#: Degrees from a pole within which rounding hides the longitude.
_AT_POLE_DEG = 1e-5
#: Axis lengths up to which the lattice's axes are array literals of a plan.
MAX_AXES = 20_000


def nearest_regular(src: DataFrame, targets: DataFrame, lat0: float, dlat: float, lon0: float, dlon: float,
                    n_lat: int, n_lon: int, value: str = "v", seed_radius: int = 1) -> DataFrame:
    """Nearest source cell (great-circle) for each target, on a regular lat/lon source grid.

    ``src``: ``(src_id, si, sj, lat, lon, value)``; ``targets``: ``(dst_id, lat, lon)``. Exact, without a cap on
    candidates; ties go to the smallest ``src_id``; null source values stay candidates. Every target has a
    row; it is null only when there are no sources at all.

    The nearest point of the *lattice* is found inside the target's row (``nearest_cell``); if that cell
    has a source it is the nearest source, and one join by cell fetches it (broadcast, or salted beyond the
    budget). Axes longer than ``MAX_AXES`` stay out of the plan: see ``_nearest_on_long_axes``.
    Only targets whose nearest cell is a hole search again among the sources themselves
    (``nearest_by_windows``), as do all targets of a source table that isn't a lattice: coordinates that
    don't follow the axes or axes that don't go round the globe, cells held twice, or ids that don't ascend along them.
    """
    if n_lat + n_lon > MAX_AXES:
        placed = lattice_placement(src, lat0, dlat, lon0, dlon, n_lat, n_lon)
        if placed is not None:
            return _nearest_on_long_axes(src, targets, placed, lat0, dlat, lon0, dlon, n_lat, n_lon, value, seed_radius)
    axes = lattice_axes(src, lat0, dlat, lon0, dlon, n_lat, n_lon)
    if axes is None:
        return nearest_by_windows(src, targets, lat0, dlat, lon0, dlon, n_lat, n_lon, value, seed_radius)
    cells = nearest_cell(targets, axes, lat0, dlat, lon0, dlon, n_lat, n_lon)
    found = sized_join(cells, src.select("si", "sj", "src_id", value), ["si", "sj"], "left", salt_by=["dst_id"])
    if axes.full:
        return found.select("dst_id", "src_id", value)
    found = materialize(found, "nearest")
    hit = found.where(F.col("src_id").isNotNull()).select("dst_id", "src_id", value)
    holes = found.where(F.col("src_id").isNull()).select("dst_id", "lat", "lon")
    return hit.unionByName(nearest_by_windows(src, holes, lat0, dlat, lon0, dlon, n_lat, n_lon, value, seed_radius))


@dataclass(frozen=True)
class Placement:
    """How far (degrees) the sources of a lattice lie from its axes, and whether every cell has a source."""
    off_lat: float
    off_lon: float
    full: bool


def lattice_placement(src: DataFrame, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int, n_lon: int) -> Placement | None:
    """The placement of a source table on axes of any length, or None if it is no lattice. One row goes to the driver."""
    if abs(n_lon * abs(dlon) - 360) > 1e-6:
        return None
    off = F.col("src_id") - (F.col("si").cast("long") * n_lon + F.col("sj"))
    apart = [F.abs(F.col(degrees) - (F.lit(first) + F.col(axis) * F.lit(step)))
             for axis, degrees, first, step in (("si", "lat", lat0, dlat), ("sj", "lon", lon0, dlon))]
    c = src.select("si", "sj", off.alias("off"), apart[0].alias("lat"), apart[1].alias("lon")).groupBy("si", "sj").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.col("lat") + F.col("lon")).alias("known"), F.min("off").alias("off"), F.max("lat").alias("lat"), F.max("lon").alias("lon")).agg(
        F.count(F.lit(1)).alias("cells"), F.max("n").alias("n"), F.min("known").alias("known"), F.min("off").alias("lo"), F.max("off").alias("hi"),
        F.min("si").alias("si0"), F.max("si").alias("si1"), F.min("sj").alias("sj0"), F.max("sj").alias("sj1"), F.max("lat").alias("lat"), F.max("lon").alias("lon")).first()
    if not c.cells or c.n > 1 or not c.known or c.lo != c.hi or min(c.si0, c.sj0) < 0 or c.si1 >= n_lat or c.sj1 >= n_lon:
        return None
    if not (c.lat < abs(dlat) * 1e-6 and c.lon < abs(dlon) * 1e-6):
        return None
    return Placement(c.lat, c.lon, full=c.cells == n_lat * n_lon)


@dataclass(frozen=True)
class Axes:
    """Sines and cosines along the axes of a lattice, as Spark computes them, and whether every cell has a source."""
    cos_lat: list[float]
    sin_lat: list[float]
    cos_lon: list[float]
    sin_lon: list[float]
    full: bool


def lattice_axes(src: DataFrame, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int, n_lon: int) -> Axes | None:
    """The axes of a source table, or None if it is no lattice. One row per grid row and column goes to the driver."""
    if n_lat + n_lon > MAX_AXES or abs(n_lon * abs(dlon) - 360) > 1e-6:
        return None
    off = F.col("src_id") - (F.col("si").cast("long") * n_lon + F.col("sj"))
    c = src.select("si", "sj", off.alias("off")).groupBy("si", "sj").agg(F.count(F.lit(1)).alias("n"), F.min("off").alias("off")).agg(
        F.count(F.lit(1)).alias("cells"), F.max("n").alias("n"), F.min("off").alias("lo"), F.max("off").alias("hi"),
        F.min("si").alias("si0"), F.max("si").alias("si1"), F.min("sj").alias("sj0"), F.max("sj").alias("sj1")).first()
    if not c.cells or c.n > 1 or c.lo != c.hi or min(c.si0, c.sj0) < 0 or c.si1 >= n_lat or c.sj1 >= n_lon:
        return None
    got = []
    for axis, degrees, first, step, size in (("si", "lat", lat0, dlat, n_lat), ("sj", "lon", lon0, dlon, n_lon)):
        held = src.groupBy(F.col(axis).cast("long").alias("k")).agg(F.min(degrees).alias("d"), F.max(degrees).alias("d1"))
        every = src.sparkSession.range(size).select(F.col("id").alias("k"), (F.lit(first) + F.col("id") * F.lit(step)).alias("plain"))
        at = F.radians(F.coalesce("d", "plain"))
        rows = every.join(held, "k", "left").select("k", F.cos(at).alias("cos"), F.sin(at).alias("sin"),
                                                    F.coalesce(F.abs(F.col("d") - F.col("plain")) < abs(step) * 1e-6, F.lit(True)).alias("placed"),
                                                    F.coalesce(F.col("d") == F.col("d1"), F.lit(True)).alias("one")).collect()
        if not all(r.placed and r.one for r in rows):
            return None
        rows.sort(key=lambda r: r.k)
        got += [[r["cos"] for r in rows], [r["sin"] for r in rows]]
    return Axes(*got, full=c.cells == n_lat * n_lon)


def _window(lat: Column, lon: Column, d2: Column, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int) -> tuple[Column, Column, Column, Column]:
    """First and last grid row and column of the cells that can be within chord distance sqrt(d2) (columns not yet wrapped)."""
    chord = F.sqrt(d2) * F.lit(1 + 1e-9) + F.lit(1e-12)
    theta = F.lit(2.0) * F.asin(F.least(chord / 2, F.lit(1.0)))
    theta_deg = F.degrees(theta)
    ratio = F.sin(theta) / F.cos(F.radians(lat))
    reaches_pole = (lat - theta_deg <= -90.0) | (lat + theta_deg >= 90.0)
    dlam = F.when(reaches_pole | (ratio >= 1.0), F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)))
    si_lo = F.greatest(F.ceil((lat - theta_deg - F.lit(lat0)) / F.lit(dlat)).cast("int") - 1, F.lit(0))
    si_hi = F.least(F.floor((lat + theta_deg - F.lit(lat0)) / F.lit(dlat)).cast("int") + 1, F.lit(n_lat - 1))
    return (si_lo, F.greatest(si_hi, si_lo), F.floor((lon - dlam - F.lit(lon0)) / F.lit(dlon)).cast("int") - 1,
            F.ceil((lon + dlam - F.lit(lon0)) / F.lit(dlon)).cast("int") + 1)


def nearest_cell(targets: DataFrame, axes: Axes, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int, n_lon: int) -> DataFrame:
    """``targets`` with ``(si, sj)`` of the nearest lattice point, ties to the first in row order; no shuffle, no extra rows.

    In a grid row the distance grows with the difference in longitude, so the nearest point lies in the rounded column
    or, on ties, beside it. Along a column the distance is a sinusoid of latitude whose minimum is known in closed form,
    so only the rows around that latitude count: nine candidates, compared as an array inside the row. A target
    at a pole, where longitude says nothing, looks at all columns. The axes are the only data in the plan.
    """
    cos_lat, sin_lat, cos_lon, sin_lon = (F.lit(np.array(v, np.float64)) for v in (axes.cos_lat, axes.sin_lat, axes.cos_lon, axes.sin_lon))

    def point(i, j):
        cl = F.get(cos_lat, i)
        return cl * F.get(cos_lon, j), cl * F.get(sin_lon, j), F.get(sin_lat, i)
    t = _with_candidates(targets, point, lat0, dlat, lon0, dlon, n_lat, n_lon)
    return t.withColumn("_best", F.array_min("_near")).select("dst_id", "lat", "lon", "_best.si", "_best.sj")


def _with_candidates(targets: DataFrame, point, lat0: float, dlat: float, lon0: float, dlon: float, n_lat: int, n_lon: int) -> DataFrame:
    """``targets`` with ``_near``: the lattice points that may be the nearest, as structs ``(d, si, sj)``; ``point(i, j)`` is a unit vector."""
    t = targets.select("dst_id", "lat", "lon", *[c.alias(n) for c, n in zip(unit_vector("lat", "lon"), ("_x", "_y", "_z"))])
    tv = (F.col("_x"), F.col("_y"), F.col("_z"))
    j0 = F.rint((F.col("lon") - F.lit(lon0)) / F.lit(dlon)).cast("int")
    near = F.array(*[F.pmod(j0 + k, F.lit(n_lon)) for k in (-1, 0, 1)])
    columns = F.when(F.abs(F.col("lat")) > 90 - _AT_POLE_DEG, F.sequence(F.lit(0), F.lit(n_lon - 1))).otherwise(near)
    t = t.withColumn("_columns", columns)
    phi, lam = F.radians("lat"), F.radians("lon")

    def cells(j):
        top = F.degrees(F.atan2(F.sin(phi), F.cos(phi) * F.cos(lam - F.radians(F.lit(lon0) + j * F.lit(dlon)))))
        i = F.rint((top - F.lit(lat0)) / F.lit(dlat)).cast("int")
        rows = F.array(*[F.least(F.greatest(i + k, F.lit(0)), F.lit(n_lat - 1)) for k in (-1, 0, 1)])
        return F.transform(rows, lambda i: F.struct(_chord2(tv, point(i, j)).alias("d"), i.alias("si"), j.alias("sj")))
    return t.withColumn("_near", F.flatten(F.transform("_columns", cells)))


def _nearest_on_long_axes(src: DataFrame, targets: DataFrame, placed: Placement, lat0: float, dlat: float, lon0: float, dlon: float,
                          n_lat: int, n_lon: int, value: str, seed_radius: int) -> DataFrame:
    """J11 on a lattice whose axes are too long for a plan: the axes are computed in the row, ties are settled by the sources.

    The points of the ideal axes differ from the sources by the measured placement. So a target keeps every candidate whose
    distance is the least one's within that error: nearly always one, which is fetched by its cell. The rows of
    the others are compared by the sources' own coordinates, as a plain search would. A target with a hole among its
    candidates searches again among the sources.
    """
    def point(i, j):
        lat, lon = F.radians(F.lit(lat0) + i * F.lit(dlat)), F.radians(F.lit(lon0) + j * F.lit(dlon))
        return F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)
    slack = 2 * math.radians(placed.off_lat + placed.off_lon) + 1e-12  # both ends move; the rest is rounding
    dealt = targets.repartition("dst_id")  # a small file of many targets would be one task
    t = _with_candidates(dealt, point, lat0, dlat, lon0, dlon, n_lat, n_lon).withColumn("_d", F.array_min("_near")["d"])
    close = F.filter("_near", lambda c: F.sqrt(c["d"]) <= F.sqrt("_d") + F.lit(slack))
    close = F.array_distinct(F.transform(close, lambda c: F.struct(c["si"].alias("si"), c["sj"].alias("sj"))))
    near = materialize(t.select("dst_id", "lat", "lon", close.alias("_cells")), "nearest-cells")
    held = src.select("si", "sj", "src_id", value, *[c.alias(n) for c, n in zip(unit_vector("lat", "lon"), ("_sx", "_sy", "_sz"))])

    one = near.where(F.size("_cells") <= 1).select("dst_id", "lat", "lon", F.get("_cells", F.lit(0)).alias("_c")).select("dst_id", "lat", "lon", "_c.*")
    one = sized_join(one, held.select("si", "sj", "src_id", value), ["si", "sj"], "left", salt_by=["dst_id"]).select("dst_id", "lat", "lon", "src_id", value)
    # equal targets are compared once and repeated at the end
    many = near.where(F.size("_cells") > 1).groupBy("dst_id", "lat", "lon", "_cells").agg(F.count(F.lit(1)).alias("_copies"))
    many = many.select("dst_id", "lat", "lon", "_copies", F.explode("_cells").alias("_c"), *[c.alias(n) for c, n in zip(unit_vector("lat", "lon"), ("_x", "_y", "_z"))])
    many = sized_join(many.select("*", "_c.*").drop("_c"), held, ["si", "sj"], "left", salt_by=["dst_id"])
    d = _chord2((F.col("_x"), F.col("_y"), F.col("_z")), (F.col("_sx"), F.col("_sy"), F.col("_sz")))
    best = F.min_by(F.struct("src_id", value), F.struct(d.alias("d"), F.col("src_id")))
    many = many.groupBy("dst_id", "lat", "lon", "_copies").agg(F.when(F.count("src_id") == F.count(F.lit(1)), best).alias("_b"))
    many = many.select("dst_id", "lat", "lon", F.explode(F.array_repeat("_b", F.col("_copies").cast("int"))).alias("_b"))
    found = one.unionByName(many.select("dst_id", "lat", "lon", "_b.*"))
    if placed.full:
        return found.select("dst_id", "src_id", value)
    found = materialize(found, "nearest")
    hit = found.where(F.col("src_id").isNotNull()).select("dst_id", "src_id", value)
    holes = found.where(F.col("src_id").isNull()).select("dst_id", "lat", "lon")
    return hit.unionByName(nearest_by_windows(src, holes, lat0, dlat, lon0, dlon, n_lat, n_lon, value, seed_radius))


def nearest_by_windows(src: DataFrame, targets: DataFrame, lat0: float, dlat: float, lon0: float, dlon: float,
                       n_lat: int, n_lon: int, value: str = "v", seed_radius: int = 1) -> DataFrame:
    """J11 for targets near holes, and for sources that are no lattice: candidates are joined to the sources that exist.

    ``src``: ``(src_id, si, sj, lat, lon, value)``; ``targets``: ``(dst_id, lat, lon)``.
    Exact, without a cap on candidates:

    1. seed - the (2r+1)^2 index neighbours of the target's rounded position
       (longitude wraps, latitude clamps) give an upper bound ``d`` on the
       nearest chord distance;
    2. exact - every source within angular radius ``theta(d)`` lies in a
       latitude band and a longitude window computed from ``d`` (all
       longitudes when the cap reaches the pole); those are the candidates.
       Ties go to the smallest ``src_id``. Null source values stay candidates.

    Targets whose seed window is empty (holes in the source grid) retry with a
    doubled radius until they find one or the window holds the whole grid. Every
    target has a row; it is null only when there are no sources at all.
    """
    s = src.select("src_id", "si", "sj", value, *[c.alias(n) for c, n in zip(unit_vector("lat", "lon"), ("sx", "sy", "sz"))])
    t = targets.select("dst_id", "lat", "lon",
                       *[c.alias(n) for c, n in zip(unit_vector("lat", "lon"), ("tx", "ty", "tz"))])
    tv = (F.col("tx"), F.col("ty"), F.col("tz"))
    sv = (F.col("sx"), F.col("sy"), F.col("sz"))

    def candidates(tt: DataFrame, si_lo: Column, si_hi: Column, sj_lo: Column, sj_hi: Column) -> DataFrame:
        width = sj_hi - sj_lo + 1
        all_lon = width >= n_lon
        sj_seq = F.when(all_lon, F.sequence(F.lit(0), F.lit(n_lon - 1))).otherwise(F.sequence(sj_lo, sj_hi))
        e = tt.select("*", F.explode(F.sequence(si_lo, si_hi)).alias("si"))
        e = e.select("*", F.explode(sj_seq).alias("_sj"))
        return e.withColumn("sj", F.pmod(F.col("_sj"), F.lit(n_lon))).drop("_sj")

    fi = (F.col("lat") - F.lit(lat0)) / F.lit(dlat)
    fj = (F.col("lon") - F.lit(lon0)) / F.lit(dlon)
    pending = t
    seeds = []
    r = seed_radius
    while True:
        ci, cj = F.rint(fi).cast("int"), F.rint(fj).cast("int")
        lo = F.least(F.greatest(ci - r, F.lit(0)), F.lit(n_lat - 1))
        hi = F.greatest(F.least(ci + r, F.lit(n_lat - 1)), lo)
        c = sized_join(candidates(pending, lo, hi, cj - r, cj + r), s, ["si", "sj"], "inner", salt_by=["dst_id"])
        best = c.groupBy("dst_id").agg(F.min(_chord2(tv, sv)).alias("d2"))
        seeds.append(best)
        if r >= n_lat - 1 and 2 * r + 1 >= n_lon:  # a window at one edge reaches the other
            break
        pending = pending.join(best, "dst_id", "left_anti")
        if pending.isEmpty():
            break
        r *= 2
    seed = seeds[0]
    for extra in seeds[1:]:
        seed = seed.unionByName(extra)
    seed = seed.groupBy("dst_id").agg(F.min("d2").alias("d2"))

    # exact window from the bound
    window = _window(F.col("lat"), F.col("lon"), F.col("d2"), lat0, dlat, lon0, dlon, n_lat)
    tb = t.join(seed, "dst_id").withColumns(dict(zip(("_si_lo", "_si_hi", "_sj_lo", "_sj_hi"), window))).drop("d2")
    cand = sized_join(candidates(tb, F.col("_si_lo"), F.col("_si_hi"), F.col("_sj_lo"), F.col("_sj_hi")),
                      s, ["si", "sj"], "inner", salt_by=["dst_id"])
    best = cand.groupBy("dst_id").agg(
        F.min_by(F.struct("src_id", value), F.struct(_chord2(tv, sv).alias("d"), F.col("src_id"))).alias("b"))
    best = best.select("dst_id", F.col("b.src_id").alias("src_id"), F.col(f"b.{value}").alias(value))
    return t.select("dst_id").join(best, "dst_id", "left")


def nearest_weights(nearest: DataFrame) -> DataFrame:
    """J11 result saved as a weights table (w = 1) for J13 reuse."""
    return nearest.select("dst_id", "src_id", F.lit(1.0).alias("w"))


def grid_fingerprint(method: str, *parts) -> str:
    """Folder name of a weights table: the method and a digest of what the weights depend on."""
    import hashlib
    return f"{method}-{hashlib.sha256(repr(parts).encode()).hexdigest()[:16]}"


def weights_table(spark, path: str, build, fingerprint: str = "weights") -> DataFrame:
    """J13 weights persisted once and reused, in a folder named by ``fingerprint`` (of grid and method).

    Only a complete table is reused (its write left ``_SUCCESS``); what a failed write left is written over.
    """
    from floe.sinks.writers import write_if_absent
    table = f"{path.rstrip('/')}/{fingerprint}"
    write_if_absent(build, table, spark=spark)
    return spark.read.parquet(table)
