"""Tile mosaics: lowest-uncertainty-first merge, overlaps, seams, tile union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.operators.joins import spread

CELL_TIME = ["iy", "ix", "time"]


def union_tiles(tiles: dict[str, DataFrame], order: list[str] | None = None) -> DataFrame:
    """Stack tiles with their id and position in the configured order."""
    names = order or list(tiles)
    frames = [tiles[n].withColumn("tile_id", F.lit(n)).withColumn("tile_order", F.lit(i))
              for i, n in enumerate(names)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def mosaic(tiles: DataFrame, sigma: str, keys=CELL_TIME, order: str = "tile_order",
           values: list[str] | None = None, first_tile: int = 0) -> DataFrame:
    """M1 + M1b: per key keep the observation with the smallest valid sigma.

    Sequential rule being reproduced: start from the first tile, replace only
    when the new sigma is valid and strictly smaller (or the current one is
    missing). Hence: ties go to the earlier tile; a key with no valid sigma
    keeps the first tile's values; other tiles without sigma never win.

    Each key has at most one row per tile, so there is no skew to handle and nothing to gain
    from combining on the map side: rows are dealt to as many tasks as the input needs, then grouped.
    """
    vals = values or [c for c in tiles.columns if c not in list(keys) + [order]]
    cand = tiles.where(F.col(sigma).isNotNull() | (F.col(order) == first_tile))
    rank = F.struct(F.coalesce(F.col(sigma), F.lit(float("inf"))).alias("s"), F.col(order).alias("o"))
    picked = spread(cand, *keys).groupBy(*keys).agg(F.min_by(F.struct(*vals, order), rank).alias("_m"))
    return picked.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in vals + [order]])


def overlaps(tiles: DataFrame, sigma: str, keys=CELL_TIME) -> DataFrame:
    """M3: keys covered by more than one tile with a valid sigma."""
    return (tiles.groupBy(*keys).agg(F.count(sigma).alias("n_valid"))
            .where(F.col("n_valid") > 1))


def argmin_overlaps(tiles: DataFrame, sigma: str, keys=CELL_TIME, order: str = "tile_order") -> DataFrame:
    """M2: on keys with more than one valid tile, the tile of least sigma (first on ties)."""
    valid = tiles.where(F.col(sigma).isNotNull())
    return (valid.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_valid"),
                 F.min_by(F.struct(F.col(order), F.col(sigma)),
                          F.struct(F.col(sigma), F.col(order))).alias("_b"))
            .where(F.col("n_valid") > 1)
            .select(*keys, "n_valid", F.col("_b")[order].alias(order), F.col("_b")[sigma].alias(sigma)))


def seam_presence(df: DataFrame, by: str, x: str = "x", y: str = "y", tol: float = 10.0) -> DataFrame:
    """M4: does a product touch the x = 0 / y = 0 seams (within ``tol`` metres)?"""
    return df.groupBy(by).agg(F.bool_or(F.abs(F.col(x)) < tol).alias("seam_x"),
                              F.bool_or(F.abs(F.col(y)) < tol).alias("seam_y"))


def on_canvas(mosaicked: DataFrame, canvas: DataFrame, time: str = "time", keys=("iy", "ix")) -> DataFrame:
    """S6 + J8 for B7: every cell of the canvas at every step of the mosaic; cells that no tile covers have nulls.

    Steps are few (one row each) and come as one array, so cells are repeated by a generator, not by a cross
    join; the mosaic is then joined to them by its key.
    """
    steps = mosaicked.select(time).distinct().agg(F.sort_array(F.collect_list(time)).alias("s")).scalar()
    cells = canvas.select(*keys).withColumn("_steps", steps).select(*keys, F.explode("_steps").alias(time))
    return cells.join(mosaicked, [*keys, time], "left")
