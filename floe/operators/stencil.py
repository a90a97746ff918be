"""Spatial stencils on sparse grids: slope (W6) and exact distance transform."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.session import materialize

# The grouped Arrow function below runs on executors. Pickle this module by
# value so executors need only numpy/pandas, not an installed copy of floe.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def neighbour(value: str, along: str, across: list[str], offset: int):
    """Value of the cell ``offset`` steps away along an index (RANGE frame).

    Null when that cell has no row - exact on sparse tables, unlike lag/lead.
    """
    w = Window.partitionBy(*across).orderBy(along).rangeBetween(offset, offset)
    return F.first(value).over(w)


def slope(df: DataFrame, value: str, ny: int, nx: int, res_y: float = 500.0, res_x: float = 500.0,
          by: tuple[str, ...] = (), out: str = "slope", block: int = 256) -> DataFrame:
    """|grad v| by central differences, edge-replicated at the grid border.

    Interior cells with a missing neighbour get null (NaN propagates in the
    array original); at the border the missing neighbour is the cell itself,
    so the border slope is half a one-sided difference.

    One shuffle: cells are grouped in ``block x block`` tiles (per ``by``),
    and a cell on a tile border is also sent, as a halo copy, to the
    neighbouring tile (a one-cell overlap, replication about 4/block, 1.6% at 256). After
    one hash partitioning by (tile, by), the column and row windows, both
    partitioned by the tile plus one index, reuse it and need only sorts.
    A tile holds at most (block + 2)^2 cells per step.
    """
    v = F.col(value)
    B = int(block)
    ty, tx = F.floor(F.col("iy") / B).cast("int"), F.floor(F.col("ix") / B).cast("int")
    def copy(dy, dx, home, keep):
        return F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(home).alias("home"),
                        F.coalesce(keep, F.lit(False)).alias("keep"))
    copies = F.array(
        copy(0, 0, True, F.lit(True)),
        copy(-1, 0, False, (F.col("iy") % B == 0) & (ty > 0)),
        copy(1, 0, False, F.col("iy") % B == B - 1),
        copy(0, -1, False, (F.col("ix") % B == 0) & (tx > 0)),
        copy(0, 1, False, F.col("ix") % B == B - 1))
    e = df.select("*", F.explode(copies).alias("_c")).where(F.col("_c.keep"))
    e = e.withColumns({"_ty": ty + F.col("_c.dy"), "_tx": tx + F.col("_c.dx"), "_home": F.col("_c.home")}).drop("_c")
    e = e.repartition("_ty", "_tx", *by)
    tile = ["_ty", "_tx", *by]
    up = neighbour(value, "iy", [*tile, "ix"], -1)
    down = neighbour(value, "iy", [*tile, "ix"], 1)
    left = neighbour(value, "ix", [*tile, "iy"], -1)
    right = neighbour(value, "ix", [*tile, "iy"], 1)
    d = e.withColumns({"_up": F.when(F.col("iy") == 0, v).otherwise(up),
                       "_dn": F.when(F.col("iy") == ny - 1, v).otherwise(down)})
    d = d.withColumns({"_lf": F.when(F.col("ix") == 0, v).otherwise(left),
                       "_rt": F.when(F.col("ix") == nx - 1, v).otherwise(right)})
    d = d.where(F.col("_home"))
    gy = (F.col("_dn") - F.col("_up")) / F.lit(2.0 * res_y)
    gx = (F.col("_rt") - F.col("_lf")) / F.lit(2.0 * res_x)
    return d.withColumn(out, F.sqrt(gx * gx + gy * gy).cast("float")).drop(
        "_up", "_dn", "_lf", "_rt", "_ty", "_tx", "_home")


def _column_profile(sources: DataFrame, ny: int) -> DataFrame:
    """Pass 1 of W7: distance (in rows) from every row to the nearest source in each column.

    For each column with sources, consecutive source rows ``r_j < r_{j+1}``
    cover the rows between them; rows above the first / below the last use
    the single nearest one. Output ``(iy, ix, g)`` - the column profile of the
    grid, bounded by the grid size, generated with ``explode`` (no pairs).
    """
    w = Window.partitionBy("ix").orderBy("iy")
    s = sources.select("iy", "ix").withColumns({"_prev": F.lag("iy").over(w), "_next": F.lead("iy").over(w)})
    lo = F.when(F.col("_prev").isNull(), F.lit(0)).otherwise(F.col("iy"))
    hi = F.when(F.col("_next").isNull(), F.lit(ny - 1)).otherwise(F.col("_next") - 1)
    e = s.select("ix", "iy", "_next", F.explode(F.sequence(lo, F.greatest(hi, lo))).alias("row"))
    g_after = F.col("row") - F.col("iy")
    g_before = F.col("_next") - F.col("row")
    g = F.when(F.col("row") < F.col("iy"), F.col("iy") - F.col("row")) \
         .when(F.col("_next").isNull(), g_after) \
         .otherwise(F.least(g_after, g_before))
    # rows above the first source of a column: covered by the first source's lower range
    return e.select(F.col("row").alias("iy"), "ix", g.cast("long").alias("g"))


#: Stands for "no source in this column": never the lowest parabola where there is another.
_FAR = float(1 << 50)


def _envelopes(q: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower envelopes of the parabolas (t - q_i)^2 + f[r, i], for all rows r at once.

    Returns parabola numbers ``v`` and left ends ``z`` by row, and the last used position ``k``.
    A step adds one column to every row's envelope; rows that must drop parabolas first do so
    together, so the Python steps are linear in the columns and not in the cells.
    """
    rows, n = f.shape
    v = np.zeros((rows, n), np.int64)
    z = np.full((rows, n), -np.inf)
    k = np.zeros(rows, np.int64)
    key = f + q.astype(np.float64) ** 2
    for i in range(1, n):
        left = np.arange(rows)
        while len(left):
            top = k[left]
            j = v[left, top]
            cross = (key[left, i] - key[left, j]) / (2.0 * (q[i] - q[j]))
            below = cross <= z[left, top]
            first = below & (top == 0)
            put = left[~below | first]
            k[put] = np.where(first, 0, top + 1)[~below | first]
            v[put, k[put]] = i
            z[put, k[put]] = np.where(first, -np.inf, cross)[~below | first]
            left = left[below & ~first]
            k[left] -= 1
    return v, z, k


def _rows_transform(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pass 2 for a block of grid rows: squared distances of the targets (``kind`` 1) to the profile (``kind`` 0)."""
    src, tgt = pdf[pdf["kind"] == 0], pdf[pdf["kind"] == 1]
    out = pd.DataFrame({"iy": tgt["iy"].astype("int32").to_numpy(), "ix": tgt["ix"].astype("int32").to_numpy()})
    if not len(src) or not len(tgt):
        return out.assign(d2=pd.array([None] * len(out), dtype="Int64"))
    q, col = np.unique(src["ix"].to_numpy(np.int64), return_inverse=True)
    iy, row = np.unique(src["iy"].to_numpy(np.int64), return_inverse=True)
    f = np.full((len(iy), len(q)), _FAR)
    f[row, col] = src["g"].to_numpy(np.float64) ** 2
    v, z, k = _envelopes(q, f)
    best = np.full(len(out), _FAR)
    at = out["iy"].to_numpy(np.int64)
    order = np.argsort(at, kind="stable")
    begin, end = np.searchsorted(at[order], iy), np.searchsorted(at[order], iy, side="right")
    for r in range(len(iy)):
        mine = order[begin[r]: end[r]]
        t = out["ix"].to_numpy(np.int64)[mine]
        near = np.searchsorted(z[r, : k[r] + 1], t, side="right") - 1
        for d in (-1, 0, 1):  # ends are rounded: look at the neighbours too, exactly
            j = v[r, np.clip(near + d, 0, k[r])]
            best[mine] = np.minimum(best[mine], (t - q[j]) ** 2.0 + f[r, j])
    return out.assign(d2=pd.array(np.where(best < _FAR, best, 0).astype(np.int64), dtype="Int64")).assign(
        d2=lambda d: d["d2"].mask(pd.Series(best >= _FAR)))


def distance_to_sources(cells: DataFrame, is_source, ny: int, res: float = 500.0, out: str = "dist",
                        rows_per_group: int = 64) -> DataFrame:
    """Exact Euclidean distance from every cell to the nearest source cell.

    Two separable passes: (1) per column, the nearest source row (window +
    explode, bounded by the grid); (2) per row, the lower envelope of
    parabolas over columns, in a grouped Arrow function that handles all rows
    of its group at once. A group is a block of ``rows_per_group`` grid rows, so
    it holds at most 2 x rows_per_group x the grid width entries, whatever the
    data volume. Sources get 0; with no source anywhere the distance is null.
    The cells are written once and read, pruned to what each pass needs.
    """
    c = materialize(cells.withColumn("_src", is_source), "distance-cells")
    sources = c.where(F.col("_src")).select("iy", "ix")
    prof = _column_profile(sources, ny).select("iy", "ix", "g", F.lit(0).alias("kind"))
    targets = c.where(~F.col("_src") | F.col("_src").isNull()).select(
        "iy", "ix", F.lit(None).cast("long").alias("g"), F.lit(1).alias("kind"))
    rows = prof.unionByName(targets).join(targets.select("iy").distinct(), "iy", "left_semi")
    block = F.floor(F.col("iy") / F.lit(rows_per_group)).alias("_blk")
    d2 = rows.groupBy(block).applyInPandas(_rows_transform, schema="iy int, ix int, d2 long")
    dist = (F.sqrt(F.col("d2").cast("double")) * F.lit(res)).cast("float")
    far = c.where(~F.col("_src") | F.col("_src").isNull()).drop("_src").join(
        d2.select("iy", "ix", dist.alias(out)), ["iy", "ix"], "left")
    near = c.where(F.col("_src")).drop("_src").withColumn(out, F.lit(0.0).cast("float"))
    return near.unionByName(far)
