"""Grid arithmetic as Column expressions (no driver arrays, no UDFs)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from floe import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Grid:
    """Regular grid of cell centres: x ascending from ``x0``, y descending from ``y0``."""
    x0: float
    y0: float
    res: float
    nx: int | None = None
    ny: int | None = None

    @classmethod
    def from_bounds(cls, x_min, x_max, y_min, y_max, res) -> "Grid":
        """Cell centres inside [min, max] as ``arange(min + res/2, max, res)``."""
        nx = int(round((x_max - x_min) / res))
        ny = int(round((y_max - y_min) / res))
        return cls(x_min + res / 2.0, y_max - res / 2.0, res, nx, ny)

    def x(self, ix="ix") -> Column:
        """coordinate from index."""
        return (F.lit(self.x0) + col(ix).cast("double") * F.lit(self.res)).cast("double")

    def y(self, iy="iy") -> Column:
        return (F.lit(self.y0) - col(iy).cast("double") * F.lit(self.res)).cast("double")

    def ix(self, x="x") -> Column:
        """Rule 1.4.5: index from coordinate, half-even rounding."""
        return F.rint((col(x) - F.lit(self.x0)) / F.lit(self.res)).cast("int")

    def iy(self, y="y") -> Column:
        return F.rint((F.lit(self.y0) - col(y)) / F.lit(self.res)).cast("int")


MASTER = Grid.from_bounds(C.GRID_X_MIN, C.GRID_X_MAX, C.GRID_Y_MIN, C.GRID_Y_MAX, C.GRID_RES)
# The fixture grid uses the master grid's origin and spacing.
FIXTURE_GRID = Grid(MASTER.x0, MASTER.y0, MASTER.res, 50, None)


def snap(c, res: float) -> Column:
    """snap to the nearest multiple of ``res``, ties to even (NumPy rule)."""
    return F.rint(col(c) / F.lit(float(res))) * F.lit(float(res))


def nan_to_null(c, dtype: str = "double") -> Column:
    """Rule 1.4.1: NaN means missing; turn it into SQL NULL once, at ingest (type kept)."""
    return F.nanvl(col(c), F.lit(None).cast(dtype)).cast(dtype)


def is_finite(c) -> Column:
    """not null, not NaN, not infinite."""
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def isclose(a, b, atol: float = 1e-8, rtol: float = 1e-5) -> Column:
    """NumPy ``isclose``: |a - b| <= atol + rtol * |b|."""
    return F.abs(col(a) - col(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(col(b))


def cell_edges(c, res: float) -> tuple[Column, Column]:
    """F16: half-cell edges around a centre coordinate."""
    h = F.lit(res / 2.0)
    return col(c) - h, col(c) + h


def tile_of(i, tile: int = 2048) -> Column:
    """Chunk/tile id of an index (layout key for sinks, K4/K11)."""
    return F.floor(col(i) / F.lit(tile)).cast("int")


def truncate_text(c, limit: int = 100) -> Column:
    """strings longer than ``limit`` become their first ``limit-3`` chars + '...'."""
    s = col(c)
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit - 3), F.lit("..."))).otherwise(s)


def dense_run(entries, first, size, fill: Column) -> Column:
    """Array of ``size`` values: those of ``entries`` (structs ``p``, ``v``) at positions ``p - first``, ``fill`` where none is.

    Linear after one sort: before each entry stand as many fills as positions are skipped, and the last gap
    follows the last entry. A position held twice is an error when the plan runs.
    """
    run = F.array_sort(col(entries))
    first, size = (F.lit(v) if isinstance(v, int) else v for v in (first, size))

    def piece(cur, prev):
        skipped = F.coalesce(cur["p"] - first, size) - F.coalesce(prev["p"] - first, F.lit(-1)) - 1
        twice = F.raise_error(F.concat(F.lit("dense_run: a position is held twice: "), F.to_json(cur))).cast("int")
        fills = F.array_repeat(fill, F.when(skipped < 0, twice).otherwise(skipped).cast("int"))
        return F.when(cur.isNull(), fills).otherwise(F.concat(fills, F.array(cur["v"])))
    before = F.concat(F.array(F.lit(None)), run)
    return F.flatten(F.zip_with(run, before, piece))


#: The shifts and masks that spread 32 bits over the even bits of 64.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread_bits(c: Column) -> Column:
    x = c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def morton(iy="iy", ix="ix") -> Column:
    """Place of a cell on the Z-order curve: cells near each other in both directions get near keys."""
    return F.shiftleft(_spread_bits(col(iy)), 1).bitwiseOR(_spread_bits(col(ix)))
