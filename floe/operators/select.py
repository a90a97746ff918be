"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe import constants as C
from floe.functions.grid import col
from floe.operators.joins import broadcast_checked


def select_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Select the listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_tolerant(df: DataFrame, *cols: str) -> DataFrame:
    """Drop, ignoring absent columns."""
    return df.drop(*cols)


def keep_codes(df: DataFrame, c: str = "mask", codes=C.ICE_CODES) -> DataFrame:
    """P5: row filter by set membership (pushed into the scan as an IN filter)."""
    return df.where(F.col(c).isin(*codes))


def null_outside(df: DataFrame, cols: list[str], keep: Column) -> DataFrame:
    """Keep every row, null the listed columns where ``keep`` is not true."""
    return df.withColumns({c: F.when(keep, F.col(c)) for c in cols})


def drop_null(df: DataFrame, c: str) -> DataFrame:
    """Drop rows whose ``c`` is null (NaN already turned into null)."""
    return df.na.drop(subset=[c])


def time_slice(df: DataFrame, c: str, first_day: str, last_day: str) -> DataFrame:
    """Inclusive on both days (the last day is covered entirely)."""
    x = F.col(c)
    return df.where((x >= F.to_date(F.lit(first_day))) & (x < F.date_add(F.to_date(F.lit(last_day)), 1)))


def step_positions(df: DataFrame, time: str = "time") -> DataFrame:
    """P9 helper: distinct steps with their 0-based position and the number of steps.

    Numbered with a distributed rank (range partitions + per-partition
    offsets); data rows are never ordered globally and no window spans the axis.
    """
    from floe.operators.stats import positions
    return positions(df, time).withColumnRenamed("n", "n_steps")


def pick_steps(df: DataFrame, which: str = "middle", time: str = "time", every: int = 10) -> DataFrame:
    """Rows at the first / middle / last step, or at every ``every``-th step (semi-join)."""
    s = step_positions(df, time)
    cond = {"first": F.col("pos") == 0,
            "middle": F.col("pos") == F.floor(F.col("n_steps") / 2),
            "last": F.col("pos") == F.col("n_steps") - 1,
            "every": F.col("pos") % every == 0}[which]
    picked = s.where(cond).select(time)
    # one step is one row; a list of steps is counted first
    return df.join(broadcast_checked(picked) if which == "every" else F.broadcast(picked), time, "left_semi")


def strided_sample(df: DataFrame, every: int = 10, every_cell: int = 10, time: str = "time", keys=("iy", "ix")) -> DataFrame:
    """Every ``every``-th step (by its rank among all steps) and every ``every_cell``-th grid row and column (by index).

    The strides on the grid are plain filters, which reach the scan; the steps are a semi-join with the picked ones.
    """
    steps = step_positions(df, time).where(F.col("pos") % every == 0).select(time)
    for c in keys:
        df = df.where(F.col(c) % every_cell == 0)
    return df.join(broadcast_checked(steps), time, "left_semi")


def first_steps(df: DataFrame, n: int, time: str = "time") -> DataFrame:
    """Keep the first ``n`` time steps (test-mode runs), as a semi-join."""
    s = step_positions(df, time).where(F.col("pos") < n).select(time)
    return df.join(F.broadcast(s), time, "left_semi")  # n rows at most


def bbox_subset(df: DataFrame, ref: DataFrame, buffer: float, x="x", y="y") -> DataFrame:
    """P10: rows inside the extent of ``ref`` +/- ``buffer``.

    The extent is four scalar subqueries (computed in one pass): the comparison is a plain
    filter of the scan, not a join.
    """
    e = ref.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    x0, x1, y0, y1 = (e.select(c).scalar() for c in ("x0", "x1", "y0", "y1"))
    return df.where(F.col(x).between(x0 - buffer, x1 + buffer) & F.col(y).between(y0 - buffer, y1 + buffer))


def qc_null_out(df: DataFrame, c: str, lo: float = C.QC_LWE_MIN, hi: float = C.QC_LWE_MAX) -> DataFrame:
    """Strict range; values outside become null, rows stay."""
    v = F.col(c)
    return df.withColumn(c, F.when((v > lo) & (v < hi), v))


def add_time_if_missing(df: DataFrame, t, time: str = "time") -> DataFrame:
    """P13."""
    if time in df.columns:
        return df
    return df.withColumn(time, t if isinstance(t, Column) else F.lit(t))


def all_present(*cols) -> Column:
    """Null-aware guard."""
    out = None
    for c in cols:
        p = col(c).isNotNull()
        out = p if out is None else out & p
    return out


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """P15."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols if c in df.columns})


def replace_if_exists(df: DataFrame, cols, fn) -> DataFrame:
    """One ``withColumns`` over the listed columns that exist."""
    return df.withColumns({c: fn(c) for c in cols if c in df.columns})


def canonical_order(df: DataFrame, leading=("time", "y", "x")) -> DataFrame:
    """Leading dimension columns first, the rest in their current order."""
    lead = [c for c in leading if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def file_parts(path_col: Column) -> tuple[Column, Column]:
    """File name from a path, and the token after the first '_'."""
    name = F.element_at(F.split(path_col, "/"), -1)
    return name, F.try_element_at(F.split(name, "_"), F.lit(2))
