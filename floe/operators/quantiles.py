"""Quantiles of a column: exact by radix selection, approximate by mergeable sketches.

Exact: a double is mapped to digits whose order is the order of the values: sign, binary exponent and the
top 4 mantissa bits are the first digit, 16 mantissa bits each the other three. One pass counts the first
digit over all rows; the digit that holds a wanted rank is opened, and the next pass counts the next digit inside
the opened ones only. Every pass is one aggregate with map-side combination, so a value held by a third of all rows is one row
per task, nothing is sorted, and four passes fix any number of quantiles to the last bit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mantissa bits of the later digits, and of all of them together.
DIGIT, REST = 16, 48
#: Rows in opened digits from which on their different values are fetched at once.
FINISH = 1 << 16
_BIAS = 1075
_INFINITE = 2100 << 4
#: Nominal size of a sketch; the rank error of a merged one is measured in the tests.
SKETCH_K = 2000


def order_digits(v: Column) -> tuple[Column, Column]:
    """First digit and the other 48 bits of a double that is not NaN; pairs are ordered as the values (both zeros are one).

    Exact: dividing by a power of two loses nothing, and the exponent guessed by ``log2`` is set right by comparing.
    """
    a = F.abs(v)
    safe = F.when((a > 0) & (a < float("inf")), a).otherwise(F.lit(1.0))
    guess = F.floor(F.log2(safe))

    def power(e: Column) -> Column:
        return F.pow(F.lit(2.0), e.cast("double"))
    e = F.when(safe >= power(guess + 1), guess + 1).when(safe < power(guess), guess - 1).otherwise(guess)
    mantissa = ((safe / power(e) - 1) * F.lit(2.0 ** 52)).cast("long")
    first = F.when(a == 0, F.lit(0)).when(a == float("inf"), F.lit(_INFINITE)).otherwise((e + _BIAS) * 16 + F.shiftright(mantissa, REST)).cast("long")
    rest = F.when((a == 0) | (a == float("inf")), F.lit(0)).otherwise(mantissa.bitwiseAND(F.lit((1 << REST) - 1))).cast("long")
    return F.when(v < 0, -first).otherwise(first), F.when((v < 0) & (a < float("inf")), F.lit((1 << REST) - 1) - rest).otherwise(rest)


def value_of(first: int, rest: int) -> float:
    """The double with these digits."""
    size = abs(first)
    if size == 0:
        return 0.0
    sign = math.copysign(1.0, first)
    if size >= _INFINITE:
        return sign * math.inf
    rest = rest if sign > 0 else (1 << REST) - 1 - rest
    return sign * math.ldexp(float(1 << 52 | (size & 15) << REST | rest), (size >> 4) - _BIAS - 52)


def quantile_values(df: DataFrame, value: str, ps: Sequence[float]) -> list[float | None]:
    """Exact quantiles of a column, linear between neighbouring ranks (NumPy's default rule); None without values.

    Nulls and NaN are left out. ``df`` is read once per pass: at most four, fewer as soon as the opened digits
    hold ``FINISH`` rows. To the driver go at most 65,536 digit counts for each of the two ranks
    around a quantile, whatever the table's size.
    """
    col = F.col(value).cast("double")
    rows = df.select(col.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    first, rest = order_digits(F.col("v"))
    rows = rows.select("v", first.alias("first"), rest.alias("rest"))
    counts: dict[int, list[tuple[int, int]]] = {0: [tuple(r) for r in rows.groupBy("first").agg(F.count(F.lit(1))).collect()]}
    n = sum(c for _, c in counts[0])
    if n == 0:
        return [None] * len(ps)
    at = [p * (n - 1) for p in ps]
    ranks = {k: (0, k) for x in at for k in (math.floor(x), math.ceil(x))}  # rank -> (opened digits, rank inside them)
    found: dict[int, float] = {}
    for level in range(4):
        left, size = {}, 0
        for digits, cells in counts.items():
            cells.sort()
            wanted = sorted((inside, k) for k, (d, inside) in ranks.items() if d == digits)
            below = i = 0
            for digit, c in cells:
                opened = False
                while i < len(wanted) and wanted[i][0] < below + c:
                    left[wanted[i][1]] = ((digits << DIGIT) + digit if level else digit, wanted[i][0] - below)
                    opened, i = True, i + 1
                size += c if opened else 0
                below += c
        ranks = left
        if level == 3:
            found = {k: value_of(d >> REST, d & (1 << REST) - 1) for k, (d, _) in ranks.items()}
            break
        shift = REST - DIGIT * level
        prefix = F.shiftleft(F.col("first"), DIGIT * level) + F.shiftright(F.col("rest"), shift)
        inside = rows.select("v", prefix.alias("d"), F.shiftright("rest", shift - DIGIT).bitwiseAND(F.lit((1 << DIGIT) - 1)).alias("next")).where(
            F.col("d").isin(sorted({d for d, _ in ranks.values()})))
        if size <= FINISH:
            values: dict[int, list[tuple[float, int]]] = {}
            for r in inside.groupBy("d", "v").agg(F.count(F.lit(1)).alias("c")).collect():
                values.setdefault(r.d, []).append((r.v, r.c))
            for cells in values.values():
                cells.sort()
            for k, (d, rank) in ranks.items():
                for v, c in values[d]:
                    if rank < c:
                        found[k] = v
                        break
                    rank -= c
            break
        counts = {}
        for r in inside.groupBy("d", "next").agg(F.count(F.lit(1)).alias("c")).collect():
            counts.setdefault(r.d, []).append((r.next, r.c))
    out = []
    for x in at:
        lo, hi = found[math.floor(x)], found[math.ceil(x)]
        out.append(lo if lo == hi else lo + (hi - lo) * (x - math.floor(x)))
    return out


def percentile_names(ps: Sequence[float]) -> list[str]:
    """``p02`` for 0.02, ``p97_5`` for 0.975: a different name for every quantile."""
    names = []
    for p in ps:
        whole, _, part = f"{float(p) * 100:.10f}".rstrip("0").partition(".")
        names.append(f"p{int(whole):02d}" + (f"_{part}" if part else ""))
    if len(set(names)) < len(names):
        raise ValueError(f"the same quantile twice: {list(ps)}")
    return names


def step_sketches(df: DataFrame, value: str, by: Sequence[str] = ("time",), k: int = SKETCH_K) -> DataFrame:
    """A14 at scale: one mergeable quantile sketch (KLL) per group, ``(*by, sketch, n)``; nulls and NaN are left out.

    Built map-side, so one pass and one small shuffle. Written as a table, a new step adds its own row and no old data are read.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.when(~F.isnan(v), v), k).alias("sketch"), F.count(F.when(~F.isnan(v), v)).alias("n"))


def sketch_quantiles(sketches: DataFrame, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles ``(*by, p, q)`` from sketches merged per ``by`` (none: all); groups without values have none."""
    merged = sketches.where("n > 0").groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n")).where("n > 0")
    cells = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("q")) for p in ps]))
    return merged.select(*by, cells.alias("c")).select(*by, "c.p", "c.q")
