"""Mixing sources to target weights with a time-varying curriculum (DataFrame functions only).

1. A document's size is its number of words; a source's size is the sum over its documents.
2. Sources, in code point order with null last, take the cyclic weights. Targets share all
   sizes by weight, stop at ``max_repeat`` times the source's size, and the excess is shared
   again by weight: water filling, solved in closed form over the table of sources.
3. Each source is an endless stream of laps over its documents in hash order. Its rate schedule
   (piecewise linear in training time) integrates to its target. A copy is taken when its
   midpoint lies below the target, and its training position is the time at which the source's
   cumulative demand reaches that midpoint.
4. Documents are range-sorted by position.

The prefix sums of a source are split into hash ranges: sums per (source, range), offsets over that
small table, and a running sum inside each range. No source is ever handled by one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import WORD, unused

#: Documents aimed at in one hash range of a source.
RANGE_ROWS = 20_000
#: (time, rate) knots by weight slot: light sources early, heavy ones late.
DEFAULT_CURRICULUM = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A key that is never null: null becomes '', every other name gets a leading letter."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """``(_src, _s)`` per source -> ``(_src, _s, _slot, _t)`` with the water-filled target ``_t``.

    In ascending order of cap / weight the capped sources form a prefix. Products are
    compared as exact decimals. Windows run over one row per source.
    """
    order = Window.orderBy((F.col("_src") == "").cast("int"), "_src")
    slot = ((F.row_number().over(order) - 1) % len(weights)).cast("int")
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), F.col("_slot") + 1)
    rank = Window.orderBy(F.col("_s") / F.col("_w"), "_src")
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    rest = rank.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    dec = "decimal(38,0)"
    d = (sizes.withColumn("_slot", slot).withColumn("_w", w)
         .withColumn("_cap", F.col("_s") * max_repeat)
         .withColumn("_total", F.sum("_s").over(everything))
         .withColumn("_cb", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_wr", F.sum("_w").over(rest))
         .withColumn("_capped", F.col("_cap").cast("decimal(19,0)") * F.col("_wr").cast("decimal(18,0)")
                     <= F.col("_w").cast("decimal(18,0)") * (F.col("_total") - F.col("_cb")).cast("decimal(19,0)"))
         .withColumn("_left", F.col("_total") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0)))
         .withColumn("_wsum", F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(everything)))
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        F.col("_w").cast("double") * F.col("_left").cast("double") / F.col("_wsum").cast("double"))
    return d.select("_src", "_s", "_slot", target.alias("_t"))


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Knots -> (t0, r0, slope, area before, area after), areas scaled to a total of one."""
    ts = [float(t) for t, _ in knots]
    if ts[0] != 0.0 or ts[-1] != 1.0 or any(b <= a for a, b in zip(ts, ts[1:])) or any(r < 0 for _, r in knots):
        raise ValueError("a schedule has rates >= 0 at strictly increasing times from 0 to 1")
    areas = [(r0 + r1) / 2 * (t1 - t0) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
    total = sum(areas)
    if total <= 0:
        raise ValueError("a schedule integrates to more than zero")
    out, done = [], 0.0
    for ((t0, r0), (t1, r1)), a in zip(zip(knots, knots[1:]), areas):
        out.append((t0, r0 / total, (r1 - r0) / (t1 - t0) / total, done / total, (done + a) / total))
        done += a
    return out


def invert_schedule(slot: Column, share: Column, curriculum) -> Column:
    """Time at which the integrated rate of the slot's schedule reaches ``share`` (0..1)."""
    def one(knots):
        expr = F.lit(1.0)
        for t0, r0, m, a0, a1 in reversed(_segments(knots)):
            d = F.greatest(share - F.lit(a0), F.lit(0.0))
            root = F.lit(r0) + F.sqrt(F.lit(r0 * r0) + F.lit(2.0 * m) * d)
            expr = F.when(share <= F.lit(a1), F.lit(t0) + F.when(root > 0, F.lit(2.0) * d / root).otherwise(F.lit(0.0))).otherwise(expr)
        return expr
    out = F.lit(None).cast("double")
    for i, knots in enumerate(curriculum):
        out = F.when(slot == i, one(knots)).otherwise(out)
    return F.least(out, F.lit(1.0))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, curriculum=DEFAULT_CURRICULUM,
        range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every row of ``docs`` with one more column ``mix`` (an input column of that name is replaced).

    ``mix`` is a struct of ``size``, ``source_size``, ``target`` (of the source), ``copies``,
    ``taken`` (size x copies) and ``positions`` (training time in 0..1 of each copy).

    Null text has size 0; a null source is a source of its own; a null id is hashed like an
    empty one. Tied and repeated rows are ordered by id, size and text hash, so reruns agree. In a
    source without any word each document is taken once, as its demand is met by nothing. An empty
    table gives an empty table.
    """
    if len(curriculum) != len(weights):
        raise ValueError("one schedule per weight")
    docs = docs.drop("mix")
    names = docs.columns
    # columns by position: no clash with the names below, and those that nobody reads stay in the files
    src = docs.toDF(*[f"__{i}" for i in range(len(names))])
    at = {n: F.col(f"__{i}") for i, n in enumerate(names)}
    n_ranges = min(1 << 20, max(16, math.ceil(docs.count() / range_rows)))
    key = F.md5(F.coalesce(at[id_col].cast("string"), F.lit("")).cast("binary"))
    base = src.select("*", _source_key(at[source_col]).alias("_src"), word_count(at[text_col]).alias("_z"),
                      key.alias("_k"), at[id_col].alias("_id"), F.xxhash64(at[text_col]).alias("_th"))
    base = base.withColumn("_r", F.floor(F.conv(F.substring("_k", 1, 8), 16, 10).cast("long") * n_ranges / F.lit(1 << 32)).cast("int"))

    sums = base.groupBy("_src", "_r").agg(F.sum("_z").alias("_rz"))
    sources = source_targets(sums.groupBy("_src").agg(F.sum("_rz").alias("_s")), weights, max_repeat)
    w_off = Window.partitionBy("_src").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.join(sources, "_src").withColumn("_off", F.coalesce(F.sum("_rz").over(w_off), F.lit(0))).drop("_rz")

    w_in = Window.partitionBy("_src", "_r").orderBy("_k", "_id", "_z", "_th").rowsBetween(Window.unboundedPreceding, -1)
    d = base.join(offsets, ["_src", "_r"]).withColumn("_c", F.col("_off") + F.coalesce(F.sum("_z").over(w_in), F.lit(0)))
    twice = F.col("_c") * 2 + F.col("_z")
    laps = F.ceil((F.col("_t") * 2 - twice.cast("double")) / (F.col("_s") * 2).cast("double"))
    copies = F.when(F.col("_s") == 0, F.lit(1)).otherwise(F.greatest(F.lit(0), F.least(F.lit(max_repeat), laps))).cast("long")
    d = d.withColumn("_n", copies).withColumn("_mid", twice.cast("double") / 2)
    laps_taken = F.when(F.col("_n") > 0, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(F.array().cast("array<bigint>"))
    share = lambda lap: F.when(F.col("_t") > 0, (F.col("_mid") + lap * F.col("_s")) / F.col("_t")).otherwise(F.lit(0.0))
    positions = F.transform(laps_taken, lambda lap: invert_schedule(F.col("_slot"), share(lap), curriculum))
    info = F.struct(F.col("_z").alias("size"), F.col("_s").alias("source_size"), F.col("_t").alias("target"),
                    F.col("_n").alias("copies"), (F.col("_z") * F.col("_n")).alias("taken"), positions.alias("positions"))
    return d.select(*[at[n].alias(n) for n in names], info.alias("mix"))


def by_position(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document, range-sorted by its first position; documents not taken come last, spread by hash."""
    last = F.lit(2.0) + F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    at = F.coalesce(F.get(F.col("mix.positions"), F.lit(0)), last)
    return _sorted(mixed.withColumn(name := unused(mixed, "_at"), at), name, id_col)


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per taken copy in training order, with the columns of the documents."""
    name = unused(mixed, "_at")
    return _sorted(mixed.withColumn(name, F.explode("mix.positions")), name, id_col).drop("mix")


def _sorted(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    return rows.repartitionByRange(F.col(name), F.col(id_col)).sortWithinPartitions(name, id_col).drop(name)
