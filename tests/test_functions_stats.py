"""Scalar functions, statistics and order checks (documented values)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from floe.functions import grid as gf
from floe.functions import proj, thermo, timefn
from floe.operators import stats


def test_days_to_timestamp(spark):
    r = spark.range(1).select(timefn.days_to_timestamp(F.lit(6209.5), "2002-01-01").alias("t")).first()
    assert r.t == dt.datetime(2019, 1, 1, 12, 0)


def test_inverse_projection_check_values(spark):
    rows = spark.createDataFrame([(0.0, 2082760.108542913), (-3071750.0, 3071750.0)], "x double, y double")
    lat, lon = proj.xy_to_latlon("x", "y")
    got = rows.select(lat.alias("lat"), lon.alias("lon")).collect()
    assert abs(got[0].lat + 71.0) < 1e-9 and abs(got[0].lon) < 1e-12
    assert abs(got[1].lat + 51.479369235) < 1e-8 and abs(got[1].lon + 45.0) < 1e-9
    for la in (-89.9, -75.0, -50.0):
        x, y = proj.latlon_to_xy_py(la, 33.0)
        back = spark.createDataFrame([(x, y)], "x double, y double").select(lat.alias("lat"), lon.alias("lon")).first()
        assert abs(back.lat - la) < 1e-9 and abs(back.lon - 33.0) < 1e-9


def test_pressure_and_freezing_point(spark):
    df = spark.createDataFrame([(-2483.0, 34.0, 1.0), (None, 34.0, 1.0), (100.0, 34.0, 1.0)],
                               "ice_draft double, so double, thetao double")
    out = df.withColumn("pressure", thermo.base_pressure()).withColumn("T_f", thermo.freezing_point()) \
            .withColumn("T_star", thermo.thermal_driving()).collect()
    assert out[0].pressure == 2483.0 and out[1].pressure is None and out[2].pressure == 0.0
    assert abs(out[0].T_f - (-0.0575 * 34 + 0.0901 - 7.61e-4 * 2483)) < 1e-5
    assert out[1].T_f is None


def test_rint_is_half_even_and_snap(spark):
    r = spark.range(1).select(F.rint(F.lit(2.5)).alias("a"), gf.snap(F.lit(1500.0), 1000).alias("b"),
                              gf.snap(F.lit(2500.0), 1000).alias("c")).first()
    assert r.a == 2.0 and r.b == 2000.0 and r.c == 2000.0


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(-20.0,), (20.0,), (0.0,), (25.0,)], "v double")
    got = {r.bin: r.n for r in stats.histogram(df, "v", -20.0, 20.0, 100).collect()}
    assert got == {1: 1, 100: 1, 51: 1}


def test_percentiles_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    r = stats.percentiles(df, "v").first()
    assert abs(r.p02 - 1.06) < 1e-12 and abs(r.p98 - 3.94) < 1e-12


def test_radix_selection_equals_numpy(spark, monkeypatch):
    import math

    import numpy as np

    from floe.operators import quantiles
    rng = np.random.default_rng(8)
    wide = rng.normal(size=4000) * 10.0 ** rng.integers(-300, 300, 4000)
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, -1.0, 0.5, 2.0 ** 52, 3.0]
    edges += [math.nextafter(2.0 ** k, s) for k in (-1000, -3, 0, 1, 77, 1000) for s in (-math.inf, math.inf)]
    ties = [7.25] * 3000 + [-1.5] * 900 + list(range(100))
    ps = [0.0, 0.001, 0.02, 0.25, 1 / 3, 0.5, 0.975, 0.999, 1.0]
    for values in (wide.tolist(), edges, ties, [4.5] * 50, [2.0]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        want = [float(np.sort(values)[int(p * (len(values) - 1))]) if (p * (len(values) - 1)).is_integer() else None for p in ps]
        for finish in (0, 10, 1 << 16):  # all four digits, or values fetched early
            monkeypatch.setattr(quantiles, "FINISH", finish)
            got = quantiles.quantile_values(df, "v", ps)
            assert all(w is None or g == w for g, w in zip(got, want))
            if max(map(abs, values)) < 1e300:
                assert np.allclose(got, np.quantile(values, ps), rtol=1e-12, atol=0)
    df = spark.createDataFrame([(v,) for v in [*edges, *wide.tolist(), math.inf, -math.inf]], "v double")
    first, rest = quantiles.order_digits(F.col("v"))
    rows = df.select("v", first.alias("f"), rest.alias("r")).collect()
    assert all(quantiles.value_of(r.f, r.r) == r.v for r in rows)
    assert [r.v for r in sorted(rows, key=lambda r: (r.f, r.r))] == sorted(r.v for r in rows)
    assert quantiles.quantile_values(df.where("v IS NULL"), "v", [0.5]) == [None]


def test_quantiles_take_four_passes_at_most(spark, monkeypatch):
    from floe.operators import quantiles
    monkeypatch.setattr(quantiles, "FINISH", 0)
    df = spark.range(5000).select((F.col("id") * 0.37).alias("v"))
    passes = []
    frame = type(df.groupBy("v").agg(F.count("v")))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: passes.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    quantiles.quantile_values(df, "v", [i / 40 for i in range(41)])
    assert len(passes) <= 4 and all(p.count("Exchange") == 1 and "Sort" not in p and "Join" not in p for p in passes)


def test_percentile_names_differ(spark):
    from floe.operators import quantiles
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert stats.percentiles(df, "v", (0.001, 0.002, 0.02, 0.975)).columns == ["p00_1", "p00_2", "p02", "p97_5"]
    with pytest.raises(ValueError):
        quantiles.percentile_names([0.5, 0.5])


def test_step_sketches_merge_within_rank_error(spark):
    import numpy as np

    from floe.operators import quantiles
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.exponential(5, 40_000), np.full(20_000, 3.0), rng.normal(50, 1, 20_000)])
    df = spark.createDataFrame([(int(i % 30), float(v)) for i, v in enumerate(values)] + [(31, None), (31, float("nan"))], "time int, v double")
    sketches = quantiles.step_sketches(df, "v")
    assert sketches.count() == 31 and {r.n for r in sketches.where("time = 31").collect()} == {0}
    worst = 0.0
    for r in quantiles.sketch_quantiles(sketches, [0.01, 0.25, 0.5, 0.9, 0.99]).collect():
        worst = max(worst, np.mean(values < r.q) - r.p, r.p - np.mean(values <= r.q))
    assert worst <= 0.005  # README states the figure


def test_ten_thousand_buckets_are_one_small_expression(spark):
    import bisect
    bounds = [i * 0.5 for i in range(9_999)]
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.25, 0.5, 2500.1, 4999.0, 1e9, None, *bounds[::1000]]], "v double")
    b = stats.bucket_of(F.col("v"), bounds)
    rows = df.select("v", b.alias("b")).collect()
    assert all(r.b == (0 if r.v is None else bisect.bisect_right(bounds, r.v)) for r in rows)
    nodes = lambda n: df.select(stats.bucket_of(F.col("v"), [float(i) for i in range(n)]))._jdf.queryExecution().optimizedPlan().expressions().apply(0).treeString().count("\n")
    assert nodes(9_999) == nodes(9)
    assert stats.positions(spark.range(30_000).select((F.col("id") * 3).alias("t")), "t", 10_000).where("pos * 3 <> t").count() == 0


def test_gaps_across_range_partitions_match_sorted_diff(spark):
    import random
    random.seed(5)
    base = dt.datetime(2024, 1, 1)
    ts = sorted({base + dt.timedelta(minutes=random.randint(0, 50000)) for _ in range(500)})
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = sorted((r.prev_ts, r.ts, r.gap) for r in stats.consecutive_gaps(df, "ts", 60_000_000, partitions=7).collect())
    ref = sorted((a, b, int((b - a).total_seconds() // 60)) for a, b in zip(ts, ts[1:]))
    assert got == ref


def test_monotonic_by_successor_join(spark):
    inc = spark.createDataFrame([(i, float(i * 500)) for i in range(10)], "p int, v double")
    r = stats.successor_violations(inc, "p", "v", True).first()
    assert r.monotonic and r.n_steps == 9
    bad = spark.createDataFrame([(0, 0.0), (1, 5.0), (2, 4.0)], "p int, v double")
    assert not stats.successor_violations(bad, "p", "v", True).first().monotonic


def test_range_bucket_tree_matches_counting(spark):
    import bisect
    import random
    random.seed(3)
    vals = [random.uniform(-50, 50) for _ in range(300)] + [0.0, 10.0, -10.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = stats.range_bucket(df, "v", 13)
    got = [(r.v, r.b) for r in df.select("v", b.alias("b")).collect()]
    bounds = sorted({float(x) for x in df.approxQuantile("v", [i / 13 for i in range(1, 13)], 0.001)})
    for v, bk in got:
        assert bk == bisect.bisect_right(bounds, v)
    assert len({bk for _, bk in got}) == len(bounds) + 1
