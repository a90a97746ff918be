"""Lowest-uncertainty mosaic: the four cases of the sequential first-tile-wins rule."""

import datetime as dt

from floe.operators import mosaic

T = dt.date(2000, 1, 1)


def _seq_rule(rows):
    """The sequential merge written out: start with tile 0, take new when sigma valid and smaller."""
    out = {}
    for key in {r[:3] for r in rows}:
        tiles = sorted([r for r in rows if r[:3] == key], key=lambda r: r[3])
        cur = next((r for r in tiles if r[3] == 0), None)
        for r in tiles:
            if r[3] == 0:
                continue
            if r[5] is not None and (cur is None or cur[5] is None or r[5] < cur[5]):
                cur = r
        if cur is not None:
            out[key] = (cur[4], cur[5], cur[3])
    return out


def test_mosaic_cases(spark):
    rows = [
        (0, 0, T, 0, 1.0, 0.5), (0, 0, T, 1, 2.0, 0.2), (0, 0, T, 2, 3.0, 0.2),   # overlap, tie -> earlier tile 1
        (0, 1, T, 0, 4.0, 0.1), (0, 1, T, 3, 5.0, 0.3),                             # first tile wins outright
        (0, 2, T, 0, 6.0, None), (0, 2, T, 1, 7.0, None),                           # no valid sigma -> tile 0 kept
        (0, 3, T, 0, 8.0, None), (0, 3, T, 2, 9.0, 0.4),                            # null first, valid later
        (0, 4, T, 1, 10.0, None),                                                   # only a non-first null: nothing
    ]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, tile_order int, delta_h double, delta_h_sigma double")
    got = {(r.iy, r.ix, r.time): (r.delta_h, r.delta_h_sigma, r.tile_order)
           for r in mosaic.mosaic(df, "delta_h_sigma").collect()}
    assert got == _seq_rule(rows)
    assert got[(0, 0, T)] == (2.0, 0.2, 1)
    assert got[(0, 2, T)] == (6.0, None, 0)
    assert (0, 4, T) not in got


def test_overlaps_and_argmin(spark):
    rows = [(0, 0, T, 0, 1.0, 0.5), (0, 0, T, 1, 2.0, 0.2), (0, 1, T, 0, 4.0, 0.1), (0, 1, T, 1, 4.0, None)]
    df = spark.createDataFrame(rows, "iy int, ix int, time date, tile_order int, delta_h double, delta_h_sigma double")
    ov = mosaic.overlaps(df, "delta_h_sigma").collect()
    assert [(r.ix, r.n_valid) for r in ov] == [(0, 2)]
    am = mosaic.argmin_overlaps(df, "delta_h_sigma").collect()
    assert [(r.ix, r.tile_order) for r in am] == [(0, 1)]
