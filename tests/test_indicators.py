import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barsight.operators.indicators import FEATURES, feature_set
from tests.sequential import features as seq_features


def make_bars(n, ticker="T", seed=1, flat_every=0, volume_fn=None, start=dt.date(2020, 1, 6)):
    rng = random.Random(seed)
    rows, price = [], 100.0
    for i in range(n):
        price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
        if flat_every and i % flat_every == 0:
            hi = lo = op = cl = round(price, 2)
        else:
            op = price * (1 + rng.uniform(-0.01, 0.01))
            cl = price
            hi = max(op, cl) * (1 + rng.uniform(0, 0.02))
            lo = min(op, cl) * (1 - rng.uniform(0, 0.02))
        vol = volume_fn(i) if volume_fn else float(rng.randint(1, 1000))
        rows.append(dict(ticker=ticker, date=start + dt.timedelta(days=7 * i), open=op, high=hi,
                         low=lo, close=cl, volume=vol))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "ticker string, date date, open double, high double, low double, close double, volume double")


def close_enough(a, b, rel=1e-9, abs_=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return False
    return abs(a - b) <= max(abs_, rel * max(abs(a), abs(b)))


def compare(spark, rows, block=256):
    """Spark plan vs the sequential reference, series by series."""
    got = {(r["ticker"], r["date"]): r.asDict()
           for r in feature_set(frame(spark, rows), block=block).collect()}
    by_ticker = {}
    for row in rows:
        by_ticker.setdefault(row["ticker"], []).append(row)
    bad = []
    for series in by_ticker.values():
        for row, exp in zip(series, seq_features(series)):
            g = got[(row["ticker"], row["date"])]
            for f in FEATURES:
                if not close_enough(g[f], exp[f]):
                    bad.append((row["ticker"], row["date"], f, g[f], exp[f]))
    return bad


def test_series_lengths_match_sequential(spark):
    rows = []
    for n in [1, 13, 14, 15, 49, 50, 199, 200, 201]:
        rows += make_bars(n, ticker=f"L{n}", seed=n)
    assert compare(spark, rows) == []


def test_long_series_crosses_blocks(spark):
    rows = make_bars(700, seed=7, flat_every=5)
    assert compare(spark, rows) == []


def test_block_size_does_not_change_results(spark):
    rows = make_bars(300, seed=3)
    a = {r["date"]: r for r in feature_set(frame(spark, rows), block=4).collect()}
    b = {r["date"]: r for r in feature_set(frame(spark, rows), block=256).collect()}
    for d in a:
        for f in FEATURES:
            assert close_enough(a[d][f], b[d][f], rel=1e-9), (d, f, a[d][f], b[d][f])


def test_flat_bar_close_loc_is_half(spark):
    rows = make_bars(30, flat_every=1)
    vals = {r["close_loc"] for r in feature_set(frame(spark, rows)).collect()}
    assert vals == {0.5}


def test_zero_then_nonzero_volume(spark):
    rows = make_bars(25, volume_fn=lambda i: 0.0 if i < 3 else 10.0 + i)
    got = sorted(feature_set(frame(spark, rows)).collect(), key=lambda r: r["date"])
    assert got[1]["volume_delta"] is None  # 0/0
    assert got[3]["volume_delta"] is None  # x/0
    assert got[4]["volume_delta"] == pytest.approx(14.0 / 13.0 - 1)
    assert compare(spark, rows) == []


def test_null_volume_keeps_obv_running(spark):
    rows = make_bars(30, volume_fn=lambda i: None if i == 10 else 100.0)
    got = sorted(feature_set(frame(spark, rows)).collect(), key=lambda r: r["date"])
    assert got[10]["obv"] is None and got[11]["obv"] is not None
    assert got[10]["volume_delta"] == 0.0  # padded
    assert compare(spark, rows) == []


def test_close_outside_range_is_not_clamped(spark):
    rows = make_bars(20)
    rows[5]["close"] = rows[5]["high"] * 1.1
    got = sorted(feature_set(frame(spark, rows)).collect(), key=lambda r: r["date"])
    assert got[5]["close_loc"] > 1.0
    assert compare(spark, rows) == []


def test_oscillators_in_range_and_series_independent(spark):
    rows = make_bars(260, "A", seed=11) + make_bars(120, "B", seed=12)
    df = feature_set(frame(spark, rows))
    stats = df.agg(F.min("rsi_14"), F.max("rsi_14"), F.min("adx_14"), F.max("adx_14")).first()
    assert 0 <= stats[0] and stats[1] <= 100 and 0 <= stats[2] and stats[3] <= 100
    only_b = {r["date"]: r for r in feature_set(frame(spark, rows[260:])).collect()}
    for r in df.where("ticker = 'B'").collect():
        for f in FEATURES:
            assert close_enough(r[f], only_b[r["date"]][f])


def test_partitioning_does_not_change_results(spark):
    rows = make_bars(150, "A", seed=5) + make_bars(150, "B", seed=6)
    a = feature_set(frame(spark, rows).repartition(7)).orderBy("ticker", "date").collect()
    b = feature_set(frame(spark, list(reversed(rows))).coalesce(1)).orderBy("ticker", "date").collect()
    for x, y in zip(a, b):
        for f in FEATURES:
            assert close_enough(x[f], y[f], rel=1e-12)
