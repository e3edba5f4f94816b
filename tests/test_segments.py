"""Features of series cut into segments against the sequential loop and the window plan."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsight.operators.indicators import FEATURES, feature_set
from barsight.operators.segments import HALO, long_feature_set, number_long_series, segment_scans, split_series
from tests.sequential import features as seq_features
from tests.test_indicators import close_enough, frame, make_bars

KEYS = ["rn", "n_bars", "next_close", "atrr_3"]


def minute_bars(n, seed):
    """n bars a minute apart, as arrays."""
    rng = np.random.default_rng(seed)
    close = 100.0 + np.cumsum(rng.normal(0, 0.05, n)) % 50
    high, low = close + rng.uniform(0, 1, n), close - rng.uniform(0, 1, n)
    return pd.DataFrame({"ticker": "T", "date": pd.date_range("2020-01-01", periods=n, freq="min"), "open": close,
                         "high": high, "low": low, "close": close, "volume": rng.integers(0, 1000, n).astype(float)})


def test_segments_equal_the_sequential_loop(spark):
    bars = make_bars(1500, seed=11)
    for b in bars[300:900]:                                     # flat for more than two segments
        b.update(open=50.0, high=51.0, low=49.0, close=50.0)
    for b in bars[500:1150]:                                    # no volume for longer than the halo
        b["volume"] = None
    got = long_feature_set(frame(spark, bars), segment=256, partitions=5).orderBy("date").collect()
    want = seq_features(bars)
    assert [r["rn"] for r in got] == list(range(1500)) and {r["n_bars"] for r in got} == {1500}
    for i, (g, w) in enumerate(zip(got, want)):
        assert g["next_close"] == (bars[i + 1]["close"] if i < 1499 else None)
        for name in (*FEATURES, "atrr_3"):
            assert close_enough(g[name], w[name], rel=1e-7), (i, name, g[name], w[name])


def test_segments_equal_the_window_plan_with_null_closes_and_keys(spark):
    a, b = make_bars(700, seed=2), make_bars(30, seed=3)
    for i in [0, 5, 6, 255, 256, 257, 400, 511, 512]:
        a[i]["close"] = None
    rows = (frame(spark, a).unionByName(frame(spark, b).withColumn("ticker", F.lit("short")))
            .unionByName(frame(spark, b).withColumn("ticker", F.lit(None).cast("string"))))
    rows = rows.withColumn("_seg", F.lit("clash"))              # a column that clashes is simply not read
    want = feature_set(rows).orderBy("ticker", "date").collect()
    got = long_feature_set(rows, segment=256, partitions=4).orderBy("ticker", "date").collect()
    assert len(got) == len(want) == 760 and got[0].__fields__ == want[0].__fields__
    for g, w in zip(got, want):
        assert (g["ticker"], g["date"]) == (w["ticker"], w["date"])
        for name in (*FEATURES, *KEYS):
            assert close_enough(g[name], w[name], rel=1e-7), (g["ticker"], g["rn"], name, g[name], w[name])


def test_empty_and_too_short_segments(spark):
    empty = frame(spark, make_bars(3)).limit(0)
    assert long_feature_set(empty).count() == 0
    with pytest.raises(ValueError):
        long_feature_set(empty, segment=HALO - 1)


def test_a_million_bars_of_one_ticker_over_many_tasks(spark):
    """1,000,000 bars: every running value against a loop, rolling ones against pandas."""
    n = 1_000_000
    pdf = minute_bars(n, 5)
    bars = spark.createDataFrame(pdf)
    c, h, lo, v = (pdf[x].to_numpy() for x in ("close", "high", "low", "volume"))
    columns = ["rn", "ema_50", "atrr_14", "rsi_14", "obv", "sma_200", "adx_14", "macds_12_26_9"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = long_feature_set(bars, partitions=8).select(*columns, F.spark_partition_id().alias("task")).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got["task"].nunique() >= 8 and got["task"].value_counts().max() < n / 4
    got = got.sort_values("rn", ignore_index=True)
    assert len(got) == n and (got["rn"].to_numpy() == np.arange(n)).all()

    def seeded(xs, length, alpha):
        y, res = float(np.mean(xs[:length])), [math.nan] * (length - 1)
        res.append(y)
        for x in xs[length:]:
            y = alpha * x + (1 - alpha) * y
            res.append(y)
        return res

    def decayed(xs, length):
        y, r, res = 0.0, 1 - 1 / length, []
        for x in xs:
            y = r * y + x
            res.append(y)
        return np.array(res)

    cl, prev = c.tolist(), np.concatenate([[np.nan], c[:-1]])
    tr = np.fmax(h - lo, np.fmax(abs(h - prev), abs(lo - prev)))
    d = np.diff(c, prepend=c[0])
    up, dn = np.diff(h, prepend=h[0]), -np.diff(lo, prepend=lo[0])
    gain, loss = decayed(np.maximum(d, 0).tolist(), 14), decayed(np.maximum(-d, 0).tolist(), 14)
    plus = decayed(np.where((up > dn) & (up > 0), up, 0.0).tolist(), 14)
    minus = decayed(np.where((dn > up) & (dn > 0), dn, 0.0).tolist(), 14)
    dx = 100 * abs(plus - minus) / (plus + minus)
    macd = np.array(seeded(cl, 12, 2 / 13)) - np.array(seeded(cl, 26, 2 / 27))
    want = {"ema_50": seeded(cl, 50, 2 / 51), "atrr_14": seeded(tr.tolist(), 14, 1 / 14),
            "rsi_14": np.where(np.arange(n) >= 14, 100 * gain / (gain + loss), np.nan),
            "obv": np.cumsum(np.where(np.arange(n) == 0, v, np.sign(d) * v)),
            "sma_200": pdf["close"].rolling(200).mean(),
            "macds_12_26_9": [math.nan] * 25 + seeded(macd[25:].tolist(), 9, 0.2)}
    num, den = decayed(np.where(np.arange(n) >= 14, np.nan_to_num(dx), 0.0).tolist(), 14), decayed((np.arange(n) >= 14) * 1.0, 14)
    want["adx_14"] = np.where(np.arange(n) >= 27, num / np.where(den == 0, 1, den), np.nan)
    for name, values in want.items():
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), np.asarray(values, dtype=float), rtol=1e-7, atol=1e-8, err_msg=name)


def test_scans_over_segments_and_bad_rates(spark):
    rows = spark.createDataFrame([("s", dt.date(2020, 1, 1) + dt.timedelta(i), float(i % 7)) for i in range(900)], "k string, t date, b double")
    split = split_series(number_long_series(rows, ["k"], "t", 3), 256).withColumn("_blk", F.lit(0))
    mine = F.when(F.col("_own"), F.col("b"))
    got = segment_scans(split, [("y", mine, 0.9)], 256).where("_own").orderBy("rn").collect()
    y = 0.0
    for i, r in enumerate(got):
        y = 0.9 * y + i % 7
        assert math.isclose(r["y"], y, rel_tol=1e-10, abs_tol=1e-10)
    with pytest.raises(ValueError):
        segment_scans(split, [("y", mine, 0.01)], 256)


def test_a_bar_takes_little_room_on_disk(spark):
    """Only numbered bars and carries are stored, not the rows of all stages with their halos."""
    from pathlib import Path
    from urllib.parse import urlparse
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)

    def used():
        return sum(p.stat().st_size for p in [*folder.rglob("*"), *folder.parent.glob("stored-*/*")] if p.is_file())

    bars, before = spark.createDataFrame(minute_bars(40_000, 6)), used()
    assert long_feature_set(bars, segment=256, partitions=4).count() == 40_000
    assert used() - before < 200 * 40_000
