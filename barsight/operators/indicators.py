"""Technical indicators I1-I31.

Contract (the defining indicator package is not part of the reference, so
these conventions are fixed here and used verbatim by the oracle SQL):

* ``rn`` is the 0-based bar number of a series; ``C,H,L,V`` close/high/low/volume.
* Rolling statistics of length L are NULL unless the frame holds L non-null
  inputs.  Every division by zero gives NULL.
* EMA(n): NULL until n closes were seen; at that bar the mean of those n
  closes; then ``y = a*C + (1-a)*y_prev`` with ``a = 2/(n+1)``.
* MACD = EMA12 - EMA26; signal = the same seeded EMA(9) applied to MACD;
  histogram = MACD - signal.
* TR = max(H-L, |H-C_prev|, |L-C_prev|), first bar H-L.  ATR(n) is the seeded
  average of TR with ``a = 1/n`` (Wilder's original form).
* Wilder average W(n) (RSI, DM, ADX): ``sum r^(t-j) x_j / sum r^(t-j)`` over the
  non-null inputs, ``r = 1 - 1/n``, NULL until n inputs.
* RSI(n) = 100*W(gain)/(W(gain)+W(loss)); gain/loss from the first difference.
* +DM = up if up > down and up > 0 else 0 (down symmetric), up = H-H_prev,
  down = L_prev-L; DI = 100*W(DM)/ATR(n); DX = 100*|DI+ - DI-|/(DI+ + DI-);
  ADX = W(n) of DX.
* Stochastic: raw = 100*(C - min14 L)/(max14 H - min14 L); %K = SMA3(raw);
  %D = SMA3(%K).
* Bollinger(20, 2): population standard deviation.
* OBV: running sum of sign(C - C_prev)*V, first bar +V; NULL where V is NULL.
* volume_delta: percent change of V after forward-filling NULL volumes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.operators.panel import series_features, whole_series

from barsight.operators.series import BLOCK

# The names of the model's features, in the model's order.
FEATURES = [
    "sma_10", "sma_20", "sma_50", "sma_200",
    "ema_10", "ema_50",
    "adx_14",
    "macd_12_26_9", "macdh_12_26_9", "macds_12_26_9",
    "rsi_14", "rsi_5",
    "stochk_14_3_3", "stochd_14_3_3",
    "roc_1", "roc_3", "roc_5",
    "atrr_14", "atr_ratio",
    "bbl_20_2_0", "bbu_20_2_0", "bbb_20_2_0", "bbp_20_2_0",
    "obv", "rvol_20", "volume_delta",
    "price_vs_sma20", "price_vs_sma50", "price_vs_sma200",
    "dist_from_high", "dist_from_low", "close_loc",
]

OUT_ROWS = 8192  # rows of a batch of features


def feature_schema(numbered: DataFrame, by: list[str], t: str, keep: list[str]) -> T.StructType:
    """The columns of :func:`feature_set`; types of bars from ``numbered`` rows."""
    fields = {f.name: f for f in numbered.schema.fields}
    made = {c: T.StructField(c, T.DoubleType()) for c in ("next_close", *FEATURES, "atrr_3")}
    made["n_bars"] = T.StructField("n_bars", T.LongType(), False)
    names = [*by, t, "rn", "n_bars", "open", "high", "low", "close", "volume", "next_close", *keep, *FEATURES, "atrr_3"]
    return T.StructType([made.get(c) or fields[c] for c in names])


def feature_set(prices: DataFrame, by: list[str] | tuple = ("ticker",), t: str = "date",
                block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """The 32 model features for every bar, plus ``rn`` (bar number),
    ``n_bars`` (series length, A8), ``next_close`` (W3) and ``atrr_3``.

    ``prices`` needs ``by``, ``t``, open, high, low, close, volume.  ``by`` may
    be any series key, e.g. ``["ticker", "target_date"]`` for as-of histories.

    Plan: one hash exchange on ``by`` and one sort; the bars of a task, numbered
    and in order, go through the recursions and windows a panel of series at a
    time (:mod:`barsight.operators.panel`), in Arrow batches.  A task holds one
    series and some 65,000 bars.  ``block`` is the block of the scans in
    :mod:`barsight.operators.series`; no value depends on it.
    """
    by = list(by)
    keep = list(keep or [])
    base = prices.select(*by, t, "open", "high", "low", "close", "volume", *keep)
    w = Window.partitionBy(*by).orderBy(F.col(t).asc())
    df = base.withColumn("rn", F.row_number().over(w) - 1)
    made = [*FEATURES, "atrr_3"]
    schema = feature_schema(df, by, t, keep)
    names = schema.names

    def features(batches):
        for table in whole_series(batches, lambda batch: np.asarray(batch.column("rn")) == 0):
            found = series_features(table, np.asarray(table["rn"]), made)
            columns = [table[c] if c in table.column_names else pa.array(found[c], from_pandas=True) for c in names]
            yield from pa.table(columns, names=names).to_batches(max_chunksize=OUT_ROWS)

    return df.mapInArrow(features, schema)
