"""Incremental indicators as keyed streaming state.

The reference recomputes 300 bars per request.  For a stream of bars, the
exponential averages and running sums only need a few numbers per ticker:
this operator keeps them in the state store (``applyInPandasWithState``) and
emits the indicator values of every new bar.  State per ticker is constant
size; bars at or before the last processed date of a ticker are late and are
counted, not applied.

Values equal the batch feature plan (same contract) when the stream starts at
the first bar of each series.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = ("ticker STRING, date DATE, close DOUBLE, ema_10 DOUBLE, ema_50 DOUBLE, "
                 "obv DOUBLE, rsi_14 DOUBLE, late BOOLEAN")
STATE_SCHEMA = ("last_date DATE, n BIGINT, last_close DOUBLE, seed10 DOUBLE, ema10 DOUBLE, "
                "seed50 DOUBLE, ema50 DOUBLE, obv DOUBLE, g14 DOUBLE, l14 DOUBLE, diffs BIGINT")

_R14 = 1.0 - 1.0 / 14


def _step(state: dict, close: float, volume: float) -> dict:
    """One bar of the recursions (same contract as the batch plan)."""
    n = state["n"]
    out = {}
    for key, length in (("10", 10), ("50", 50)):
        alpha = 2.0 / (length + 1)
        if n < length:
            state["seed" + key] += close
            state["ema" + key] = state["seed" + key] / length if n + 1 == length else None
        else:
            state["ema" + key] = alpha * close + (1 - alpha) * state["ema" + key]
        out["ema_" + key] = state["ema" + key]
    if n == 0:
        state["obv"] = volume
    else:
        d = close - state["last_close"]
        sign = (d > 0) - (d < 0)
        state["obv"] = state["obv"] + sign * volume
        state["g14"] = _R14 * state["g14"] + max(d, 0.0)
        state["l14"] = _R14 * state["l14"] + max(-d, 0.0)
        state["diffs"] += 1
    out["obv"] = state["obv"]
    g, lo = state["g14"], state["l14"]
    out["rsi_14"] = (100.0 * g / (g + lo)) if state["diffs"] >= 14 and (g + lo) != 0 else None
    state["n"] = n + 1
    state["last_close"] = close
    return out


def _update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    ticker = key[0]
    if state.exists:
        (last_date, n, last_close, seed10, ema10, seed50, ema50, obv, g14, l14, diffs) = state.get
        st = dict(last_date=last_date, n=n, last_close=last_close, seed10=seed10, ema10=ema10,
                  seed50=seed50, ema50=ema50, obv=obv, g14=g14, l14=l14, diffs=diffs)
    else:
        st = dict(last_date=None, n=0, last_close=None, seed10=0.0, ema10=None, seed50=0.0,
                  ema50=None, obv=0.0, g14=0.0, l14=0.0, diffs=0)
    bars = pd.concat(list(batches)).sort_values("date")
    rows = []
    for date, close, volume in zip(bars["date"], bars["close"], bars["volume"]):
        if st["last_date"] is not None and date <= st["last_date"]:
            rows.append((ticker, date, close, None, None, None, None, True))
            continue
        out = _step(st, float(close), float(volume))
        st["last_date"] = date
        rows.append((ticker, date, close, out["ema_10"], out["ema_50"], out["obv"], out["rsi_14"], False))
    state.update((st["last_date"], st["n"], st["last_close"], st["seed10"], st["ema10"], st["seed50"],
                  st["ema50"], st["obv"], st["g14"], st["l14"], st["diffs"]))
    yield pd.DataFrame(rows, columns=["ticker", "date", "close", "ema_10", "ema_50", "obv", "rsi_14", "late"])


def incremental_indicators(bars_stream: DataFrame) -> DataFrame:
    """Streaming frame of (ticker, date, close, volume) -> indicator rows."""
    return (bars_stream.select("ticker", "date", "close", "volume")
            .groupBy("ticker")
            .applyInPandasWithState(_update, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))
