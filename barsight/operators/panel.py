"""The recursions and windows of the indicators for many series side by side.

A *panel* is a matrix with a column for each series and a row for each bar
number, so that one numpy operation takes a step of all of its series.  Spark
deals, sorts and numbers the bars; a task cuts its rows at the first bars of the
series into panels of at most about ``CELLS`` bars, shorter series filled up, and
writes a row for each bar.  A task holds one series and ``ROWS`` bars at a time.

:func:`panel_step` goes on from what the bars before left: the last bars (for
the windows) and a vector of carries (averages, counts, sums), none at the first
bar.  The contract of the values is that of :mod:`barsight.operators.indicators`;
a missing value is NaN here and NULL outside, and a NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

TAIL = 200           # bars that the longest window holds
CELLS = 1 << 17      # bars of a panel
ROWS = 1 << 16       # bars that a task gathers before it computes

SEEDED = {"ema_10": ("close", 10, 2 / 11), "ema_50": ("close", 50, 2 / 51), "ema_12": ("close", 12, 2 / 13),
          "ema_26": ("close", 26, 2 / 27), "atr_14": ("range", 14, 1 / 14), "atr_3": ("range", 3, 1 / 3)}
WILDER = {"gain_14": ("gain", 14), "loss_14": ("loss", 14), "gain_5": ("gain", 5), "loss_5": ("loss", 5),
          "plus": ("plus", 14), "minus": ("minus", 14)}
LEVEL1 = [*SEEDED, *WILDER]
RATE1 = np.array([1 - a for _, _, a in SEEDED.values()] + [1 - 1 / n for _, n in WILDER.values()])
LEVEL2 = ["signal", "dx_num", "dx_den"]
RATE2 = np.array([1 - 2 / 10, 1 - 1 / 14, 1 - 1 / 14])
COUNTED = ["close", "range", "gain", "plus", "macd", "dx"]
#: The carries: averages, then counts and sums of the series, then on-balance volume, bars, last volume.
CARRIES = [*LEVEL1, *LEVEL2, *(f"n_{c}" for c in COUNTED), *(f"s_{c}" for c in COUNTED), "obv", "bars", "last_volume"]


def fresh_carry(series: int) -> np.ndarray:
    """The carries before the first bar, a column for each series."""
    carry = np.zeros((len(CARRIES), series))
    carry[-1] = np.nan
    return carry


def _div(a, b):
    return np.where(b == 0, np.nan, a / b)


def _before(x: np.ndarray, k: int = 1) -> np.ndarray:
    """x k bars ago."""
    out = np.full_like(x, np.nan)
    if k < len(x):
        out[k:] = x[:len(x) - k]
    return out


def _rolled(x: np.ndarray, lengths, op) -> dict[int, np.ndarray]:
    """op over the last n bars for each n, NaN where one is missing: windows of
    powers of two by doubling, the others put together from these."""
    power, size = {1: x}, 1
    while 2 * size <= max(lengths):
        power[2 * size] = op(_before(power[size], size), power[size])
        size *= 2
    out = {}
    for n in lengths:
        total, reach = None, 0
        for p in sorted(power, reverse=True):
            if n & p:
                total = power[p] if total is None else op(_before(power[p], reach), total)
                reach += p
        out[n] = total
    return out


def _advance(y: np.ndarray, rate: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y = rate * y + b, bar after bar, in the place of b (bars, averages, series)."""
    y, rate = y.copy(), rate[:, None]
    for row in b:
        y *= rate
        y += row
        row[:] = y
    return b


def _seeded(x, seen, total, n, alpha):
    return np.where((seen == n) & ~np.isnan(x), total / n, np.where(seen > n, alpha * np.nan_to_num(x), 0.0))


def panel_step(tail: np.ndarray, carry: np.ndarray, new: np.ndarray, until: str = "features"):
    """One step of a panel: ``tail`` (high, low, close, volume; bars; series) the bars
    before, ``new`` the next bars, ``carry`` (CARRIES, series).

    Returns the features by name, the next tail and the next carries; or, where
    ``until`` names an earlier stage (``counts``, ``level1``, ``totals``,
    ``level2``), what the last bars hold of it, by the names of CARRIES."""
    with np.errstate(all="ignore"):
        return _step(tail, carry, new, until)


def _step(tail, carry, new, until):
    k, m = tail.shape[1], new.shape[1]
    held = dict(zip(CARRIES, carry))
    ends: dict[str, np.ndarray] = {}

    def take(name, x):
        seen = held[f"n_{name}"] + np.cumsum(~np.isnan(x), axis=0)
        total = held[f"s_{name}"] + np.cumsum(np.nan_to_num(x), axis=0)
        if m:
            ends[f"n_{name}"], ends[f"s_{name}"] = seen[-1], total[-1]
        return seen, total

    whole = np.concatenate([tail, new], axis=1)
    high, low, close, volume = whole
    H, L, C, V = new
    C1 = _before(close)[k:]
    d, up, dn = C - C1, H - _before(high)[k:], _before(low)[k:] - L
    moved = ~np.isnan(up) & ~np.isnan(dn)
    series = {
        "close": C, "range": np.fmax(np.fmax(H - L, np.abs(H - C1)), np.abs(L - C1)),
        "gain": np.where(np.isnan(d), np.nan, np.maximum(d, 0)), "loss": np.where(np.isnan(d), np.nan, np.maximum(-d, 0)),
        "plus": np.where(moved, np.where((up > dn) & (up > 0), up, 0.0), np.nan),
        "minus": np.where(moved, np.where((dn > up) & (dn > 0), dn, 0.0), np.nan)}
    seen = {name: take(name, series[name]) for name in ("close", "range", "gain", "plus")}
    number = held["bars"] + np.arange(m)[:, None]
    signed = np.where(number == 0, V, np.sign(d) * V)
    obv = held["obv"] + np.cumsum(np.nan_to_num(signed), axis=0)
    padded = np.concatenate([held["last_volume"][None], V])
    newest = np.maximum.accumulate(np.where(np.isnan(padded), 0, np.arange(m + 1)[:, None]), axis=0)
    padded = np.take_along_axis(padded, newest, axis=0)
    ends.update(obv=obv[-1] if m else held["obv"], bars=held["bars"] + m, last_volume=padded[-1])
    if until == "counts":
        return ends

    b = np.empty((m, len(LEVEL1), new.shape[2]))
    for at, (s, n, a) in enumerate(SEEDED.values()):
        b[:, at] = _seeded(series[s], *seen[s], n, a)
    for at, (s, _) in enumerate(WILDER.values(), len(SEEDED)):
        b[:, at] = np.nan_to_num(series[s])
    level1 = _advance(carry[:len(LEVEL1)], RATE1, b)
    if m:
        ends.update(zip(LEVEL1, level1[-1]))
    if until == "level1":
        return ends
    got = {name: level1[:, at] for at, name in enumerate(LEVEL1)}
    for name, (s, n, _) in SEEDED.items():
        got[name] = np.where(seen[s][0] >= n, got[name], np.nan)
    macd = got["ema_12"] - got["ema_26"]
    plus, minus = got["plus"], got["minus"]
    ready = (seen["plus"][0] >= 14) & ~np.isnan(got["atr_14"]) & (got["atr_14"] != 0)
    dx = np.where(ready, _div(100 * np.abs(plus - minus), plus + minus), np.nan)
    macd_seen, macd_sum = take("macd", macd)
    dx_seen, _ = take("dx", dx)
    if until == "totals":
        return ends
    b = np.stack([_seeded(macd, macd_seen, macd_sum, 9, 0.2), np.nan_to_num(dx), (~np.isnan(dx)).astype(float)], axis=1)
    level2 = _advance(carry[len(LEVEL1):len(LEVEL1) + len(LEVEL2)], RATE2, b)
    if m:
        ends.update(zip(LEVEL2, level2[-1]))
    if until == "level2":
        return ends
    signal = np.where(macd_seen >= 9, level2[:, 0], np.nan)

    sma = {n: x[k:] / n for n, x in _rolled(close, (10, 20, 50, 200), np.add).items()}
    squares = np.zeros_like(C)
    for back in range(20):
        gap = _before(close, back)[k:] - sma[20]
        squares += gap * gap
    spread = 2 * np.sqrt(squares / 20)
    lower, upper = sma[20] - spread, sma[20] + spread
    lowest, highest = _rolled(low, (14,), np.minimum)[14], _rolled(high, (14,), np.maximum)[14]
    raw_k = _div(100 * (close - lowest), highest - lowest)
    rk = [_before(raw_k, i)[k:] if i else raw_k[k:] for i in range(5)]
    rsi = {n: np.where(seen["gain"][0] >= n, _div(100 * got[f"gain_{n}"], got[f"gain_{n}"] + got[f"loss_{n}"]), np.nan) for n in (14, 5)}
    roc = {n: _div(100 * (C - _before(close, n)[k:]), _before(close, n)[k:]) for n in (1, 3, 5)}
    out = {
        **{f"sma_{n}": x for n, x in sma.items()}, "ema_10": got["ema_10"], "ema_50": got["ema_50"],
        "adx_14": np.where(dx_seen >= 14, _div(level2[:, 1], level2[:, 2]), np.nan),
        "macd_12_26_9": macd, "macdh_12_26_9": macd - signal, "macds_12_26_9": signal,
        "rsi_14": rsi[14], "rsi_5": rsi[5], "stochk_14_3_3": (rk[2] + rk[1] + rk[0]) / 3,
        "stochd_14_3_3": (rk[4] + 2 * rk[3] + 3 * rk[2] + 2 * rk[1] + rk[0]) / 9,
        **{f"roc_{n}": x for n, x in roc.items()}, "atrr_14": got["atr_14"], "atr_ratio": _div(got["atr_3"], got["atr_14"]),
        "bbl_20_2_0": lower, "bbu_20_2_0": upper, "bbb_20_2_0": _div(100 * (upper - lower), sma[20]),
        "bbp_20_2_0": _div(C - lower, upper - lower), "obv": np.where(np.isnan(signed), np.nan, obv),
        "rvol_20": _div(V, _rolled(volume, (20,), np.add)[20][k:] / 20), "volume_delta": _div(padded[1:], padded[:-1]) - 1,
        **{f"price_vs_sma{n}": _div(C, sma[n]) for n in (20, 50, 200)},
        "dist_from_high": _div(H - C, C), "dist_from_low": _div(C - L, C),
        "close_loc": np.where(H == L, 0.5, _div(C - L, H - L)), "atrr_3": got["atr_3"]}
    if not m:
        return out, tail, carry
    return out, whole[:, -TAIL:], np.stack([ends[name] for name in CARRIES])


def side_by_side(starts: np.ndarray, lengths: np.ndarray, cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(series, places, mine) of each panel of stretches of rows: the numbers of its
    series, the row of each cell, and which cells are no filling."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        bars = max(1, int(lengths[order[at]]))
        some = order[at:at + max(1, cells // bars)]
        at += len(some)
        step = np.arange(bars)[:, None]
        mine = step < lengths[some]
        yield some, np.where(mine, starts[some] + step, 0), mine


def numbers(column) -> np.ndarray:
    """A column as doubles, NaN for nulls."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def panels(values: list[np.ndarray], places: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """The values (one array for each of high, low, close, volume) of a panel."""
    return np.stack([np.where(mine, x[places], np.nan) for x in values])


def whole_series(batches, mark: Callable[[pa.RecordBatch], np.ndarray], rows: int = ROWS) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``rows`` that each end with a series;
    ``mark`` says which rows of a batch are the first of a series."""
    held, n = [], 0
    for batch in batches:
        if n + batch.num_rows >= rows and n:
            first = np.flatnonzero(mark(batch))
            if len(first):
                last = int(first[-1])
                yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
                held, n, batch = [], 0, batch.slice(last)
        held.append(batch)
        n += batch.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def series_features(table: pa.Table, rn: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    """The named features of each row of whole series, which begin where ``rn`` is 0;
    with ``n_bars`` and ``next_close``."""
    values = [numbers(table[c]) for c in ("high", "low", "close", "volume")]
    starts = np.flatnonzero(rn == 0)
    lengths = np.diff(np.r_[starts, len(rn)])
    out = {name: np.empty(len(rn)) for name in names}
    for some, places, mine in side_by_side(starts, lengths):
        found, _, _ = panel_step(np.zeros((4, 0, len(some))), fresh_carry(len(some)), panels(values, places, mine))
        rows = places[mine]
        for name in names:
            out[name][rows] = found[name][mine]
    out["n_bars"] = np.repeat(lengths, lengths)
    ahead = np.r_[values[2][1:], np.nan]
    ahead[starts[1:] - 1] = np.nan
    out["next_close"] = ahead
    return out
