"""Plain-Python sequential evaluation of the indicator contract, used as an
independent reference by the tests (one loop per series, no Spark)."""

from __future__ import annotations

import math


def _div(a, b):
    if a is None or b is None or b == 0:
        return None
    return a / b


def _full(xs, i, n, fn):
    if i < n - 1:
        return None
    w = xs[i - n + 1:i + 1]
    if any(v is None for v in w):
        return None
    return fn(w)


def _mean(w):
    return sum(w) / len(w)


def _std_pop(w):
    m = _mean(w)
    return math.sqrt(sum((v - m) ** 2 for v in w) / len(w))


def _seeded(xs, n, alpha):
    out, seen, total, y = [], 0, 0.0, None
    for x in xs:
        if x is not None:
            seen += 1
        if seen < n:
            total += x if x is not None else 0.0
            out.append(None)
        elif seen == n and x is not None and y is None:
            total += x
            y = total / n
            out.append(y)
        else:
            y = alpha * x + (1 - alpha) * y
            out.append(y)
    return out


def _wilder(xs, n):
    r = 1.0 - 1.0 / n
    num = den = 0.0
    seen = 0
    out = []
    for x in xs:
        num, den = r * num, r * den
        if x is not None:
            num += x
            den += 1.0
            seen += 1
        out.append(num / den if seen >= n and den else None)
    return out


def features(bars):
    """bars: list of dicts (date-ordered) with open/high/low/close/volume."""
    C = [b["close"] for b in bars]
    H = [b["high"] for b in bars]
    L = [b["low"] for b in bars]
    V = [b["volume"] for b in bars]
    n = len(bars)
    C1 = [None] + C[:-1]
    out = [dict() for _ in range(n)]
    for L_ in (10, 20, 50, 200):
        for i in range(n):
            out[i][f"sma_{L_}"] = _full(C, i, L_, _mean)
    for name, L_ in (("ema_10", 10), ("ema_50", 50), ("ema_12", 12), ("ema_26", 26)):
        vals = _seeded(C, L_, 2.0 / (L_ + 1))
        for i in range(n):
            out[i][name] = vals[i]
    macd = [None if (o["ema_12"] is None or o["ema_26"] is None) else o["ema_12"] - o["ema_26"] for o in out]
    sig = _seeded(macd, 9, 0.2)
    tr = [H[i] - L[i] if i == 0 else max(H[i] - L[i], abs(H[i] - C1[i]), abs(L[i] - C1[i])) for i in range(n)]
    atr14 = _seeded(tr, 14, 1 / 14)
    atr3 = _seeded(tr, 3, 1 / 3)
    d = [None] + [C[i] - C[i - 1] for i in range(1, n)]
    gain = [None if x is None else max(x, 0.0) for x in d]
    loss = [None if x is None else max(-x, 0.0) for x in d]
    pdm, ndm = [None], [None]
    for i in range(1, n):
        up, dn = H[i] - H[i - 1], L[i - 1] - L[i]
        pdm.append(up if (up > dn and up > 0) else 0.0)
        ndm.append(dn if (dn > up and dn > 0) else 0.0)
    wp, wn = _wilder(pdm, 14), _wilder(ndm, 14)
    dx = []
    for i in range(n):
        if wp[i] is None or atr14[i] in (None, 0):
            dx.append(None)
            continue
        dmp, dmn = 100 * wp[i] / atr14[i], 100 * wn[i] / atr14[i]
        dx.append(_div(100 * abs(dmp - dmn), dmp + dmn))
    adx = _wilder(dx, 14)
    rsi = {}
    for L_ in (14, 5):
        g, lo = _wilder(gain, L_), _wilder(loss, L_)
        rsi[L_] = [None if g[i] is None else _div(100 * g[i], g[i] + lo[i]) for i in range(n)]
    raw_k = []
    for i in range(n):
        ll, hh = _full(L, i, 14, min), _full(H, i, 14, max)
        raw_k.append(None if ll is None or hh is None else _div(100 * (C[i] - ll), hh - ll))
    stochk = [_full(raw_k, i, 3, _mean) for i in range(n)]
    stochd = [_full(stochk, i, 3, _mean) for i in range(n)]
    obv, run = [], 0.0
    vpad, last = [], None
    for i in range(n):
        if V[i] is not None:
            s = V[i] if i == 0 else (((C[i] > C1[i]) - (C[i] < C1[i])) * V[i])
            run += s
            obv.append(run)
            last = V[i]
        else:
            obv.append(None)
        vpad.append(last)
    for i in range(n):
        o = out[i]
        o["macd_12_26_9"] = macd[i]
        o["macds_12_26_9"] = sig[i]
        o["macdh_12_26_9"] = None if macd[i] is None or sig[i] is None else macd[i] - sig[i]
        o["atrr_14"], o["atrr_3"] = atr14[i], atr3[i]
        o["atr_ratio"] = _div(atr3[i], atr14[i])
        o["adx_14"] = adx[i]
        o["rsi_14"], o["rsi_5"] = rsi[14][i], rsi[5][i]
        o["stochk_14_3_3"], o["stochd_14_3_3"] = stochk[i], stochd[i]
        for k in (1, 3, 5):
            prev = C[i - k] if i >= k else None
            o[f"roc_{k}"] = None if prev is None else _div(100 * (C[i] - prev), prev)
        sd = _full(C, i, 20, _std_pop)
        m = o["sma_20"]
        if sd is None or m is None:
            o.update(bbl_20_2_0=None, bbu_20_2_0=None, bbb_20_2_0=None, bbp_20_2_0=None)
        else:
            lo_, hi_ = m - 2 * sd, m + 2 * sd
            o.update(bbl_20_2_0=lo_, bbu_20_2_0=hi_, bbb_20_2_0=_div(100 * (hi_ - lo_), m),
                     bbp_20_2_0=_div(C[i] - lo_, hi_ - lo_))
        o["obv"] = obv[i]
        vs = _full(V, i, 20, _mean)
        o["rvol_20"] = _div(V[i], vs)
        o["volume_delta"] = None if i == 0 or vpad[i - 1] is None or vpad[i] is None else (
            None if vpad[i - 1] == 0 else vpad[i] / vpad[i - 1] - 1)
        o["price_vs_sma20"] = _div(C[i], o["sma_20"])
        o["price_vs_sma50"] = _div(C[i], o["sma_50"])
        o["price_vs_sma200"] = _div(C[i], o["sma_200"])
        o["dist_from_high"] = _div(H[i] - C[i], C[i])
        o["dist_from_low"] = _div(C[i] - L[i], C[i])
        o["close_loc"] = 0.5 if H[i] == L[i] else _div(C[i] - L[i], H[i] - L[i])
    return out
