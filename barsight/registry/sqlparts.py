"""DuckDB SQL building blocks for the oracle side of the correctness check.

The indicator contract (see ``barsight.operators.indicators``) is re-stated
here independently: every linear recursion is written in closed form,
``y_t = r^t * SUM(b_j * r^-j)`` over a running window, instead of the block
scan the Spark side uses, so the two sides check each other.
"""

from __future__ import annotations

R4 = "(FLOOR(({x}) * 10000.0 + 0.5) / 10000.0)"
R6 = "(FLOOR(({x}) * 1000000.0 + 0.5) / 1000000.0)"


def r4(x: str) -> str:
    return R4.format(x=x)


def r6(x: str) -> str:
    return R6.format(x=x)


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


def bars_sql(unit: str | None = "week") -> str:
    date = ("CAST(l_shipdate AS DATE)" if unit is None
            else f"CAST(date_trunc('{unit}', l_shipdate) AS DATE)")
    price = div("l_extendedprice", "l_quantity")
    o = "row(l_shipdate, l_orderkey, l_linenumber, l_partkey)"
    return (f"SELECT CAST(l_suppkey AS VARCHAR) AS ticker, {date} AS date, "
            f"arg_min({price}, {o}) AS open, max({price}) AS high, min({price}) AS low, "
            f"arg_max({price}, {o}) AS adj_close, sum(l_quantity) AS volume "
            f"FROM lineitem GROUP BY 1, 2")


def event_bars_sql(key: str = "event_type") -> str:
    return (f"SELECT CAST({key} AS VARCHAR) AS ticker, date_trunc('hour', ts) AS date, "
            f"arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, "
            f"arg_max(value, row(ts, event_id)) AS adj_close, CAST(count(*) AS DOUBLE) AS volume "
            f"FROM events GROUP BY 1, 2")


def prices_sql(raw: str) -> str:
    return (f"SELECT ticker, date, open, high, low, adj_close AS close, volume "
            f"FROM ({raw}) WHERE adj_close IS NOT NULL")


def feature_ctes(prices: str, by: list[str] | None = None, t: str = "date",
                 extra: list[str] | None = None) -> str:
    """CTE chain ``f0 .. f6``; ``f6`` holds every feature per bar."""
    by = by or ["ticker"]
    extra = extra or []
    part = ", ".join(by)
    keep = "".join(f", {x}" for x in extra)
    w = f"PARTITION BY {part} ORDER BY {t}"
    cum = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def roll(n):
        return f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    def full(fn, x, n):
        return f"CASE WHEN COUNT({x}) OVER {roll(n)} = {n} THEN {fn}({x}) OVER {roll(n)} END"

    def seeded_b(x, n, alpha):
        return (f"CASE WHEN COUNT({x}) OVER {cum} = {n} AND {x} IS NOT NULL "
                f"THEN SUM({x}) OVER {cum} / {float(n)} "
                f"WHEN COUNT({x}) OVER {cum} > {n} THEN {alpha!r} * {x} ELSE 0.0 END")

    def scan(b, r):
        return f"(POW({r!r}, rn) * SUM(({b}) * POW({r!r}, -rn)) OVER {cum})"

    ema = {"ema_10": 10, "ema_50": 50, "ema_12": 12, "ema_26": 26}
    atr = {"atrr_14": 14, "atrr_3": 3}
    f1_cols = []
    for name, n in ema.items():
        f1_cols += [f"{seeded_b('close', n, 2.0 / (n + 1))} AS b_{name}",
                    f"COUNT(close) OVER {cum} >= {n} AS ok_{name}"]
    for name, n in atr.items():
        f1_cols += [f"{seeded_b('tr', n, 1.0 / n)} AS b_{name}",
                    f"COUNT(tr) OVER {cum} >= {n} AS ok_{name}"]
    f2_cols = []
    for name, n in ema.items():
        f2_cols.append(f"CASE WHEN ok_{name} THEN {scan('b_' + name, 1.0 - 2.0 / (n + 1))} END AS {name}")
    for name, n in atr.items():
        f2_cols.append(f"CASE WHEN ok_{name} THEN {scan('b_' + name, 1.0 - 1.0 / n)} END AS {name}")
    for n in (14, 5):
        r = 1.0 - 1.0 / n
        f2_cols.append(f"CASE WHEN diff_seen >= {n} THEN "
                       f"{div('100.0 * ' + scan('COALESCE(gain, 0.0)', r), scan('COALESCE(gain, 0.0)', r) + ' + ' + scan('COALESCE(loss, 0.0)', r))}"
                       f" END AS rsi_{n}")
    r14 = 1.0 - 1.0 / 14
    f2_cols += [f"{scan('COALESCE(pdm, 0.0)', r14)} AS pdm_w", f"{scan('COALESCE(ndm, 0.0)', r14)} AS ndm_w"]
    sig_r = 1.0 - 2.0 / 10
    return f"""
f0 AS (
  SELECT {part}, {t}, open, high, low, close, volume{keep},
         ROW_NUMBER() OVER ({w}) - 1 AS rn, COUNT(*) OVER (PARTITION BY {part}) AS n_bars,
         LEAD(close) OVER ({w}) AS next_close,
         LAG(close) OVER ({w}) AS c1, LAG(close, 3) OVER ({w}) AS c3, LAG(close, 5) OVER ({w}) AS c5,
         LAG(high) OVER ({w}) AS h1, LAG(low) OVER ({w}) AS l1,
         LAST_VALUE(volume IGNORE NULLS) OVER {cum} AS vpad
  FROM ({prices})
),
f1 AS (
  SELECT *,
    GREATEST(high - low, ABS(high - c1), ABS(low - c1)) AS tr,
    CASE WHEN c1 IS NOT NULL THEN GREATEST(close - c1, 0.0) END AS gain,
    CASE WHEN c1 IS NOT NULL THEN GREATEST(c1 - close, 0.0) END AS loss,
    CASE WHEN h1 IS NOT NULL AND l1 IS NOT NULL THEN
      CASE WHEN (high - h1) > (l1 - low) AND (high - h1) > 0 THEN high - h1 ELSE 0.0 END END AS pdm,
    CASE WHEN h1 IS NOT NULL AND l1 IS NOT NULL THEN
      CASE WHEN (l1 - low) > (high - h1) AND (l1 - low) > 0 THEN l1 - low ELSE 0.0 END END AS ndm,
    CASE WHEN rn = 0 THEN volume ELSE SIGN(close - c1) * volume END AS sv,
    LAG(vpad) OVER ({w}) AS vpad1
  FROM f0
),
f1b AS (
  SELECT *,
    {full('AVG', 'close', 10)} AS sma_10, {full('AVG', 'close', 20)} AS sma_20,
    {full('AVG', 'close', 50)} AS sma_50, {full('AVG', 'close', 200)} AS sma_200,
    {full('STDDEV_POP', 'close', 20)} AS sd20,
    {full('MIN', 'low', 14)} AS ll14, {full('MAX', 'high', 14)} AS hh14,
    {full('AVG', 'volume', 20)} AS vsma20,
    CASE WHEN sv IS NOT NULL THEN SUM(sv) OVER {cum} END AS obv,
    COUNT(gain) OVER {cum} AS diff_seen, COUNT(pdm) OVER {cum} AS dm_seen,
    {', '.join(f1_cols)}
  FROM f1
),
f2 AS (
  SELECT *, {', '.join(f2_cols)} FROM f1b
),
f3 AS (
  SELECT *, ema_12 - ema_26 AS macd_12_26_9,
    CASE WHEN dm_seen >= 14 AND atrr_14 IS NOT NULL AND atrr_14 <> 0
         THEN {div('100.0 * ABS(pdm_w - ndm_w)', 'pdm_w + ndm_w')} END AS dx,
    CASE WHEN ll14 IS NOT NULL AND hh14 IS NOT NULL
         THEN {div('100.0 * (close - ll14)', 'hh14 - ll14')} END AS rawk
  FROM f2
),
f4 AS (
  SELECT *, {seeded_b('macd_12_26_9', 9, 0.2)} AS b_sig,
    COUNT(macd_12_26_9) OVER {cum} >= 9 AS ok_sig,
    COUNT(dx) OVER {cum} AS dx_seen,
    {full('AVG', 'rawk', 3)} AS stochk_14_3_3
  FROM f3
),
f5 AS (
  SELECT *, CASE WHEN ok_sig THEN {scan('b_sig', sig_r)} END AS macds_12_26_9,
    CASE WHEN dx_seen >= 14 THEN {div(scan('COALESCE(dx, 0.0)', r14), scan('CASE WHEN dx IS NULL THEN 0.0 ELSE 1.0 END', r14))} END AS adx_14,
    {full('AVG', 'stochk_14_3_3', 3)} AS stochd_14_3_3
  FROM f4
),
f6 AS (
  SELECT {part}, {t}, rn, n_bars, open, high, low, close, volume, next_close{keep},
    sma_10, sma_20, sma_50, sma_200, ema_10, ema_50, adx_14,
    macd_12_26_9, macd_12_26_9 - macds_12_26_9 AS macdh_12_26_9, macds_12_26_9,
    rsi_14, rsi_5, stochk_14_3_3, stochd_14_3_3,
    {div('100.0 * (close - c1)', 'c1')} AS roc_1, {div('100.0 * (close - c3)', 'c3')} AS roc_3,
    {div('100.0 * (close - c5)', 'c5')} AS roc_5,
    atrr_14, {div('atrr_3', 'atrr_14')} AS atr_ratio,
    sma_20 - 2.0 * sd20 AS bbl_20_2_0, sma_20 + 2.0 * sd20 AS bbu_20_2_0,
    {div('100.0 * ((sma_20 + 2.0 * sd20) - (sma_20 - 2.0 * sd20))', 'sma_20')} AS bbb_20_2_0,
    {div('close - (sma_20 - 2.0 * sd20)', '(sma_20 + 2.0 * sd20) - (sma_20 - 2.0 * sd20)')} AS bbp_20_2_0,
    obv, {div('volume', 'vsma20')} AS rvol_20, {div('vpad', 'vpad1')} - 1.0 AS volume_delta,
    {div('close', 'sma_20')} AS price_vs_sma20, {div('close', 'sma_50')} AS price_vs_sma50,
    {div('close', 'sma_200')} AS price_vs_sma200,
    {div('high - close', 'close')} AS dist_from_high, {div('close - low', 'close')} AS dist_from_low,
    CASE WHEN high = low THEN 0.5 ELSE {div('close - low', 'high - low')} END AS close_loc,
    atrr_3
  FROM f5
)"""
