"""DuckDB side of the correctness check: ANSI SQL per key of ``spark_side.QUERIES``.

Written from the operator contracts, not from the Spark plans: recursions in
closed form or as recursive CTEs, global orderings as plain windows, the
as-of lookup as a theta join with ROW_NUMBER.
"""

from __future__ import annotations

from barsight.operators.asof import DEFAULT_HISTORY
from barsight.operators.indicators import FEATURES as FEATURE_NAMES
from barsight.registry.sqlparts import (
    bars_sql, div, event_bars_sql, feature_ctes, prices_sql, r4, r6,
)
from barsight.sources.fixtures import FEATURE_SOFT, FEATURE_STRICT
from barsight.registry.spark_side import (
    AS_OF, BASE_URI, F4_SCALARS, FLAG_THRESHOLD, IND_GROUPS, LINEAR_SCAN_R,
)

BARS_W = bars_sql("week")
BARS_D = bars_sql(None)
PRICES_W = prices_sql(BARS_W)
PRICES_D = prices_sql(BARS_D)

F4_STRICT, F4_SOFT = FEATURE_STRICT, FEATURE_SOFT


def feats_w() -> str:
    return "WITH " + feature_ctes(PRICES_W)


def _round_list(cols, fn=r4):
    return ", ".join(f"{fn(c)} AS {c}" for c in cols)


# ------------------------------------------------------------------ F4 / F5 / F6 / F7 / F8 / F9
F4_ROWS = """
SELECT CAST(o_custkey % 150 AS VARCHAR) AS ticker,
  CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(o_orderdate AS DATE) AS earnings_call_date,
  [CAST(o_totalprice / 1000.0 AS FLOAT), CAST(o_custkey % 97 AS FLOAT)] AS summary_embedding,
  o_orderstatus AS sector,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS industry,
  o_totalprice / 100.0 AS adj_close_on_call_date,
  o_orderpriority || '|' || o_orderstatus AS industry_sector,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS eps_surprise,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / 100000.0 END AS summary_norm,
  CAST(o_custkey % 10 AS DOUBLE) / 10.0 AS lda_topic_0,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) / 100.0 END AS pos_prob,
  CAST(NULL AS DOUBLE) AS max_close_30d,
  o_orderkey AS load_seq
FROM orders"""


def dedupe(src: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, "
            f"quarter_end_date ORDER BY earnings_call_date DESC NULLS LAST, load_seq DESC) AS _rn "
            f"FROM ({src})) WHERE _rn = 1")


F4_CTES = f"""
fr AS ({F4_ROWS}),
staging AS (SELECT * FROM fr WHERE load_seq % 3 <> 0),
final AS ({dedupe("SELECT * FROM fr WHERE load_seq % 6 = 0")})"""

STRICT_OK = " AND ".join(f"{c} IS NOT NULL" for c in F4_STRICT)
F4_SCALAR_LIST = ", ".join(F4_SCALARS)


def merge_ctes() -> str:
    cols = ["ticker", "quarter_end_date", "earnings_call_date", "summary_embedding", "sector",
            "industry", "adj_close_on_call_date", "industry_sector", "eps_surprise", "summary_norm",
            "lda_topic_0", "pos_prob", "max_close_30d", "load_seq"]
    sel = []
    for c in cols:
        if c in ("ticker", "quarter_end_date"):
            sel.append(f"COALESCE(t.{c}, s.{c}) AS {c}")
        else:
            sel.append(f"CASE WHEN s._in IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    s_ok = " AND ".join(f"s.{c} IS NOT NULL" for c in F4_STRICT)
    return f"""{F4_CTES},
src AS ({dedupe("SELECT * FROM staging")}),
mplan AS (
  SELECT {', '.join(sel)},
    CASE WHEN t._in IS NOT NULL AND s._in IS NOT NULL THEN 'update'
         WHEN t._in IS NULL AND ({s_ok}) THEN 'insert'
         WHEN t._in IS NULL THEN 'skip' ELSE 'keep' END AS _action
  FROM (SELECT *, 1 AS _in FROM final) t
  FULL OUTER JOIN (SELECT *, 1 AS _in FROM src) s
    ON t.ticker = s.ticker AND t.quarter_end_date = s.quarter_end_date
),
merged AS (SELECT * EXCLUDE (_action) FROM mplan WHERE _action <> 'skip')"""


F6_CTES = """
lst AS (SELECT 'summaries/' || source || '_' || CAST(doc_id AS VARCHAR)
          || CASE WHEN doc_id % 10 = 0 THEN '.json' ELSE '.txt' END AS path FROM documents),
ex AS (SELECT DISTINCT source || '_' || CAST(doc_id AS VARCHAR) AS key
       FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
lk AS (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS nm FROM lst WHERE path LIKE '%.txt'),
lkeys AS (SELECT path, left(nm, length(nm) - 4) AS key FROM lk),
miss AS (SELECT * FROM lkeys WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.key = lkeys.key))"""

F7_CTES = """
ev AS (SELECT event_id, user_id, props,
         CASE WHEN event_id % 20 = 7 THEN '' ELSE event_type END AS et FROM events),
enc AS (SELECT event_id,
          CASE WHEN event_id % 50 = 0 THEN '%%not-base64%%'
               ELSE to_base64(encode(to_json({'ticker': user_id, 'event_type': et, 'props': props}))) END AS d
        FROM ev),
env AS (SELECT event_id AS envelope_id,
          CASE WHEN event_id % 97 = 5 THEN to_json({'items': [{'data': d}]})
               WHEN event_id % 4 = 3 THEN to_json({'messages': [{'data': d}, {'data': d}]})
               ELSE to_json({'message': {'data': d}}) END AS body
        FROM enc),
arrs AS (SELECT envelope_id,
           CASE WHEN json_extract(body, '$.message') IS NOT NULL
                     AND json_type(json_extract(body, '$.message')) <> 'NULL'
                THEN [json_extract(body, '$.message')]
                WHEN json_extract(body, '$.messages') IS NOT NULL
                     AND json_type(json_extract(body, '$.messages')) = 'ARRAY'
                THEN CAST(json_extract(body, '$.messages') AS JSON[]) END AS arr
         FROM env),
items AS (SELECT envelope_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos, UNNEST(arr) AS m
          FROM arrs WHERE arr IS NOT NULL),
txt AS (SELECT envelope_id, pos, TRY(decode(from_base64(json_extract_string(m, '$.data')))) AS t FROM items),
dec AS (
  SELECT envelope_id, pos,
    CASE WHEN ok THEN json_extract_string(t, '$.ticker') END AS ticker,
    CASE WHEN ok THEN json_extract_string(t, '$.event_type') END AS event_type,
    CASE WHEN ok THEN json_extract_string(t, '$.props') END AS props,
    CASE WHEN ok THEN 'ok' ELSE 'malformed' END AS status
  FROM (SELECT *, COALESCE(t IS NOT NULL AND TRY(json_valid(t)) AND ltrim(t) LIKE '{%', FALSE) AS ok FROM txt)
  UNION ALL
  SELECT envelope_id, 0, NULL, NULL, NULL, 'bad_envelope' FROM arrs WHERE arr IS NULL
),
miss_f AS (
  SELECT *, list_filter([CASE WHEN ticker IS NULL OR ticker = '' THEN 'ticker' END,
                         CASE WHEN event_type IS NULL OR event_type = '' THEN 'event_type' END],
                        lambda x: x IS NOT NULL) AS missing
  FROM dec)"""

def f8_ctes(bars: str, prices: str) -> str:
    return f"""
wb AS ({bars}),
pw AS ({prices}),
nb AS (SELECT ticker, date, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date) AS n FROM wb),
firsts AS (SELECT min(ticker) AS ticker, arg_min(d, ticker) AS d
           FROM (SELECT ticker, min(date) AS d FROM wb GROUP BY ticker)),
reqs AS (
  SELECT ticker, CAST(date + 3 AS DATE) AS date FROM nb WHERE n % 40 = 0
  UNION ALL SELECT ticker, CAST(d - 1 AS DATE) FROM firsts
  UNION ALL SELECT CAST(NULL AS VARCHAR), d FROM firsts
  UNION ALL SELECT ticker, CAST(NULL AS DATE) FROM firsts),
vr AS (SELECT DISTINCT ticker, date AS target_date FROM reqs WHERE ticker IS NOT NULL AND date IS NOT NULL),
hist AS (
  SELECT * EXCLUDE (_k) FROM (
    SELECT r.ticker, r.target_date, p.date, p.open, p.high, p.low, p.close, p.volume,
      ROW_NUMBER() OVER (PARTITION BY r.ticker, r.target_date ORDER BY p.date DESC) AS _k
    FROM vr r JOIN pw p ON p.ticker = r.ticker AND p.date <= r.target_date)
  WHERE _k <= {DEFAULT_HISTORY})"""


F8_CTES = f8_ctes(BARS_W, PRICES_W)
F8_DAILY = f8_ctes(BARS_D, PRICES_D)


def _service_sql(ctes: str) -> str:
    return f"""WITH {ctes}, {feature_ctes('SELECT * FROM hist', ['ticker', 'target_date'])}
SELECT {_round_list(FEATURE_NAMES)}, {r4('close')} AS close_price, volume, ticker,
  strftime(target_date, '%Y-%m-%d') AS date
FROM f6 WHERE n_bars >= 50 AND rn = n_bars - 1"""


def train_ctes() -> str:
    narrowed = ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in FEATURE_NAMES)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)
    prob = ("1.0 / (1.0 + exp(-(4.0 * close_loc - 2.0 + roc_1 / 10.0)))")
    return f"""{feats_w()},
tf AS (
  SELECT * REPLACE ({narrowed}),
    CASE WHEN next_close - close > 0.5 * atrr_14 THEN 1 ELSE 0 END AS target_long,
    CASE WHEN close - next_close > 0.5 * atrr_14 THEN 1 ELSE 0 END AS target_short
  FROM f6 WHERE n_bars >= 200),
clean AS (SELECT * FROM tf WHERE {not_null}),
sc0 AS (SELECT *, {r6(prob)} AS prob_long FROM clean),
scored AS (SELECT *, {r6('1.0 - prob_long')} AS prob_short FROM sc0),
sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY date, ticker) - 1
                           < FLOOR(COUNT(*) OVER () * 0.8) THEN 'train' ELSE 'validate' END AS split
       FROM scored),
val_long AS (SELECT ticker, date, prob_long AS prob, target_long AS target FROM sp WHERE split = 'validate'),
val_short AS (SELECT ticker, date, prob_short AS prob, target_short AS target FROM sp WHERE split = 'validate')"""


def ap_sql(src: str) -> str:
    return (f"(SELECT SUM(tp * ctp / cn) / NULLIF((SELECT SUM(CAST(target AS DOUBLE)) FROM {src}), 0) FROM ("
            f"SELECT tp, SUM(tp) OVER (ORDER BY prob DESC) AS ctp, SUM(n) OVER (ORDER BY prob DESC) AS cn "
            f"FROM (SELECT prob, SUM(CAST(target AS DOUBLE)) AS tp, CAST(COUNT(*) AS DOUBLE) AS n "
            f"FROM {src} GROUP BY prob)))")


def picks_sql(threshold: float) -> str:
    narrowed = ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in FEATURE_NAMES)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)
    prob = "1.0 / (1.0 + exp(-(4.0 * close_loc - 2.0 + roc_1 / 10.0)))"
    return f"""{feats_w()},
cl AS (SELECT * FROM (SELECT * REPLACE ({narrowed}) FROM f6 WHERE n_bars >= 50) WHERE {not_null}),
lat AS (SELECT * FROM cl QUALIFY date = MAX(date) OVER (PARTITION BY ticker)),
s0 AS (SELECT ticker, date, close, {r6(prob)} AS prob_long FROM lat),
s1 AS (SELECT ticker, date, close, 'CALL' AS contract_type, prob_long AS prob FROM s0
       UNION ALL SELECT ticker, date, close, 'PUT', {r6('1.0 - prob_long')} FROM s0),
s2 AS (SELECT *, CAST(CASE WHEN prob > {threshold!r} THEN 1 ELSE 0 END AS BIGINT) AS prediction,
         ROW_NUMBER() OVER (PARTITION BY contract_type ORDER BY prob DESC, ticker, date) AS rk FROM s1),
picks AS (SELECT ticker, date, close, prob, contract_type, prediction FROM s2 WHERE rk <= 10)"""


def _ind_sql(cols):
    return f"{feats_w()} SELECT ticker, date, {_round_list(cols)} FROM f6"


def _backfill_sql(mode: str) -> str:
    if mode == "as_coded":
        src = f"""src AS (
  SELECT f.ticker, f.quarter_end_date, mp.calculated_max_close
  FROM final f JOIN (SELECT ticker, date AS call_date, MAX(adj_close) AS calculated_max_close
                     FROM db GROUP BY ticker, date) mp
    ON f.ticker = mp.ticker AND f.earnings_call_date = mp.call_date
  WHERE f.max_close_30d IS NULL AND f.earnings_call_date <= DATE '{AS_OF}' - INTERVAL 31 DAY)"""
    else:
        src = f"""src AS (
  SELECT f.ticker, f.quarter_end_date, MAX(p.adj_close) AS calculated_max_close
  FROM final f JOIN db p ON p.ticker = f.ticker
    AND p.date BETWEEN f.earnings_call_date + 1 AND f.earnings_call_date + 30
  WHERE f.max_close_30d IS NULL AND f.earnings_call_date <= DATE '{AS_OF}' - INTERVAL 31 DAY
  GROUP BY f.ticker, f.quarter_end_date)"""
    return f"""WITH {F4_CTES}, db AS ({BARS_D}), {src}
SELECT f.ticker, f.quarter_end_date, f.load_seq,
  {r4('CASE WHEN s.ticker IS NOT NULL THEN s.calculated_max_close ELSE f.max_close_30d END')} AS max_close_30d,
  s.ticker IS NOT NULL AS _updated
FROM final f LEFT JOIN src s ON f.ticker = s.ticker AND f.quarter_end_date = s.quarter_end_date"""


def _linear_scan_sql() -> str:
    return f"""WITH RECURSIVE b AS (
  SELECT ticker, date, close, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date) - 1 AS rn
  FROM ({PRICES_W})),
s(ticker, rn, date, y) AS (
  SELECT ticker, rn, date, close FROM b WHERE rn = 0
  UNION ALL
  SELECT b.ticker, b.rn, b.date, {LINEAR_SCAN_R!r} * s.y + b.close
  FROM s JOIN b ON b.ticker = s.ticker AND b.rn = s.rn + 1)
SELECT ticker, date, {r4('y')} AS y FROM s"""


def _quality_gate_sql() -> str:
    parts = []
    for kind, cols in (("strict", F4_STRICT), ("soft", F4_SOFT)):
        for c in cols:
            parts.append(f"SELECT '{c}' AS column_name, '{kind}' AS kind, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS row_count "
                         f"FROM staging")
    union = " UNION ALL ".join(parts)
    return f"""WITH {F4_CTES}, p AS ({union})
SELECT column_name, kind, null_count, row_count,
  {r6('CASE WHEN row_count > 0 THEN CAST(null_count AS DOUBLE) / row_count ELSE 0.0 END')} AS null_pct,
  CASE WHEN kind = 'strict' AND null_count > 0 THEN 'abort'
       WHEN kind = 'soft' AND (CASE WHEN row_count > 0 THEN CAST(null_count AS DOUBLE) / row_count ELSE 0.0 END) > 0.1 THEN 'warn'
       WHEN kind = 'soft' AND null_count > 0 THEN 'info' ELSE 'ok' END AS level
FROM p"""


def _matrix_sql() -> str:
    parts = []
    for c in FEATURE_NAMES + ["target_long"]:
        parts.append(f"SELECT '{c}' AS column_name, 'null' AS problem, COUNT(*) FILTER (WHERE {c} IS NULL) AS n FROM lab")
        parts.append(f"SELECT '{c}', 'nan', COUNT(*) FILTER (WHERE isnan({c})) FROM lab")
        parts.append(f"SELECT '{c}', 'inf', COUNT(*) FILTER (WHERE isinf({c})) FROM lab")
    return f"""{feats_w()},
lab AS (SELECT *, CASE WHEN next_close - close > 0.5 * atrr_14 THEN 1 ELSE 0 END AS target_long
        FROM f6 WHERE n_bars >= 200)
SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0"""


def _class_weights_sql() -> str:
    return f"""{train_ctes()},
tr AS (SELECT * FROM sp WHERE split = 'train'),
w AS (SELECT (1.0 - AVG(CAST(target_long AS DOUBLE))) / NULLIF(AVG(CAST(target_long AS DOUBLE)), 0) AS pw FROM tr)
SELECT target_long AS target, {r6('CASE WHEN target_long = 1 THEN (SELECT pw FROM w) ELSE 1.0 END')} AS weight,
  COUNT(*) AS n
FROM tr GROUP BY 1, 2"""


def _auto_weight_sql() -> str:
    rows = []
    for d in ("long", "short"):
        p = f"AVG(CAST(target_{d} AS DOUBLE))"
        auto = f"(1.0 - {p}) / NULLIF({p}, 0)"
        rows.append(f"SELECT '{d.upper()}' AS direction, {r6(p)} AS pos_frac, {r6(auto)} AS suggested_weight, "
                    f"{r6(auto)} AS pos_weight FROM sp WHERE split = 'train'")
    return f"{train_ctes()} " + " UNION ALL ".join(rows)


ORACLE = {
    "scan_prices": f"SELECT * FROM ({PRICES_W})",
    "coerce_float32": ("SELECT ticker, date, CAST(CAST(open AS FLOAT) AS DOUBLE) AS open, "
                       "CAST(CAST(high AS FLOAT) AS DOUBLE) AS high, CAST(CAST(low AS FLOAT) AS DOUBLE) AS low, "
                       f"CAST(CAST(close AS FLOAT) AS DOUBLE) AS close FROM ({PRICES_W})"),
    "price_history_asof": f"WITH {F8_CTES} SELECT * FROM hist",
    "existing_keys": f"WITH {F6_CTES} SELECT key FROM ex",
    "existing_feature_keys": (f"WITH {F4_CTES} SELECT DISTINCT ticker || '_' || strftime(quarter_end_date, '%Y-%m-%d') "
                              f"AS key FROM final"),
    "list_missing_work": f"""WITH {F6_CTES}
SELECT key, string_split(key, '_')[1] AS ticker, string_split(key, '_')[2] AS quarter_end_date,
  '{BASE_URI}/' || path AS summary_path,
  '{BASE_URI}/earnings-call-transcripts/' || key || '.json' AS transcript_path,
  len(string_split(key, '_')) = 2 AS ok
FROM miss""",
    "decode_messages": f"WITH {F7_CTES} SELECT * FROM dec",
    "missing_fields": f"WITH {F7_CTES} SELECT envelope_id, pos, array_to_string(missing, ',') AS missing FROM miss_f",
    "split_valid": (f"WITH {F7_CTES} SELECT envelope_id, pos, ticker, event_type, props FROM miss_f "
                    f"WHERE status = 'ok' AND len(missing) = 0"),
    "load_rejects": (f"WITH {F7_CTES} SELECT envelope_id, pos, CASE WHEN status <> 'ok' THEN status "
                     f"ELSE 'missing:' || array_to_string(missing, ',') END AS reason FROM miss_f "
                     f"WHERE NOT (status = 'ok' AND len(missing) = 0)"),
    "load_counts": (f"WITH {F7_CTES} SELECT COUNT(*) FILTER (WHERE status = 'ok' AND len(missing) = 0) AS inserted, "
                    f"COUNT(*) FILTER (WHERE NOT (status = 'ok' AND len(missing) = 0)) AS skipped FROM miss_f"),
    "clean_features": (f"{feats_w()} SELECT ticker, date, {_round_list(FEATURE_NAMES)} FROM f6 WHERE "
                       + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)),
    "min_history": (f"WITH e AS ({prices_sql(event_bars_sql('user_id'))}) SELECT ticker, date, n_bars FROM "
                    f"(SELECT ticker, date, COUNT(*) OVER (PARTITION BY ticker) AS n_bars FROM e) WHERE n_bars >= 50"),
    "valid_requests": f"WITH {F8_CTES} SELECT ticker, date FROM reqs WHERE ticker IS NOT NULL AND date IS NOT NULL",
    "strict_ok": f"WITH {F4_CTES} SELECT ticker, quarter_end_date, load_seq, ({STRICT_OK}) AS strict_ok FROM staging",
    "matured": (f"WITH {F4_CTES} SELECT ticker, quarter_end_date, load_seq, (max_close_30d IS NULL AND "
                f"earnings_call_date <= DATE '{AS_OF}' - INTERVAL 31 DAY) AS matured FROM final"),
    "service_rows": _service_sql(F8_CTES),
    "service_rows_300": _service_sql(F8_DAILY),
    "stream_features": _service_sql(F8_CTES),
    "price_history_asof_300": f"WITH {F8_DAILY} SELECT * FROM hist",
    "stream_load": (f"WITH {F7_CTES} SELECT ticker, event_type, props FROM miss_f "
                    f"WHERE status = 'ok' AND len(missing) = 0"),
    "feature_set_daily": (f"WITH {feature_ctes(PRICES_D)} SELECT ticker, date, {_round_list(IND_GROUPS['feature_set'])} FROM f6"),
    "incremental_indicators": (f"{feats_w()} SELECT ticker, date, "
                               f"{_round_list(['close', 'ema_10', 'ema_50', 'obv', 'rsi_14'])}, FALSE AS late FROM f6"),
    "threshold_default": "SELECT CAST(0.5 AS DOUBLE) AS threshold, COUNT(DISTINCT l_suppkey) AS tickers FROM lineitem",
    "max_close_by_day": (f"SELECT ticker, date AS call_date, MAX(adj_close) AS calculated_max_close "
                         f"FROM ({BARS_D}) GROUP BY ticker, date"),
    "price_feature_join": f"""WITH {F4_CTES}, db AS ({BARS_D})
SELECT f.ticker, f.quarter_end_date, mp.calculated_max_close
FROM final f JOIN (SELECT ticker, date AS call_date, MAX(adj_close) AS calculated_max_close
                   FROM db GROUP BY ticker, date) mp
  ON f.ticker = mp.ticker AND f.earnings_call_date = mp.call_date
WHERE f.max_close_30d IS NULL AND f.earnings_call_date <= DATE '{AS_OF}' - INTERVAL 31 DAY""",
    "null_profile": (f"WITH {F4_CTES} SELECT COUNT(*) AS row_count, "
                     + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in F4_STRICT + F4_SOFT)
                     + " FROM staging"),
    "quality_gate": _quality_gate_sql(),
    "post_merge_profile": (f"WITH {merge_ctes()} SELECT "
                           + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
                                       for c in ["summary_norm", "lda_topic_0", "pos_prob"])
                           + " FROM merged"),
    "class_balance": f"""{train_ctes()}
SELECT 'LONG' AS direction, target_long AS target, COUNT(*) AS n,
  {r6('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM clean)')} AS share FROM clean GROUP BY target_long
UNION ALL
SELECT 'SHORT', target_short, COUNT(*), {r6('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM clean)')}
FROM clean GROUP BY target_short""",
    "auto_weight": _auto_weight_sql(),
    "validate_matrix": _matrix_sql(),
    "latest_per_key": (f"WITH {F4_CTES} SELECT {F4_SCALAR_LIST}, len(summary_embedding) AS embedding_size "
                       f"FROM ({dedupe('SELECT * FROM staging')})"),
    "latest_per_series": (f"{feats_w()}, cl AS (SELECT * FROM f6 WHERE "
                          + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)
                          + f") SELECT ticker, date, close, {r4('sma_200')} AS sma_200, {r4('rsi_14')} AS rsi_14 "
                            f"FROM cl QUALIFY date = MAX(date) OVER (PARTITION BY ticker)"),
    "lead_close": (f"SELECT ticker, date, close, LEAD(close) OVER (PARTITION BY ticker ORDER BY date) AS next_close "
                   f"FROM ({PRICES_W})"),
    "pct_change": (f"SELECT ticker, date, {r6(div('close', 'LAG(close) OVER (PARTITION BY ticker ORDER BY date)') + ' - 1.0')} "
                   f"AS close_pct_change FROM ({PRICES_W})"),
    "rolling_mean": (f"SELECT ticker, date, {r4('CASE WHEN COUNT(volume) OVER w = 20 THEN AVG(volume) OVER w END')} "
                     f"AS volume_sma_20 FROM ({PRICES_W}) "
                     f"WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"),
    "cumulative_sum": (f"SELECT ticker, date, CASE WHEN volume IS NOT NULL THEN SUM(volume) OVER "
                       f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END "
                       f"AS volume_cum FROM ({PRICES_W})"),
    "linear_scan": _linear_scan_sql(),
    **{k: _ind_sql(v) for k, v in IND_GROUPS.items()},
    "label_long": (f"{feats_w()} SELECT ticker, date, close, next_close, {r4('atrr_14')} AS atrr_14, "
                   f"CASE WHEN next_close - close > 0.5 * atrr_14 THEN 1 ELSE 0 END AS target FROM f6"),
    "label_short": (f"{feats_w()} SELECT ticker, date, close, next_close, {r4('atrr_14')} AS atrr_14, "
                    f"CASE WHEN close - next_close > 0.5 * atrr_14 THEN 1 ELSE 0 END AS target FROM f6"),
    "chrono_split": f"{train_ctes()} SELECT ticker, date, split FROM sp",
    "topk_per_direction": f"""{train_ctes()},
pairs AS (SELECT ticker, date, 'CALL' AS contract_type, prob_long AS prob FROM scored
          UNION ALL SELECT ticker, date, 'PUT', prob_short FROM scored)
SELECT contract_type, ticker, date, prob, rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY contract_type ORDER BY prob DESC, ticker, date) AS rank FROM pairs)
WHERE rank <= 10""",
    "ranked_picks": f"""{train_ctes()},
pairs AS (SELECT ticker, date, 'CALL' AS contract_type, prob_long AS prob FROM scored
          UNION ALL SELECT ticker, date, 'PUT', prob_short FROM scored),
top AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY contract_type ORDER BY prob DESC, ticker, date) AS rk
        FROM pairs) WHERE rk <= 10)
SELECT contract_type, ticker, date, prob,
  ROW_NUMBER() OVER (ORDER BY prob DESC, contract_type, ticker, date) AS overall_rank FROM top""",
    "precision_at_k": f"""{train_ctes()},
top AS (SELECT * FROM val_long ORDER BY prob DESC, ticker, date LIMIT 100)
SELECT {r6('AVG(CAST(target AS DOUBLE))')} AS prec_at_100, {r6('MIN(prob)')} AS threshold_at_100 FROM top""",
    "average_precision": f"""{train_ctes()}
SELECT 'LONG' AS direction, {r6(ap_sql('val_long'))} AS pr_auc
UNION ALL SELECT 'SHORT', {r6(ap_sql('val_short'))}""",
    "brier": f"{train_ctes()} SELECT {r6('AVG(POW(prob - target, 2))')} AS brier FROM val_long",
    "metrics": f"""{train_ctes()},
top AS (SELECT * FROM val_long ORDER BY prob DESC, ticker, date LIMIT 100)
SELECT {r6(ap_sql('val_long'))} AS pr_auc,
  {r6('(SELECT AVG(POW(prob - target, 2)) FROM val_long)')} AS brier,
  {r6('(SELECT AVG(CAST(target AS DOUBLE)) FROM top)')} AS prec_at_100,
  {r6('(SELECT MIN(prob) FROM top)')} AS threshold_at_100""",
    "class_weights": _class_weights_sql(),
    "threshold_flag": (f"{train_ctes()} SELECT ticker, date, prob_long AS prob, "
                       f"CAST(CASE WHEN prob_long > {FLAG_THRESHOLD!r} THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM scored"),
    "tiers": (f"{picks_sql(FLAG_THRESHOLD)} SELECT ticker, contract_type, prob, "
              f"CASE WHEN prob > {FLAG_THRESHOLD!r} THEN 'Tier 1' ELSE 'Tier 2' END AS tier FROM picks"),
    "daily_picks": f"{picks_sql(FLAG_THRESHOLD)} SELECT * FROM picks",
    "merge_upsert": f"WITH {merge_ctes()} SELECT {F4_SCALAR_LIST}, len(summary_embedding) AS embedding_size FROM merged",
    "merge_actions": (f"WITH {merge_ctes()} SELECT "
                      + ", ".join(f"COUNT(*) FILTER (WHERE _action = '{a}') AS {a}"
                                  for a in ("update", "insert", "skip", "keep"))
                      + ", COUNT(*) FILTER (WHERE _action IN ('update', 'insert')) AS affected FROM mplan"),
    "merge_pipeline": (f"WITH {F4_CTES} SELECT {F4_SCALAR_LIST}, "
                       f"CASE WHEN (SELECT COUNT(*) FROM staging WHERE NOT ({STRICT_OK})) > 0 "
                       f"THEN 'aborted_strict_nulls' ELSE 'merged' END AS status FROM final"),
    "merge_pipeline_ungated": f"WITH {merge_ctes()} SELECT {F4_SCALAR_LIST}, 'merged' AS status FROM merged",
    "backfill_as_coded": _backfill_sql("as_coded"),
    "backfill_forward_window": _backfill_sql("forward_window"),
}
