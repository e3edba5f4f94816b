"""Spark side of the correctness check: one callable ``(spark, root) -> DataFrame``
per operator of SURVEY §2 that has a value oracle.

Outputs are rounded only here (never in the library): 4 decimals for
indicator values, 6 for probabilities and metrics, with the same
``floor(x*10^d+0.5)/10^d`` arithmetic as the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.functions.columns import coerce_float, round_half_up
from barsight.operators import series as S
from barsight.operators.asof import history_asof, valid_requests
from barsight.operators.indicators import FEATURES, feature_set
from barsight.operators.labels import with_labels
from barsight.operators.metrics import (
    average_precision, brier, class_balances, evaluate, matrix_problems, positive_weight,
    precision_at_k, with_class_weight,
)
from barsight.operators.ranking import (
    chronological_split, threshold_flag, tier, top_k_per_group,
)
from barsight.operators.tables import (
    backfill_source, existing_keys, latest_per_key, matured, max_close_by_day,
    merge_counts, merge_snapshot, merge_upsert, missing_work, null_profile, plan_backfill,
    post_merge_profile, quality_report, work_items,
)
from barsight.plans.ingestion import run_merge
from barsight.plans.scoring import (
    clean_features, daily_picks, formula_scores, latest_valid, min_history, service_rows,
    training_frame,
)
from barsight.sources import fixtures as FX
from barsight.sources.messages import decode_messages, load_counts, missing_fields, split_valid
from barsight.sources.prices import scan_prices

BASE_URI = "file:///data"
AS_OF = "2000-01-01"
FLAG_THRESHOLD = 0.6
MESSAGE_FIELDS = ["ticker", "event_type"]
F4_STRICT = FX.FEATURE_STRICT
F4_SOFT = FX.FEATURE_SOFT
F4_SCALARS = ["ticker", "quarter_end_date", "earnings_call_date", "sector", "industry",
              "adj_close_on_call_date", "industry_sector", "eps_surprise", "summary_norm",
              "lda_topic_0", "pos_prob", "max_close_30d", "load_seq"]

IND_GROUPS = {
    "ind_sma": ["sma_10", "sma_20", "sma_50", "sma_200"],
    "ind_ema": ["ema_10", "ema_50"],
    "ind_adx": ["adx_14"],
    "ind_macd": ["macd_12_26_9", "macdh_12_26_9", "macds_12_26_9"],
    "ind_rsi": ["rsi_14", "rsi_5"],
    "ind_stoch": ["stochk_14_3_3", "stochd_14_3_3"],
    "ind_roc": ["roc_1", "roc_3", "roc_5"],
    "ind_atr": ["atrr_14", "atrr_3", "atr_ratio"],
    "ind_bbands": ["bbl_20_2_0", "bbu_20_2_0", "bbb_20_2_0", "bbp_20_2_0"],
    "ind_obv": ["obv"],
    "ind_rvol": ["rvol_20"],
    "ind_volume_delta": ["volume_delta"],
    "ind_price_vs_sma": ["price_vs_sma20", "price_vs_sma50", "price_vs_sma200"],
    "ind_structure": ["dist_from_high", "dist_from_low", "close_loc"],
    "feature_set": FEATURES,
}


def r4(name, alias=None):
    return round_half_up(F.col(name), 4).alias(alias or name)


def r6(name, alias=None):
    return round_half_up(F.col(name), 6).alias(alias or name)


# --------------------------------------------------------------------------- fixtures
def prices_f1(spark, root):
    return scan_prices(FX.weekly_bars(spark, root))


def prices_f2(spark, root):
    return scan_prices(FX.daily_bars(spark, root))


def features_f1(spark, root):
    return feature_set(prices_f1(spark, root))


def scored_f9(spark, root):
    return formula_scores(training_frame(prices_f1(spark, root)))


def split_f9(spark, root):
    """The split of the scores and targets alone: it is stored, so the features stay behind."""
    scored = scored_f9(spark, root).select("ticker", "date", "prob_long", "prob_short", "target_long", "target_short")
    return chronological_split(scored, "date", ["ticker"], 0.8)


def validation_f9(spark, root, direction="long", split=None):
    sp = split if split is not None else split_f9(spark, root)
    return sp.where(F.col("split") == "validate").select(
        "ticker", "date", F.col(f"prob_{direction}").alias("prob"),
        F.col(f"target_{direction}").alias("target"))


def requests_f8(spark, root):
    return FX.feature_requests(FX.weekly_bars(spark, root))


# --------------------------------------------------------------------------- scans / sources
def q_scan_prices(spark, root):
    return prices_f1(spark, root)


def q_coerce_float32(spark, root):
    df = coerce_float(prices_f1(spark, root), ["open", "high", "low", "close"])
    return df.select("ticker", "date", "open", "high", "low", "close")


def q_price_history_asof(spark, root):
    return history_asof(prices_f1(spark, root), requests_f8(spark, root))


def q_price_history_asof_300(spark, root):
    """The default of 300 bars over daily bars, so that histories are cut."""
    return history_asof(prices_f2(spark, root), FX.feature_requests(FX.daily_bars(spark, root)))


def q_existing_keys(spark, root):
    return existing_keys(FX.existing_feature_keys(spark, root), ["ticker", "part2"])


def q_list_missing_work(spark, root):
    existing = existing_keys(FX.existing_feature_keys(spark, root), ["ticker", "part2"])
    return work_items(missing_work(FX.object_listing(spark, root), existing), BASE_URI)


def q_existing_feature_keys(spark, root):
    return existing_keys(FX.final_features(spark, root))


def _decoded(spark, root):
    schema = "ticker STRING, event_type STRING, props STRING"
    from pyspark.sql.types import _parse_datatype_string
    return decode_messages(FX.message_envelopes(spark, root), _parse_datatype_string(schema))


def q_decode_messages(spark, root):
    return _decoded(spark, root)


def q_missing_fields(spark, root):
    d = _decoded(spark, root)
    return d.select("envelope_id", "pos", F.array_join(missing_fields(d, MESSAGE_FIELDS), ",")
                    .alias("missing"))


def q_split_valid(spark, root):
    return split_valid(_decoded(spark, root), MESSAGE_FIELDS)[0]


def q_load_rejects(spark, root):
    return split_valid(_decoded(spark, root), MESSAGE_FIELDS)[1].select(
        "envelope_id", "pos", "reason")


def q_load_counts(spark, root):
    return load_counts(_decoded(spark, root), MESSAGE_FIELDS)


# --------------------------------------------------------------------------- predicates
def q_clean_features(spark, root):
    df = clean_features(features_f1(spark, root), narrow=False)
    return df.select("ticker", "date", *[r4(c) for c in FEATURES])


def q_min_history(spark, root):
    fs = feature_set(scan_prices(FX.event_bars(spark, root, "user_id")))
    return min_history(fs, 50).select("ticker", "date", "n_bars")


def q_valid_requests(spark, root):
    return valid_requests(requests_f8(spark, root))


def q_strict_ok(spark, root):
    from barsight.functions.columns import all_not_null
    st = FX.staging_features(spark, root)
    return st.select("ticker", "quarter_end_date", "load_seq", all_not_null(F4_STRICT).alias("strict_ok"))


def q_matured(spark, root):
    fin = FX.final_features(spark, root)
    return fin.select("ticker", "quarter_end_date", "load_seq",
                      matured(as_of=AS_OF).alias("matured"))


def q_service_rows(spark, root):
    out = service_rows(prices_f1(spark, root), requests_f8(spark, root))
    return out.select(*[r4(c) for c in FEATURES], r4("close_price"), "volume", "ticker", "date")


def q_service_rows_300(spark, root):
    out = service_rows(prices_f2(spark, root), FX.feature_requests(FX.daily_bars(spark, root)))
    return out.select(*[r4(c) for c in FEATURES], r4("close_price"), "volume", "ticker", "date")


def q_feature_set_daily(spark, root):
    """Series of several blocks."""
    return feature_set(prices_f2(spark, root)).select("ticker", "date", *[r4(c) for c in FEATURES])


def q_threshold_default(spark, root):
    """No stored threshold: the default, beside the universe it applies to."""
    from barsight.operators.model import load_threshold
    from barsight.session import ensure_checkpoint_dir
    bars = prices_f1(spark, root)
    return bars.agg(F.count_distinct("ticker").alias("tickers")).select(
        load_threshold(spark, f"{ensure_checkpoint_dir(spark)}/no-such-run").alias("threshold"), "tickers")


# --------------------------------------------------------------------------- aggregations
def q_max_close_by_day(spark, root):
    return max_close_by_day(FX.daily_bars(spark, root))


def q_price_feature_join(spark, root):
    return backfill_source(FX.final_features(spark, root), FX.daily_bars(spark, root), AS_OF)


def q_null_profile(spark, root):
    return null_profile(FX.staging_features(spark, root), F4_STRICT + F4_SOFT)


def q_quality_gate(spark, root):
    rep = quality_report(FX.staging_features(spark, root), F4_STRICT, F4_SOFT)
    return rep.select("column_name", "kind", "null_count", "row_count", r6("null_pct"), "level")


def q_post_merge_profile(spark, root):
    plan = merge_upsert(FX.final_features(spark, root), FX.staging_features(spark, root),
                        strict=F4_STRICT)
    return post_merge_profile(merge_snapshot(plan), F4_SOFT)


def q_class_balance(spark, root):
    tf = training_frame(prices_f1(spark, root))
    return class_balances(tf, {"LONG": "target_long", "SHORT": "target_short"}).select(
        "direction", "target", "n", r6("share"))


def q_auto_weight(spark, root):
    frame = training_frame(prices_f1(spark, root)).select("ticker", "date", "target_long", "target_short")
    train = chronological_split(frame).where(F.col("split") == "train")
    parts = [positive_weight(train, f"target_{d}").select(
        F.lit(d.upper()).alias("direction"), r6("pos_frac"), r6("suggested_weight"), r6("pos_weight"))
        for d in ("long", "short")]
    return parts[0].unionByName(parts[1])


def q_validate_matrix(spark, root):
    labelled = with_labels(min_history(features_f1(spark, root), 200))
    return matrix_problems(labelled, FEATURES, "target_long")


# --------------------------------------------------------------------------- windows
def _numbered(spark, root):
    return S.number_rows(prices_f1(spark, root), ["ticker"], "date")


def q_latest_per_key(spark, root):
    return latest_per_key(FX.staging_features(spark, root)).select(
        *F4_SCALARS, F.size("summary_embedding").cast("bigint").alias("embedding_size"))


def q_latest_per_series(spark, root):
    lv = latest_valid(clean_features(features_f1(spark, root), narrow=False))
    return lv.select("ticker", "date", "close", r4("sma_200"), r4("rsi_14"))


def q_lead_close(spark, root):
    df = _numbered(spark, root)
    return df.select("ticker", "date", "close", S.lead(F.col("close"), ["ticker"]).alias("next_close"))


def q_pct_change(spark, root):
    df = _numbered(spark, root)
    return df.select("ticker", "date", S.pct_change(F.col("close"), ["ticker"]).alias("_p")) \
        .select("ticker", "date", r6("_p", "close_pct_change"))


def q_rolling_mean(spark, root):
    df = S.rolling_means(_numbered(spark, root), [("_m", F.col("volume"), 20)], ["ticker"])
    return df.select("ticker", "date", r4("_m", "volume_sma_20"))


def q_cumulative_sum(spark, root):
    df = _numbered(spark, root)
    return df.select("ticker", "date", S.cumsum(F.col("volume"), ["ticker"]).alias("volume_cum"))


LINEAR_SCAN_R = 0.9


def q_linear_scan(spark, root):
    df = S.decayed_sums(_numbered(spark, root), [("y", F.col("close"), LINEAR_SCAN_R)], ["ticker"])
    return df.select("ticker", "date", r4("y"))


def _ind(cols):
    def q(spark, root):
        return features_f1(spark, root).select("ticker", "date", *[r4(c) for c in cols])
    return q


# --------------------------------------------------------------------------- labels, ranking, metrics
def q_label_long(spark, root):
    lab = with_labels(features_f1(spark, root), ("LONG",))
    return lab.select("ticker", "date", "close", "next_close", r4("atrr_14"), "target")


def q_label_short(spark, root):
    lab = with_labels(features_f1(spark, root), ("SHORT",))
    return lab.select("ticker", "date", "close", "next_close", r4("atrr_14"), "target")


def q_chrono_split(spark, root):
    return split_f9(spark, root).select("ticker", "date", "split")


def _scored_pairs(spark, root):
    sides = [F.struct(F.lit(c).alias("contract_type"), F.col(f"prob_{d}").alias("prob"), F.col(f"target_{d}").alias("target"))
             for c, d in (("CALL", "long"), ("PUT", "short"))]
    return scored_f9(spark, root).select("ticker", "date", F.explode(F.array(*sides)).alias("_s")).select("ticker", "date", "_s.*")


def q_topk_per_direction(spark, root):
    top = top_k_per_group(_scored_pairs(spark, root), ["contract_type"],
                          [F.col("prob").desc(), F.col("ticker").asc(), F.col("date").asc()], 10,
                          rank_col="rank")
    return top.select("contract_type", "ticker", "date", "prob", F.col("rank").cast("bigint"))


def q_ranked_picks(spark, root):
    top = top_k_per_group(_scored_pairs(spark, root), ["contract_type"],
                          [F.col("prob").desc(), F.col("ticker").asc(), F.col("date").asc()], 10)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("prob").desc(), F.col("contract_type").asc(), F.col("ticker").asc(),
                       F.col("date").asc())
    # at most 20 rows reach this window
    return top.select("contract_type", "ticker", "date", "prob",
                      F.row_number().over(w).cast("bigint").alias("overall_rank"))


def q_precision_at_k(spark, root):
    return precision_at_k(validation_f9(spark, root), 100, tie=["ticker", "date"]).select(
        r6("prec_at_k", "prec_at_100"), r6("threshold_at_k", "threshold_at_100"))


def q_average_precision(spark, root):
    sp = split_f9(spark, root)
    parts = [average_precision(validation_f9(spark, root, d, sp)).select(
        F.lit(d.upper()).alias("direction"), r6("pr_auc")) for d in ("long", "short")]
    return parts[0].unionByName(parts[1])


def q_brier(spark, root):
    return brier(validation_f9(spark, root)).select(r6("brier"))


def q_metrics(spark, root):
    m = evaluate(validation_f9(spark, root), tie=["ticker", "date"])
    return m.select(r6("pr_auc"), r6("brier"), r6("prec_at_100"), r6("threshold_at_100"))


def q_class_weights(spark, root):
    sp = split_f9(spark, root)
    train = sp.where(F.col("split") == "train")
    w = positive_weight(train, "target_long").select("pos_weight").scalar()
    weighted = with_class_weight(train, w, "target_long")
    return weighted.groupBy(F.col("target_long").alias("target"), r6("weight")).agg(
        F.count(F.lit(1)).alias("n"))


def q_threshold_flag(spark, root):
    sc = scored_f9(spark, root)
    return sc.select("ticker", "date", F.col("prob_long").alias("prob"),
                     threshold_flag(F.col("prob_long"), F.lit(FLAG_THRESHOLD)).alias("prediction"))


def q_tiers(spark, root):
    picks = daily_picks(prices_f1(spark, root),
                        thresholds={"LONG": F.lit(FLAG_THRESHOLD), "SHORT": F.lit(FLAG_THRESHOLD)})
    return picks.select("ticker", "contract_type", "prob",
                        tier(F.col("prob"), F.lit(FLAG_THRESHOLD)).alias("tier"))


def q_daily_picks(spark, root):
    return daily_picks(prices_f1(spark, root),
                       thresholds={"LONG": F.lit(FLAG_THRESHOLD), "SHORT": F.lit(FLAG_THRESHOLD)})


# --------------------------------------------------------------------------- DML-shaped
def _merge_plan(spark, root):
    return merge_upsert(FX.final_features(spark, root), FX.staging_features(spark, root),
                        strict=F4_STRICT)


def q_merge_upsert(spark, root):
    return merge_snapshot(_merge_plan(spark, root)).select(
        *F4_SCALARS, F.size("summary_embedding").cast("bigint").alias("embedding_size"))


def q_merge_actions(spark, root):
    return merge_counts(_merge_plan(spark, root))


def q_merge_pipeline(spark, root):
    status, snapshot = run_merge(FX.final_features(spark, root), FX.staging_features(spark, root),
                                 strict=F4_STRICT, soft=F4_SOFT, gate=True)
    return snapshot.select(*F4_SCALARS, F.lit(status).alias("status"))


def q_merge_pipeline_ungated(spark, root):
    status, snapshot = run_merge(FX.final_features(spark, root), FX.staging_features(spark, root),
                                 strict=F4_STRICT, soft=F4_SOFT, gate=False)
    return snapshot.select(*F4_SCALARS, F.lit(status).alias("status"))


def _backfill(spark, root, mode):
    fin = FX.final_features(spark, root)
    src = backfill_source(fin, FX.daily_bars(spark, root), AS_OF, mode)
    out = plan_backfill(fin, src)
    return out.select("ticker", "quarter_end_date", "load_seq", r4("max_close_30d"), "_updated")


def q_backfill_as_coded(spark, root):
    return _backfill(spark, root, "as_coded")


def q_backfill_forward_window(spark, root):
    return _backfill(spark, root, "forward_window")


QUERIES = {
    "scan_prices": q_scan_prices,
    "coerce_float32": q_coerce_float32,
    "price_history_asof": q_price_history_asof,
    "price_history_asof_300": q_price_history_asof_300,
    "service_rows_300": q_service_rows_300,
    "feature_set_daily": q_feature_set_daily,
    "threshold_default": q_threshold_default,
    "existing_keys": q_existing_keys,
    "existing_feature_keys": q_existing_feature_keys,
    "list_missing_work": q_list_missing_work,
    "decode_messages": q_decode_messages,
    "missing_fields": q_missing_fields,
    "split_valid": q_split_valid,
    "load_rejects": q_load_rejects,
    "load_counts": q_load_counts,
    "clean_features": q_clean_features,
    "min_history": q_min_history,
    "valid_requests": q_valid_requests,
    "strict_ok": q_strict_ok,
    "matured": q_matured,
    "service_rows": q_service_rows,
    "max_close_by_day": q_max_close_by_day,
    "price_feature_join": q_price_feature_join,
    "null_profile": q_null_profile,
    "quality_gate": q_quality_gate,
    "post_merge_profile": q_post_merge_profile,
    "class_balance": q_class_balance,
    "auto_weight": q_auto_weight,
    "validate_matrix": q_validate_matrix,
    "latest_per_key": q_latest_per_key,
    "latest_per_series": q_latest_per_series,
    "lead_close": q_lead_close,
    "pct_change": q_pct_change,
    "rolling_mean": q_rolling_mean,
    "cumulative_sum": q_cumulative_sum,
    "linear_scan": q_linear_scan,
    **{k: _ind(v) for k, v in IND_GROUPS.items()},
    "label_long": q_label_long,
    "label_short": q_label_short,
    "chrono_split": q_chrono_split,
    "topk_per_direction": q_topk_per_direction,
    "ranked_picks": q_ranked_picks,
    "precision_at_k": q_precision_at_k,
    "average_precision": q_average_precision,
    "brier": q_brier,
    "metrics": q_metrics,
    "class_weights": q_class_weights,
    "threshold_flag": q_threshold_flag,
    "tiers": q_tiers,
    "daily_picks": q_daily_picks,
    "merge_upsert": q_merge_upsert,
    "merge_actions": q_merge_actions,
    "merge_pipeline": q_merge_pipeline,
    "merge_pipeline_ungated": q_merge_pipeline_ungated,
    "backfill_as_coded": q_backfill_as_coded,
    "backfill_forward_window": q_backfill_forward_window,
}
