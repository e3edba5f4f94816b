"""Composed plans: cleaned feature matrix, training frame, daily picks (E11),
service rows (P14) and the formula scorer used for model-free checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsight.functions.columns import coerce_float, complete_rows, null_nonfinite
from barsight.operators.asof import DEFAULT_HISTORY, last_features, request_stream
from barsight.operators.indicators import FEATURES, feature_set
from barsight.operators.labels import with_labels
from barsight.session import ensure_checkpoint_dir
from barsight.operators.ranking import score_directions, threshold_flag, top_k_per_group

# History limits, picks per side, and the columns of the picks.
TRAIN_MIN_HISTORY = 200
SCORE_MIN_HISTORY = 50
SERVICE_MIN_HISTORY = 50
TOP_K = 10
PREDICTION_COLUMNS = ["ticker", "date", "close", "prob", "contract_type", "prediction"]


def min_history(df: DataFrame, n: int, count_col: str = "n_bars") -> DataFrame:
    """Keep series with at least ``n`` bars (A8 count computed in the feature plan)."""
    return df.where(F.col(count_col) >= n)


def clean_features(features: DataFrame, extra_required: list[str] | None = None,
                   narrow: bool = True) -> DataFrame:
    """P3 + P4 + P5: float32 narrowing, non-finite -> NULL, drop incomplete rows."""
    df = coerce_float(features, FEATURES, narrow=narrow)
    df = null_nonfinite(df, FEATURES)
    return complete_rows(df, FEATURES + list(extra_required or []))


def training_frame(prices: DataFrame, min_bars: int = TRAIN_MIN_HISTORY) -> DataFrame:
    """Features + both labels, computed once (the reference computes the
    features once per direction)."""
    fs = min_history(feature_set(prices), min_bars)
    labelled = with_labels(fs)
    return clean_features(labelled, ["target_long", "target_short"])


def latest_valid(df: DataFrame, by: list[str] | None = None, t: str = "date") -> DataFrame:
    """Newest row per series among the given (already filtered) rows, one
    even where the newest date stands twice (then the later bar number, or the
    greater values).

    A window over the series partition the feature plan already created: no
    extra exchange."""
    by = by or ["ticker"]
    ties = [F.col(x).desc_nulls_last() for x in ("rn", "close", "volume", "open", "high", "low") if x in df.columns]
    order = Window.partitionBy(*by).orderBy(F.col(t).desc_nulls_last(), *ties)
    return df.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def formula_probability(close_loc="close_loc", roc_1="roc_1") -> Column:
    """Model-free LONG score used by the checks: 1/(1+exp(-(4*close_loc-2+roc_1/10))),
    rounded to 6 decimals before any ranking."""
    from barsight.functions.columns import round_half_up
    z = F.lit(4.0) * F.col(close_loc) - F.lit(2.0) + F.col(roc_1) / F.lit(10.0)
    return round_half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def formula_scores(df: DataFrame) -> DataFrame:
    p = formula_probability()
    return df.withColumn("prob_long", p).withColumn(
        "prob_short", F.floor((F.lit(1.0) - F.col("prob_long")) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6))


def daily_picks(prices: DataFrame, probs: dict[str, Column] | None = None,
                thresholds: dict[str, Column] | None = None, k: int = TOP_K,
                min_bars: int = SCORE_MIN_HISTORY) -> DataFrame:
    """S1 -> I31 -> P6 -> P3/P4/P5 -> W2 -> score both directions (E7/U1) ->
    E8 -> top ``k`` per contract type (T1) -> overall order (T2).

    ``probs`` maps LONG/SHORT to probability columns over the feature frame
    (default: the formula scorer); ``thresholds`` to threshold columns
    (default 0.5, the reference's fallback)."""
    latest = latest_valid(clean_features(min_history(feature_set(prices), min_bars)))
    if probs is None:
        latest = formula_scores(latest)
        probs = {"LONG": F.col("prob_long"), "SHORT": F.col("prob_short")}
    thresholds = thresholds or {"LONG": F.lit(0.5), "SHORT": F.lit(0.5)}
    scored = score_directions(latest, probs, thresholds, ["ticker", "date", "close"])
    flagged = scored.withColumn("prediction", threshold_flag(F.col("prob"), F.col("threshold")))
    top = top_k_per_group(flagged, ["contract_type"],
                          [F.col("prob").desc(), F.col("ticker").asc(), F.col("date").asc()], k)
    return top.select(*PREDICTION_COLUMNS).orderBy(
        F.col("prob").desc(), F.col("contract_type").asc(), F.col("ticker").asc())


def service_rows(prices: DataFrame, requests: DataFrame, limit: int = DEFAULT_HISTORY,
                 min_bars: int = SERVICE_MIN_HISTORY) -> DataFrame:
    """X1 core (S2 -> I31 by (ticker, target_date) -> P14): one feature row per
    valid request whose history has at least ``min_bars`` bars.  Features are
    computed on the truncated history, exactly like the per-request service, and
    kept for its last bar; non-finite values become NULL."""
    last = last_features(request_stream(prices, requests), limit, min_bars, FEATURES)
    last = null_nonfinite(last, FEATURES)
    return last.select(*FEATURES, F.col("close").alias("close_price"), "volume", "ticker",
                       F.date_format("target_date", "yyyy-MM-dd").alias("date"))


def daily_picks_with_models(prices: DataFrame, models: dict, thresholds: dict | None = None,
                            k: int = TOP_K, min_bars: int = SCORE_MIN_HISTORY) -> DataFrame:
    """E11 with fitted models: each available direction is scored (E7), flagged
    (E8) and cut to its top ``k`` (T1); a missing model skips its direction
    (U1), as in the reference."""
    from barsight.operators.model import score
    latest = latest_valid(clean_features(min_history(feature_set(prices), min_bars)))
    # one row per ticker; cut here, so that the models' plans do not carry the feature plan
    ensure_checkpoint_dir(prices.sparkSession)
    feats = latest.select("ticker", "date", "close", *FEATURES).checkpoint()
    models = {d: m for d, m in models.items() if m is not None}
    if not models:
        raise ValueError("no model available for any direction")
    for direction, model in models.items():          # both models on one frame: the features are computed once
        feats = score(model, feats, f"_prob_{direction}")
    thresholds = thresholds or {}
    each = F.explode(F.array(*[F.struct(
        F.lit("CALL" if d == "LONG" else "PUT").alias("contract_type"), F.col(f"_prob_{d}").alias("prob"),
        threshold_flag(F.col(f"_prob_{d}"), thresholds.get(d, F.lit(0.5))).alias("prediction")) for d in models]))
    union = feats.select("ticker", "date", "close", each.alias("_p")).select("ticker", "date", "close", "_p.*")
    top = top_k_per_group(union, ["contract_type"],
                          [F.col("prob").desc(), F.col("ticker").asc(), F.col("date").asc()], k)
    return top.select(*PREDICTION_COLUMNS).orderBy(
        F.col("prob").desc(), F.col("contract_type").asc(), F.col("ticker").asc())


def write_predictions(picks: DataFrame, path: str) -> None:
    """K2: typed 6-column projection, whole table replaced."""
    picks.select(F.col("ticker").cast("string"), F.col("date").cast("date"),
                 F.col("close").cast("double"), F.col("prob").cast("double"),
                 F.col("contract_type").cast("string"), F.col("prediction").cast("bigint")) \
        .coalesce(1).write.mode("overwrite").parquet(path)
