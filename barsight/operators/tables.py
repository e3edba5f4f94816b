"""Feature-table operators: de-duplication, profiles, quality gate, MERGE,
late backfill, discovery (W1, A1-A5, A9, J1, J2, J4, J5, M1-M3, U3)."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from barsight.functions.columns import all_not_null
from barsight.operators.series import desc_nulls_last_key, latest_per_group

log = logging.getLogger(__name__)

# Fixed values that must equal the reference's configuration.
STRICT_NOT_NULL_COLUMNS = [
    "ticker", "quarter_end_date", "earnings_call_date", "summary_embedding",
    "sector", "industry", "adj_close_on_call_date", "industry_sector",
]
SOFT_NOT_NULL_COLUMNS = [
    "sentiment_score", "eps_surprise", "eps_missing",
    "sma_20", "ema_50", "rsi_14", "adx_14", "sma_20_delta", "ema_50_delta",
    "rsi_14_delta", "adx_14_delta",
    "eps_surprise_isnull", "price_sma20_ratio", "ema50_sma20_ratio", "rsi_centered",
    "sent_rsi", "adx_log1p", "summary_norm", "summary_mean", "summary_std",
    "lda_topic_0", "lda_topic_1", "lda_topic_2", "lda_topic_3", "lda_topic_4",
    "lda_topic_5", "lda_topic_6", "lda_topic_7", "lda_topic_8", "lda_topic_9",
    "pos_prob", "neg_prob", "neu_prob",
]
NULL_THRESHOLD_PCT = 0.10
PRIMARY_KEYS = ["ticker", "quarter_end_date"]
POST_MERGE_MARKERS = ("_norm", "lda_", "_prob")
MATURITY_DAYS = 31


# ----------------------------------------------------------------------------- W1
def latest_per_key(df: DataFrame, keys: list[str] | None = None,
                   order_col: str = "earnings_call_date", tie: list[str] | None = None) -> DataFrame:
    """Newest row per key by ``order_col DESC NULLS LAST`` then ``tie DESC``.

    Combined map-side (see :func:`latest_per_group`), so duplicate-heavy keys
    do not pile up in one task."""
    keys = keys or PRIMARY_KEYS
    tie = ["load_seq"] if tie is None and "load_seq" in df.columns else (tie or [])
    order = desc_nulls_last_key(F.col(order_col)) + [F.col(x) for x in tie]
    return latest_per_group(df, keys, order)


# ----------------------------------------------------------------------------- A1/A2/A3/A4
def max_close_by_day(prices: DataFrame, value: str = "adj_close") -> DataFrame:
    """A1: ``MAX(adj_close)`` per (ticker, date)."""
    return prices.groupBy("ticker", F.col("date").alias("call_date")).agg(
        F.max(value).alias("calculated_max_close"))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """A2: one pass, ``row_count`` and ``null_<col>`` per column."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def quality_report(staging: DataFrame, strict: list[str] | None = None,
                   soft: list[str] | None = None,
                   threshold: float = NULL_THRESHOLD_PCT) -> DataFrame:
    """A3: the profile unpivoted to (column, kind, null_count, row_count, null_pct, level).

    level: 'abort' for a strict column with any NULL; for soft columns 'warn'
    above ``threshold``, 'info' above 0, else 'ok'."""
    strict = STRICT_NOT_NULL_COLUMNS if strict is None else strict
    soft = SOFT_NOT_NULL_COLUMNS if soft is None else soft
    prof = null_profile(staging, list(strict) + list(soft))
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"),
                        F.col(f"null_{c}").alias("null_count"))
               for kind, cols in (("strict", strict), ("soft", soft)) for c in cols]
    rows = prof.select("row_count", F.explode(F.array(*entries)).alias("_e")).select(
        "_e.column_name", "_e.kind", "_e.null_count", "row_count")
    pct = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count")).otherwise(F.lit(0.0))
    level = (F.when((F.col("kind") == "strict") & (F.col("null_count") > 0), F.lit("abort"))
             .when((F.col("kind") == "soft") & (pct > F.lit(threshold)), F.lit("warn"))
             .when((F.col("kind") == "soft") & (F.col("null_count") > 0), F.lit("info"))
             .otherwise(F.lit("ok")))
    return rows.select("column_name", "kind", "null_count", "row_count", pct.alias("null_pct"),
                       level.alias("level"))


def post_merge_columns(soft: list[str] | None = None) -> list[str]:
    soft = SOFT_NOT_NULL_COLUMNS if soft is None else soft
    return [c for c in soft if any(m in c for m in POST_MERGE_MARKERS)]


def post_merge_profile(final: DataFrame, soft: list[str] | None = None) -> DataFrame:
    """A4: null counts of the engineered soft columns in the final table."""
    cols = [c for c in post_merge_columns(soft) if c in final.columns]
    return final.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


# ----------------------------------------------------------------------------- U3
def schema_difference(staging: DataFrame, final: DataFrame) -> tuple[set, set]:
    """(only in staging, only in final)."""
    s, f = set(staging.columns), set(final.columns)
    return s - f, f - s


# ----------------------------------------------------------------------------- M1/J4
def plan_merge(target: DataFrame, source: DataFrame, keys: list[str] | None = None,
               insert_if: Column | None = None) -> DataFrame:
    """M1: the target's next snapshot with an ``_action`` column.

    matched -> 'update' (every non-key column from the source, NULLs included);
    target only -> 'keep'; source only -> 'insert' when ``insert_if`` holds,
    else 'skip' (dropped from the snapshot but reported).

    A NULL key never matches.  Rows with a NULL key get a salt that differs
    between the two sides, so that one full outer join takes all rows and they
    do not pile up in the hash partition of the NULL key.
    """
    keys = keys or PRIMARY_KEYS
    cols = target.columns
    insert_if = insert_if if insert_if is not None else F.lit(True)

    def salt(sign: int) -> Column:
        spread = F.pmod(F.xxhash64(*cols), F.lit(1024)) + 1
        return F.when(all_not_null(keys), F.lit(0)).otherwise(F.lit(sign) * spread).cast("int")

    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"), salt(1).alias("_t_salt"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_in_s"),
                      insert_if.alias("_ins"), salt(-1).alias("_s_salt"))
    cond = [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys] + [F.col("_t_salt") == F.col("_s_salt")]
    joined = t.join(s, cond, "full_outer")
    both = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    only_s = F.col("_in_t").isNull()
    action = (F.when(both, F.lit("update")).when(only_s & F.col("_ins"), F.lit("insert"))
              .when(only_s, F.lit("skip")).otherwise(F.lit("keep")))
    out_cols = []
    for c in cols:
        if c in keys:
            out_cols.append(F.coalesce(F.col(f"_t_{c}"), F.col(f"_s_{c}")).alias(c))
        else:
            out_cols.append(F.when(F.col("_in_s").isNotNull(), F.col(f"_s_{c}"))
                            .otherwise(F.col(f"_t_{c}")).alias(c))
    return joined.select(*out_cols, action.alias("_action"))


def merge_snapshot(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("_action") != "skip").drop("_action")


def merge_counts(plan: DataFrame) -> DataFrame:
    """Rows per action; ``affected`` = updated + inserted."""
    return plan.agg(*[F.count_if(F.col("_action") == a).alias(a)
                      for a in ("update", "insert", "skip", "keep")],
                    F.count_if(F.col("_action").isin("update", "insert")).alias("affected"))


def merge_upsert(target: DataFrame, staging: DataFrame, keys: list[str] | None = None,
                 strict: list[str] | None = None, dedupe_order: str = "earnings_call_date",
                 tie: list[str] | None = None) -> DataFrame:
    """M1 as the reference plans it: W1(staging) then MERGE with the strict
    not-null insert filter (P10)."""
    keys = keys or PRIMARY_KEYS
    strict = STRICT_NOT_NULL_COLUMNS if strict is None else strict
    src = latest_per_key(staging, keys, dedupe_order, tie)
    return plan_merge(target, src, keys, all_not_null(strict))


# ----------------------------------------------------------------------------- M2/M2b/J1/J5
def matured(target_col: str = "max_close_30d", date_col: str = "earnings_call_date",
            as_of=None, days: int = MATURITY_DAYS) -> Column:
    """Target column NULL and the event at least ``days`` before ``as_of``."""
    as_of = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.col(target_col).isNull() & (F.col(date_col) <= F.date_sub(as_of, days))


def backfill_source(features: DataFrame, prices: DataFrame, as_of=None, mode: str = "as_coded",
                    days: int = 30, target_col: str = "max_close_30d") -> DataFrame:
    """Rows of the MERGE source: (ticker, quarter_end_date, calculated_max_close).

    ``as_coded`` (M2/J1): the max close on the call date itself, as the
    reference's SQL computes it.  ``forward_window`` (M2b): the max close over
    the ``days`` calendar days after the call (call day excluded); the range
    condition becomes an equi-join on an exploded day offset, so every
    candidate date is an exact key and nothing is capped."""
    ready = features.where(matured(target_col, as_of=as_of)).select(
        "ticker", "quarter_end_date", "earnings_call_date")
    if mode == "as_coded":
        mp = max_close_by_day(prices)
        return ready.join(mp, (ready.ticker == mp.ticker) & (ready.earnings_call_date == mp.call_date)) \
            .select(ready.ticker, ready.quarter_end_date, mp.calculated_max_close)
    if mode != "forward_window":
        raise ValueError(mode)
    days_ahead = ready.select("ticker", "quarter_end_date",
                              F.explode(F.sequence(F.date_add("earnings_call_date", 1),
                                                   F.date_add("earnings_call_date", days))).alias("d"))
    px = prices.select(F.col("ticker").alias("_pt"), F.col("date").alias("_pd"), "adj_close")
    return (days_ahead.join(px, (days_ahead.ticker == px._pt) & (days_ahead.d == px._pd))
            .groupBy("ticker", "quarter_end_date")
            .agg(F.max("adj_close").alias("calculated_max_close")))


def plan_backfill(features: DataFrame, source: DataFrame, target_col: str = "max_close_30d",
                  keys: list[str] | None = None) -> DataFrame:
    """UPDATE ... FROM as a left join; adds ``_updated``."""
    keys = keys or PRIMARY_KEYS
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                      F.col("calculated_max_close").alias("_new"), F.lit(True).alias("_hit"))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    j = features.join(s, cond, "left")
    out = [F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(target_col)).alias(c)
           if c == target_col else F.col(c) for c in features.columns]
    return j.select(*out, F.coalesce(F.col("_hit"), F.lit(False)).alias("_updated"))


# ----------------------------------------------------------------------------- S3/A5/J2/P12/P13
def key_string(cols: list[str], df: DataFrame) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in cols:
        if isinstance(types[c], (DateType, TimestampType)):
            parts.append(F.date_format(F.col(c), "yyyy-MM-dd"))
        else:
            parts.append(F.col(c).cast("string"))
    return F.concat_ws("_", *parts)


def existing_keys(features: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """S3/A5: distinct keys as ``ticker_YYYY-MM-DD`` strings."""
    key_cols = key_cols or PRIMARY_KEYS
    d = features.select(*key_cols).distinct()
    return d.select(key_string(key_cols, d).alias("key")).distinct()


def listing_keys(listing: DataFrame, suffix: str = ".txt") -> DataFrame:
    """S4 projection: keep names ending in ``suffix``; key = base name without it."""
    name = F.regexp_extract(F.col("path"), r"([^/]*)$", 1)
    kept = listing.where(F.col("path").endswith(suffix)).select("path", name.alias("_name"))
    return kept.select("path", F.expr(f"left(_name, length(_name) - {len(suffix)})").alias("key"))


def missing_work(listing: DataFrame, existing: DataFrame, suffix: str = ".txt") -> DataFrame:
    """Listed keys that are not in the existing-key set (left anti join)."""
    lk = listing_keys(listing, suffix)
    return lk.join(existing, "key", "left_anti")


def parse_key(key: Column) -> tuple[Column, Column, Column]:
    """``KEY`` -> (ticker, date string, ok); ok only for exactly two parts."""
    parts = F.split(key, "_")
    return F.get(parts, 0), F.get(parts, 1), F.size(parts) == 2


def work_items(missing: DataFrame, base_uri: str, summaries: str = "earnings-call-summaries/",
               transcripts: str = "earnings-call-transcripts/") -> DataFrame:
    """P13/K3 payload: one work item per well-formed missing key, plus ``ok``."""
    ticker, date, ok = parse_key(F.col("key"))
    base = base_uri.rstrip("/") + "/"
    return missing.select(
        "key", ticker.alias("ticker"), date.alias("quarter_end_date"),
        F.concat(F.lit(base), F.col("path")).alias("summary_path"),
        F.concat(F.lit(base + transcripts), F.col("key"), F.lit(".json")).alias("transcript_path"),
        ok.alias("ok"))
