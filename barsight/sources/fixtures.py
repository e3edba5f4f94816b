"""Derivations of the reference's inputs from the driver tables (FIXTURES.md §2).

Every builder is a Spark plan over the given tables, so its work grows with
them.  The fixed values below (moduli, offsets, the request stride) are the
documented fixture rules, not sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barsight.sources.prices import read_table


def _bars(df: DataFrame, ticker, ts, price, qty, order: list, unit: str | None) -> DataFrame:
    """OHLCV bars per (ticker, period), aggregated map-side before the shuffle:
    a ticker that holds a large share of the raw rows is spread by date and
    reduced to its bars before the per-ticker windows gather it."""
    if unit is None:
        date = ts.cast("date")
    elif unit in ("hour", "minute"):
        date = F.date_trunc(unit, ts)
    else:
        date = F.date_trunc(unit, ts).cast("date")
    o = F.struct(*order)
    return (df.select(ticker.alias("ticker"), date.alias("date"), price.alias("_p"),
                      qty.alias("_q"), o.alias("_o"))
            .groupBy("ticker", "date")
            .agg(F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"),
                 F.min("_p").alias("low"), F.max_by("_p", "_o").alias("adj_close"),
                 F.sum("_q").alias("volume")))


def lineitem_bars(spark: SparkSession, root: str, unit: str | None = "week") -> DataFrame:
    """F1 (unit='week') / F2 (unit=None, daily) price_data from ``lineitem``."""
    li = read_table(spark, root, "lineitem")
    return _bars(li, F.col("l_suppkey").cast("string"), F.col("l_shipdate"),
                 F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
                 F.col("l_quantity"),
                 [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"),
                  F.col("l_partkey")], unit)


def weekly_bars(spark: SparkSession, root: str) -> DataFrame:
    return lineitem_bars(spark, root, "week")


def daily_bars(spark: SparkSession, root: str) -> DataFrame:
    return lineitem_bars(spark, root, None)


def event_bars(spark: SparkSession, root: str, key: str = "event_type") -> DataFrame:
    """hourly bars from ``events`` (ticker = event_type or user_id)."""
    ev = read_table(spark, root, "events")
    return _bars(ev, F.col(key).cast("string"), F.col("ts"), F.col("value"), F.lit(1.0),
                 [F.col("ts"), F.col("event_id")], "hour")


# --- F4: feature table -------------------------------------------------------
# Fixed fixture rules (FIXTURES.md F4): ticker = o_custkey % 150; industry NULL
# where o_orderkey % 23 = 0; eps_surprise NULL where o_orderkey % 7 = 0;
# staging = o_orderkey % 3 <> 0; final = o_orderkey % 6 = 0.
FEATURE_STRICT = ["ticker", "quarter_end_date", "earnings_call_date", "summary_embedding",
                  "sector", "industry", "adj_close_on_call_date", "industry_sector"]
FEATURE_SOFT = ["eps_surprise", "summary_norm", "lda_topic_0", "pos_prob"]


def feature_rows(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    qtr = F.date_trunc("quarter", F.col("o_orderdate"))
    qend = F.date_sub(F.add_months(qtr.cast("date"), 3), 1)
    return o.select(
        (F.col("o_custkey") % 150).cast("string").alias("ticker"),
        qend.alias("quarter_end_date"),
        F.col("o_orderdate").cast("date").alias("earnings_call_date"),
        F.array((F.col("o_totalprice") / 1000.0).cast("float"),
                (F.col("o_custkey") % 97).cast("float")).alias("summary_embedding"),
        F.col("o_orderstatus").alias("sector"),
        F.when(F.col("o_orderkey") % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("industry"),
        (F.col("o_totalprice") / 100.0).alias("adj_close_on_call_date"),
        F.concat(F.col("o_orderpriority"), F.lit("|"), F.col("o_orderstatus")).alias("industry_sector"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("eps_surprise"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 1e5).alias("summary_norm"),
        (F.col("o_custkey") % 10 / 10.0).alias("lda_topic_0"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("double"))
         .otherwise((F.col("o_orderkey") % 100) / 100.0).alias("pos_prob"),
        F.lit(None).cast("double").alias("max_close_30d"),
        F.col("o_orderkey").alias("load_seq"),
    )


def staging_features(spark: SparkSession, root: str) -> DataFrame:
    return feature_rows(spark, root).where(F.col("load_seq") % 3 != 0)


def final_features(spark: SparkSession, root: str) -> DataFrame:
    from barsight.operators.tables import latest_per_key
    return latest_per_key(feature_rows(spark, root).where(F.col("load_seq") % 6 == 0))


# --- F6: listing and existing keys --------------------------------------------
def object_listing(spark: SparkSession, root: str) -> DataFrame:
    """F6 listing as a table of paths (``summaries/<source>_<doc_id>.txt|.json``)."""
    d = read_table(spark, root, "documents")
    key = F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"))
    suffix = F.when(F.col("doc_id") % 10 == 0, F.lit(".json")).otherwise(F.lit(".txt"))
    return d.select(F.concat(F.lit("summaries/"), key, suffix).alias("path"))


def existing_feature_keys(spark: SparkSession, root: str) -> DataFrame:
    """F6 existing keys: labelled documents, as (ticker, quarter_end_date)-shaped parts."""
    d = read_table(spark, root, "documents").select("doc_id", "source")
    lab = read_table(spark, root, "labels").select("doc_id")
    return (d.join(lab, "doc_id", "left_semi")
            .select(F.col("source").alias("ticker"), F.col("doc_id").cast("string").alias("part2")))


# --- F7: messages ---------------------------------------------------------------
def message_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """one JSON envelope per event (``{"message": {"data": base64(json)}}``);
    events with ``event_id % 4 = 3`` are carried as a two-element ``messages``
    list (the message and a copy), malformed payloads where ``event_id % 50 = 0``,
    a blank ``event_type`` where ``event_id % 20 = 7``, and an envelope of
    neither shape where ``event_id % 97 = 5``."""
    ev = read_table(spark, root, "events")
    et = F.when(F.col("event_id") % 20 == 7, F.lit("")).otherwise(F.col("event_type"))
    payload = F.to_json(F.struct(F.col("user_id").alias("ticker"), et.alias("event_type"),
                                 F.col("props")))
    data = F.when(F.col("event_id") % 50 == 0, F.lit("%%not-base64%%")) \
        .otherwise(F.base64(F.encode(payload, "UTF-8")))
    msg = F.struct(data.alias("data"))
    body = (F.when(F.col("event_id") % 97 == 5, F.to_json(F.struct(F.array(msg).alias("items"))))
            .when(F.col("event_id") % 4 == 3, F.to_json(F.struct(F.array(msg, msg).alias("messages"))))
            .otherwise(F.to_json(F.struct(msg.alias("message")))))
    return ev.select(F.col("event_id").alias("envelope_id"), body.alias("body"))


# --- F8: as-of requests ----------------------------------------------------------
REQUEST_STRIDE = 40  # every 40th bar of each ticker
REQUEST_SHIFT_DAYS = 3


def feature_requests(bars: DataFrame) -> DataFrame:
    """F8: (ticker, date) requests derived from a bar table."""
    w = Window.partitionBy("ticker").orderBy("date")
    numbered = bars.select("ticker", "date", F.row_number().over(w).alias("_n"))
    regular = (numbered.where(F.col("_n") % REQUEST_STRIDE == 0)
               .select("ticker", F.date_add("date", REQUEST_SHIFT_DAYS).alias("date")))
    first = (bars.groupBy("ticker").agg(F.min("date").alias("d"))
             .agg(F.min("ticker").alias("ticker"), F.min_by("d", "ticker").alias("d")))
    before = first.select("ticker", F.date_sub("d", 1).alias("date"))
    nulls = first.select(F.lit(None).cast("string").alias("ticker"), F.col("d").alias("date")) \
        .unionByName(first.select("ticker", F.lit(None).cast("date").alias("date")))
    return regular.unionByName(before).unionByName(nulls)
