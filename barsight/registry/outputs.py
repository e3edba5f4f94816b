"""Queries and SQL of imported prices and of what is written out: predictions, work items."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.functions.columns import coerce_float, complete_rows, normalise_columns, null_nonfinite, to_date_col
from barsight.plans.ingestion import discover
from barsight.plans.scoring import write_predictions
from barsight.registry import oracle as O
from barsight.registry import spark_side as Q
from barsight.registry.sqlparts import bars_sql, r4
from barsight.session import ensure_checkpoint_dir
from barsight.sources import fixtures as FX
from barsight.streaming.emission import fill_outbox, start_emission

PER_FILE = 1000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/runs/{name}-{uuid.uuid4().hex[:8]}"


def q_imported_prices(spark: SparkSession, root: str) -> DataFrame:
    """P1-P5 on a price file of texts: on some days of a month a price is no number,
    infinite, NaN or beyond float32, the date is none, or the close is empty."""
    day = F.dayofmonth("date")

    def text(name, on, bad):
        return F.when(day == on, F.lit(bad)).otherwise(F.col(name).cast("string"))

    raw = FX.daily_bars(spark, root).select(
        F.col("ticker").alias("Ticker"), text("date", 11, "2024-13-45").alias("Date"), text("open", 3, "n/a").alias("Open"),
        text("high", 5, "inf").alias("High"), text("low", 7, "NaN").alias("Low"), text("adj_close", 13, "").alias("Adj.Close"),
        text("volume", 9, "1e300").alias("VOL"))
    values = ["open", "high", "low", "adj_close", "volume"]
    df = normalise_columns(raw, {"VOL": "Volume"}).withColumn("date", to_date_col("date"))
    df = complete_rows(null_nonfinite(coerce_float(df, values), values), ["date", "adj_close"])
    return df.select("ticker", "date", *[Q.r4(c) for c in values])


def q_predictions_table(spark: SparkSession, root: str) -> DataFrame:
    """K2: the daily picks as the predictions table holds them, written twice."""
    path, picks = _scratch(spark, "predictions"), Q.q_daily_picks(spark, root).checkpoint()
    write_predictions(picks.limit(1), path)
    write_predictions(picks, path)
    return spark.read.parquet(path)


def q_emitted_work_items(spark: SparkSession, root: str) -> DataFrame:
    """K3 and K4: discovered work items through outbox and emission, as the topic holds them."""
    base = _scratch(spark, "emission")
    items, _ = discover(FX.existing_feature_keys(spark, root), FX.object_listing(spark, root), Q.BASE_URI, key_cols=["ticker", "part2"])
    fill_outbox(items, f"{base}/outbox", PER_FILE)
    start_emission(spark, f"{base}/outbox", f"{base}/topic", f"{base}/_checkpoint", items.schema, PER_FILE,
                   available_now=True).awaitTermination()
    return spark.read.schema(items.schema).json(f"{base}/topic")


QUERIES = {
    "imported_prices": q_imported_prices,
    "predictions_table": q_predictions_table,
    "emitted_work_items": q_emitted_work_items,
}


def _narrow(name: str, on: int) -> str:
    return f"CASE WHEN day(date) <> {on} THEN {r4(f'CAST(CAST({name} AS FLOAT) AS DOUBLE)')} END AS {name}"


ORACLE = {
    "imported_prices": (f"SELECT ticker, date, {_narrow('open', 3)}, {_narrow('high', 5)}, {_narrow('low', 7)}, "
                        f"{_narrow('adj_close', 13)}, {_narrow('volume', 9)} FROM ({bars_sql(None)}) "
                        "WHERE day(date) NOT IN (11, 13) AND adj_close IS NOT NULL"),
    "predictions_table": O.ORACLE["daily_picks"],
    "emitted_work_items": (f"SELECT key, ticker, quarter_end_date, summary_path, transcript_path "
                           f"FROM ({O.ORACLE['list_missing_work']}) WHERE ok"),
}
