"""Price scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.functions.columns import finite_or_null

PRICE_COLUMNS = ["ticker", "date", "open", "high", "low", "adj_close", "volume"]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def scan_prices(raw: DataFrame) -> DataFrame:
    """S1 over an already-loaded ``price_data`` frame.

    Rows with a NULL ``adj_close`` are dropped and ``adj_close`` becomes
    ``close``; NaN and infinite values count as missing.  The reference's ORDER BY is not applied: every consumer orders
    inside its own window, so a global sort would be a wasted shuffle.
    """
    values = {x: finite_or_null(x) for x in ("open", "high", "low", "adj_close", "volume")}
    return (raw.where(F.col("adj_close").isNotNull()).where(values["adj_close"].isNotNull())
            .select("ticker", "date", values["open"].alias("open"), values["high"].alias("high"),
                    values["low"].alias("low"), values["adj_close"].alias("close"), values["volume"].alias("volume")))
