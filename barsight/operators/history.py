"""J3/S2/T5 on pruned bars, split by blocks: the newest ``limit`` bars at or before
each request, without all requests of a ticker in one task.

1. **Prune.** A batch of requests names tickers and a newest date.  The date
   becomes a literal filter on the bars; so do the tickers while they are at most
   ``MOST_TICKERS`` (both reach the scan), else a semi join cuts the bars.
2. **Number.** Bars and requests form one narrow stream per ticker (no bar values,
   no copies); a running count numbers the bars and gives each request the number
   ``end`` of its newest eligible bar.
3. **Block.** Bars are gathered in blocks of ``limit`` consecutive numbers; each
   block also holds the block before it, so the ``limit`` bars up to any ``end``
   lie in the one block of that ``end``.  Requests join their block by (ticker,
   block): a ticker with many requests is dealt over its blocks, each pair is
   looked at once, and AQE may split a block with many requests.
4. **Cut.** ``slice`` takes the request's bars from the block.

A block holds at most 2 x ``limit`` bars, whatever the ticker or the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsight.operators.asof import DEFAULT_HISTORY, valid_requests

#: Tickers of a batch that are written into the scan's filter.
MOST_TICKERS = 1000
VALUES = ["date", "open", "high", "low", "close", "volume"]


def distinct_requests(requests: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    return (valid_requests(requests, ticker, date)
            .select(F.col(ticker).alias("ticker"), F.col(date).cast("date").alias("target_date")).distinct())


def pruned_bars(prices: DataFrame, requests: DataFrame, most: int = MOST_TICKERS) -> DataFrame:
    """The bars that a history of ``requests`` (ticker, target_date) can hold."""
    names = [r[0] for r in requests.select("ticker").distinct().limit(most + 1).collect()]
    newest = requests.agg(F.max("target_date")).first()[0]
    bars = prices.where(F.col("close").isNotNull()).select("ticker", *VALUES)
    if newest is None:
        return bars.where("false")
    bars = bars.where(F.col("date") <= F.lit(newest))
    if len(names) <= most:
        return bars.where(F.col("ticker").isin(names))
    return bars.join(requests.select("ticker").distinct(), "ticker", "left_semi")


def history_blocks(bars: DataFrame, limit: int) -> DataFrame:
    """(ticker, block, first, bars): the bars of blocks ``block - 1`` and ``block`` in
    order, ``first`` being the number of the first."""
    number = F.row_number().over(Window.partitionBy("ticker").orderBy("date")) - 1
    numbered = bars.withColumn("rn", number).withColumn("own", F.floor(F.col("rn") / limit))
    numbered = numbered.withColumn("last", F.max("own").over(Window.partitionBy("ticker")))
    copies = numbered.withColumn("block", F.explode(F.when(
        F.col("own") < F.col("last"), F.array("own", F.col("own") + 1)).otherwise(F.array("own"))))
    entry = F.struct("rn", *VALUES)
    return (copies.groupBy("ticker", "block").agg(F.sort_array(F.collect_list(entry)).alias("bars"))
            .select("ticker", "block", F.get("bars", F.lit(0))["rn"].alias("first"), "bars"))


def history_asof(prices: DataFrame, requests: DataFrame, limit: int = DEFAULT_HISTORY, ticker: str = "ticker",
                 date: str = "date", most: int = MOST_TICKERS, exploded: bool = True) -> DataFrame:
    """For every distinct valid request the newest ``limit`` bars with ``date <=
    target_date``: rows (ticker, target_date, date, open, high, low, close, volume),
    or with ``exploded=False`` one row (ticker, target_date, bars) for each request
    that has any bar."""
    asked = distinct_requests(requests, ticker, date)
    bars = pruned_bars(prices, asked, most)
    stream = bars.select("ticker", "date", F.lit(None).cast("date").alias("target_date")).unionByName(
        asked.select("ticker", F.col("target_date").alias("date"), "target_date"))
    upto = Window.partitionBy("ticker").orderBy("date", F.col("target_date").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    end = F.count(F.when(F.col("target_date").isNull(), F.lit(1))).over(upto) - 1
    ends = (stream.withColumn("end", end).where("target_date is not null and end >= 0")
            .select("ticker", "target_date", "end", F.floor(F.col("end") / limit).alias("block")))
    at = F.greatest(F.col("end") - (limit - 1), F.col("first")) - F.col("first")
    held = (ends.join(history_blocks(bars, limit), ["ticker", "block"])
            .select("ticker", "target_date", F.slice("bars", (at + 1).cast("int"), (F.col("end") - F.col("first") - at + 1).cast("int")).alias("bars")))
    if not exploded:
        return held
    return held.select("ticker", "target_date", F.explode("bars").alias("b")).select(
        "ticker", "target_date", *[F.col(f"b.{c}").alias(c) for c in VALUES])
