"""As-of history — the newest ``limit`` bars at or before each request."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.operators.panel import fresh_carry, numbers, panel_step, panels, side_by_side

DEFAULT_HISTORY = 300
VALUES = ["date", "open", "high", "low", "close", "volume"]
OUT_ROWS = 1 << 14  # rows of a batch of histories


def valid_requests(requests: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """Requests need a non-NULL ticker and date."""
    return requests.where(F.col(ticker).isNotNull() & F.col(date).isNotNull())


def request_stream(prices: DataFrame, requests: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """Bars and distinct valid requests as one stream: rows of a ticker stand
    together, by date, bars before the requests of their date.  ``_end`` is the
    number of the newest bar so far (-1: none), ``target_date`` is null for bars."""
    req = (valid_requests(requests, ticker, date)
           .select(F.col(ticker).alias("ticker"), F.col(date).cast("date").alias("target_date"))
           .distinct())
    bars = prices.where(F.col("close").isNotNull()).select("ticker", *VALUES, F.lit(None).cast("date").alias("target_date"))
    types = dict(bars.dtypes)
    stream = bars.unionByName(req.select("ticker", F.col("target_date").alias("date"), "target_date",
                                         *[F.lit(None).cast(types[c]).alias(c) for c in VALUES[1:]]))
    upto = Window.partitionBy("ticker").orderBy("date", F.col("target_date").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    return stream.withColumn("_end", F.count(F.when(F.col("target_date").isNull(), F.lit(1))).over(upto) - 1)


def asked_stretches(batches, limit: int) -> Iterator[tuple[pa.Table, pa.Table, np.ndarray, np.ndarray]]:
    """(requests, bars, starts, lengths) of the batches of a :func:`request_stream`:
    each request's newest ``limit`` bars are a stretch of the bars.  Of the batches
    before, the last ``limit`` bars are held, whatever the number of requests."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        mine = np.asarray(rows["target_date"].is_null())
        bars = rows.filter(pa.array(mine))
        bars = bars if held is None else pa.concat_tables([held, bars])
        asked = ~mine & (np.asarray(rows["_end"]) >= 0)
        if asked.any():
            lengths = np.minimum(np.asarray(rows["_end"])[asked] + 1, limit)
            newest = np.cumsum(mine)[asked] - 1 + bars.num_rows - int(mine.sum())
            yield rows.filter(pa.array(asked)), bars, newest - lengths + 1, lengths
        held = bars.slice(max(0, bars.num_rows - limit)).combine_chunks()


def history_asof(prices: DataFrame, requests: DataFrame, limit: int = DEFAULT_HISTORY,
                 ticker: str = "ticker", date: str = "date") -> DataFrame:
    """For every distinct valid request ``(ticker, target_date)`` the newest
    ``limit`` bars with ``date <= target_date``.

    Plan (one exchange, by ticker; no join): bars and requests form one stream per
    ticker, in which each request knows the number of its newest bar; the tasks
    read it in order, hold the last ``limit`` bars and write for each request its
    stretch of them.  The copies are neither sorted nor shuffled nor gathered.

    Output: ``ticker, target_date, date, open, high, low, close, volume``.
    """
    stream = request_stream(prices, requests, ticker, date)
    names = ["ticker", "target_date", *VALUES]

    def expand(batches):
        for asked, bars, starts, lengths in asked_stretches(batches, limit):
            step = max(1, OUT_ROWS // limit)
            for lo in range(0, len(starts), step):
                some = lengths[lo:lo + step]
                before = np.cumsum(some) - some
                places = np.repeat(starts[lo:lo + step] - before, some) + np.arange(some.sum())
                heads = asked.slice(lo, step).select(["ticker", "target_date"]).take(pa.array(np.repeat(np.arange(len(some)), some)))
                values = bars.select(VALUES).take(pa.array(places))
                yield from pa.table([*heads.columns, *values.columns], names=names).combine_chunks().to_batches()

    fields = {f.name: f for f in stream.schema.fields}
    return stream.mapInArrow(expand, T.StructType([T.StructField(c, fields[c].dataType) for c in names]))


def last_features(stream: DataFrame, limit: int, least: int, names: list[str]) -> DataFrame:
    """I31 at the newest bar of each request of a :func:`request_stream` that has at
    least ``least`` bars, from its newest ``limit`` bars alone: ``ticker,
    target_date, close, volume`` and the features ``names``."""
    head = ["ticker", "target_date", "close", "volume"]

    def features(batches):
        for asked, bars, starts, lengths in asked_stretches(batches, limit):
            enough = lengths >= least
            asked, starts, lengths = asked.filter(pa.array(enough)), starts[enough], lengths[enough]
            values = [numbers(bars[c]) for c in ("high", "low", "close", "volume")]
            out = {name: np.empty(len(starts)) for name in names}
            for some, places, mine in side_by_side(starts, lengths):
                found, _, _ = panel_step(np.zeros((4, 0, len(some))), fresh_carry(len(some)), panels(values, places, mine))
                for name in names:
                    out[name][some] = found[name][lengths[some] - 1, np.arange(len(some))]
            newest = bars.select(["close", "volume"]).take(pa.array(starts + lengths - 1))
            columns = [asked["ticker"], asked["target_date"], *newest.columns, *[pa.array(out[n], from_pandas=True) for n in names]]
            yield from pa.table(columns, names=[*head, *names]).combine_chunks().to_batches()

    fields = {f.name: f for f in stream.schema.fields}
    return stream.mapInArrow(features, T.StructType([T.StructField(c, fields[c].dataType) for c in head]
                                                    + [T.StructField(c, T.DoubleType()) for c in names]))
