"""The features of series too long for one task.

:func:`barsight.operators.indicators.feature_set` keeps a series in one task.
Minute bars or ticks of one instrument can outgrow that.  Here a series is cut
into segments of a fixed number of bars that are worked on apart:

* bars are numbered through range partitions (by series and time) with offsets
  per (partition, series), so no task numbers a whole series;
* each segment gets copies of the ``HALO`` bars before it, which all lags and
  rolling windows need, and of the bar after it, for the next close;
* what reaches further back than the halo is carried in a small table with one
  row per segment: counts and sums of the seeds, the running volume, the last
  known volume, and the end value of every decayed sum.  A decayed sum of rate
  ``r`` enters a segment as ``sum_j R^(j-1) e_j`` over the end values ``e_j`` of
  the segments before, ``R = r^segment``.  Powers below the smallest double are
  zero, so the few terms above it (18 for the slowest rate) are all there are.

The task of a segment goes through its bars in panels (:mod:`barsight.operators.panel`);
:func:`segment_scans` is the same carry for a single scan in windows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.operators.indicators import FEATURES, OUT_ROWS, feature_schema
from barsight.operators.ordering import stored
from barsight.operators.panel import (
    CARRIES, LEVEL1, LEVEL2, RATE1, RATE2, fresh_carry, numbers, panel_step, panels, side_by_side, whole_series,
)
from barsight.operators.series import _fold, cumulative

SEGMENT = 1024   # bars of a segment; r ** -SEGMENT must stay finite
HALO = 256       # bars copied from the segment before; the longest rolling window has 200
ROWS_OF_A_TASK = 1_000_000
SMALLEST = 745   # exp(-745) is the smallest positive double
_IN_PARTITION = (1 << 33) - 1


def number_long_series(df: DataFrame, by: list[str], t: str, partitions: int | None = None) -> DataFrame:
    """``_key`` (the ``by`` columns; a null key is a series too), ``rn`` (0-based bar
    number) and ``n_bars`` of every row, without a task that holds a whole series.

    The range layout is stored: its bounds are sampled, and both the sizes and the
    numbers must come from the same partitions, also after a loss."""
    key = F.struct(*[F.col(c) for c in by])
    order = [*[F.col(c).asc() for c in by], F.col(t).asc()]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = stored(ranged.sortWithinPartitions(*order)
                    .select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("_at"))).withColumn("_key", key)
    pieces = ranged.groupBy("_pid", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    series = Window.partitionBy("_key")
    earlier = series.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_pid", "_key", F.sum("_n").over(series).alias("n_bars"),
                           (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (ranged.join(pieces, ["_pid", "_key"])
            .withColumn("rn", F.col("_at") + F.col("_shift")).drop("_pid", "_at", "_shift"))


def split_series(df: DataFrame, segment: int = SEGMENT, halo: int = HALO) -> DataFrame:
    """Rows of :func:`number_long_series` by segment ``_seg``, each segment with the
    ``halo`` rows before it and the row after it (``_own`` false)."""
    k, off = F.floor(F.col("rn") / segment), F.col("rn") % segment

    def copy(seg, own):
        return F.struct(seg.alias("_seg"), F.lit(own).alias("_own"))

    ahead = (off >= segment - halo) & ((k + 1) * segment < F.col("n_bars"))
    copies = F.array_compact(F.array(copy(k, True), F.when(ahead, copy(k + 1, False)),
                                     F.when((off == 0) & (k > 0), copy(k - 1, False))))
    return df.select("*", F.explode(copies).alias("_c")).select(*df.columns, "_c._seg", "_c._own")


def _earlier(rows: int | None = None) -> Window:
    return Window.partitionBy("_key").orderBy("_seg").rowsBetween(-rows if rows else Window.unboundedPreceding, -1)


def _carry(df: DataFrame, ends: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """``df`` with what its segment inherits: ``ends`` are aggregates of a segment's
    own rows, ``carried`` windows over the (series, segment) table of them."""
    table = df.where("_own").groupBy("_key", "_seg").agg(*[c.alias(n) for n, c in ends.items()])
    table = table.select("_key", "_seg", *[c.alias(n) for n, c in carried.items()])
    return df.join(table, ["_key", "_seg"])


def segment_scans(df: DataFrame, specs: list[tuple[str, Column, float]], segment: int = SEGMENT) -> DataFrame:
    """W7 over split series: ``y_t = r * y_{t-1} + b_t`` (null ``b`` counts as 0; rows
    that are not ``_own`` must have none) for every ``(name, b, r)``, 0 < r < 1."""
    by = ["_key", "_seg"]
    off = F.col("rn") - F.col("_seg") * segment
    inside, ends, carried, out = [], {}, {}, []
    for name, b, r in specs:
        if not 0 < r < 1 or -segment * math.log(r) > 700:
            raise ValueError(f"a segment of {segment} needs {math.exp(-700 / segment):.3f} < r < 1")
        scaled = F.when(F.col("_own"), F.coalesce(b, F.lit(0.0)) * F.pow(F.lit(r), -off)).otherwise(F.lit(0.0))
        inside.append((F.sum(scaled).over(cumulative(by)) * F.pow(F.lit(r), off)).alias(f"_u_{name}"))
        ends[f"_e_{name}"] = F.max_by(f"_u_{name}", "rn")
        ratio, terms = r ** segment, math.ceil(SMALLEST / (-segment * math.log(r)))
        carried[f"_y_{name}"] = F.aggregate(F.collect_list(f"_e_{name}").over(_earlier(terms)), F.lit(0.0), _fold(ratio))
        out.append((F.col(f"_u_{name}") + F.pow(F.lit(r), off + 1) * F.col(f"_y_{name}")).alias(name))
    df = _carry(df.select("*", *inside), ends, carried)
    return df.select("*", *out).drop(*[c.format(n) for n, _b, _r in specs for c in ("_u_{}", "_y_{}")])


def _segment_marks(rows, segment: int, halo: int) -> np.ndarray:
    """Which rows are the first of a segment, its halo included."""
    return np.asarray(rows["rn"]) == np.maximum(np.asarray(rows["_seg"]) * segment - halo, 0)


def _segment_panels(table: pa.Table, segment: int, halo: int):
    """(first own rows, panel's segments, rows of the cells, mine, tail, carry, new) of
    each panel of a table of whole segments; carries stand in columns ``_c_<name>``."""
    values = [numbers(table[c]) for c in ("high", "low", "close", "volume")]
    own = np.asarray(table["_own"])
    firsts = np.flatnonzero(_segment_marks(table, segment, halo))
    owned = np.add.reduceat(own.astype(np.int64), firsts)
    seg = np.asarray(table["_seg"])[firsts]
    starts = firsts + np.where(seg > 0, halo, 0)
    carry = fresh_carry(len(firsts))
    for at, name in enumerate(CARRIES):
        if f"_c_{name}" in table.column_names:
            carry[at] = numbers(table[f"_c_{name}"].take(pa.array(firsts)))
    carry[CARRIES.index("bars")] = seg * segment
    for some, places, mine in side_by_side(starts, owned):
        before = starts[some] - halo + np.arange(halo)[:, None]
        there = np.broadcast_to(seg[some] > 0, before.shape)
        tail = panels(values, np.where(there, before, 0), there)
        yield starts, some, places, mine, tail, carry[:, some], panels(values, places, mine)


def _segment_ends(df: DataFrame, stage: str, names: list[str], segment: int, halo: int) -> DataFrame:
    """``names`` at the end of each segment, (_key, _seg, ...), as far as ``stage``."""
    def ends(batches):
        for table in whole_series(batches, lambda batch: _segment_marks(batch, segment, halo)):
            for starts, some, _, _, tail, carry, new in _segment_panels(table, segment, halo):
                found = panel_step(tail, carry, new, until=stage)
                heads = table.select(["_key", "_seg"]).take(pa.array(starts[some]))
                columns = [*heads.columns, *[pa.array(found[n], from_pandas=True) for n in names]]
                yield from pa.table(columns, names=["_key", "_seg", *names]).combine_chunks().to_batches()

    fields = {f.name: f for f in df.schema.fields}
    return df.mapInArrow(ends, T.StructType([fields["_key"], fields["_seg"]] + [T.StructField(n, T.DoubleType()) for n in names]))


def _totals(names: list[str]) -> dict[str, Column]:
    return {n: F.coalesce(F.sum(n).over(_earlier()), F.lit(0.0)) for n in names}


def _decayed(names: list[str], rates, segment: int) -> dict[str, Column]:
    """What decayed sums are at the end of the segment before, from all ends before."""
    out = {}
    for name, r in zip(names, rates):
        terms = math.ceil(SMALLEST / (-segment * math.log(r)))
        out[name] = F.aggregate(F.collect_list(name).over(_earlier(terms)), F.lit(0.0), _fold(float(r) ** segment))
    return out


def segment_carries(df: DataFrame, segment: int) -> DataFrame:
    """(_key, _seg, ``_c_<name>``): the carries before each segment of ``df``, rows of
    :func:`split_series` with a halo of 1.  Four stages over the same rows: counts
    and sums of the seeds, averages, counts and sums of what the averages give, and
    averages of these.  What a stage hands on is a row per segment, stored."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / ROWS_OF_A_TASK))
    rows = (df.select("_key", "_seg", "_own", "rn", "high", "low", "close", "volume")
            .repartition(n, "_key", "_seg").sortWithinPartitions("_key", "_seg", "rn").persist(StorageLevel.DISK_ONLY))
    counts, sums = ["n_close", "n_range", "n_gain", "n_plus"], ["s_close", "s_range", "obv"]
    totals = ["n_macd", "s_macd", "n_dx"]
    volume = {"last_volume": F.last("last_volume", ignorenulls=True).over(_earlier())}
    stages = [("counts", [*counts, *sums, "last_volume"], {**_totals([*counts, *sums]), **volume}),
              ("level1", LEVEL1, _decayed(LEVEL1, RATE1, segment)), ("totals", totals, _totals(totals)),
              ("level2", LEVEL2, _decayed(LEVEL2, RATE2, segment))]
    carries = None
    for stage, names, carried in stages:
        known = rows if carries is None else rows.join(carries, ["_key", "_seg"]).sortWithinPartitions("_key", "_seg", "rn")
        ends = _segment_ends(known, stage, names, segment, 1)
        found = ends.select("_key", "_seg", *[c.alias(f"_c_{n}") for n, c in carried.items()])
        carries = stored(found if carries is None else carries.join(found, ["_key", "_seg"]))
    rows.unpersist()
    return carries


def long_feature_set(prices: DataFrame, by: list[str] | tuple = ("ticker",), t: str = "date",
                     segment: int = SEGMENT, keep: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """I31 as :func:`feature_set`, its rows and columns, for series of any length.

    Empty input gives no rows.  Rows of one (``by``, ``t``) count as bars of their
    own, in no stated order.  Only the numbered bars and the carries of the
    segments are stored; the rows with their halos are dealt once, for the last
    stage, and stream through it."""
    by, keep = list(by), list(keep or [])
    if segment < HALO:
        raise ValueError(f"a segment must hold the halo of {HALO} bars")
    bars = prices.select(*by, t, "open", "high", "low", "close", "volume", *keep)
    numbered = number_long_series(bars, by, t, partitions)
    carries = segment_carries(split_series(numbered, segment, 1), segment)
    dealt = split_series(numbered, segment).repartition("_key", "_seg")  # also where the carries are broadcast
    df = dealt.join(carries, ["_key", "_seg"]).sortWithinPartitions("_key", "_seg", "rn")
    made = [*FEATURES, "atrr_3"]
    schema = feature_schema(df, by, t, keep)
    names = schema.names

    def features(batches):
        for table in whole_series(batches, lambda batch: _segment_marks(batch, segment, HALO)):
            ahead = np.r_[numbers(table["close"])[1:], np.nan]
            ahead[np.flatnonzero(_segment_marks(table, segment, HALO))[1:] - 1] = np.nan
            for _, _, places, mine, tail, carry, new in _segment_panels(table, segment, HALO):
                found, _, _ = panel_step(tail, carry, new)
                at, own = places.T[mine.T], mine.T
                rows = table.take(pa.array(at))
                found = {"next_close": ahead[at], **{c: found[c].T[own] for c in made}}
                columns = [pa.array(found[c], from_pandas=True) if c in found else rows[c] for c in names]
                yield from pa.table(columns, names=names).combine_chunks().to_batches(max_chunksize=OUT_ROWS)

    return df.mapInArrow(features, schema)
