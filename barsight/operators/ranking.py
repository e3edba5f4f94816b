"""Top-k, ordering, split and threshold operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsight.operators.ordering import global_position

CONTRACTS = {"LONG": "CALL", "SHORT": "PUT"}


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group under ``order`` (which should be total).

    ``row_number() <= k`` is planned as a partial WindowGroupLimit on every
    map partition before the shuffle, so only ``k`` rows per group and
    partition are exchanged — a group holding most of the rows is cut down
    map-side."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if rank_col:
        return out.withColumnRenamed("_rank", rank_col)
    return out.drop("_rank")


def threshold_flag(prob: Column, threshold: Column) -> Column:
    """1 if ``prob > threshold`` (strict), else 0."""
    return F.when(prob > threshold, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def tier(prob: Column, threshold: Column) -> Column:
    """E9: 'Tier 1' above the threshold, 'Tier 2' for the other ranked picks."""
    return F.when(prob > threshold, F.lit("Tier 1")).otherwise(F.lit("Tier 2"))


def chronological_split(df: DataFrame, t: str = "date", tie: list[str] | None = None,
                        train_fraction: float = 0.8, name: str = "split") -> DataFrame:
    """First ``floor(n * fraction)`` rows by ``(t, tie...)`` are 'train', the rest
    'validate'.  Positions come from a range-partitioned numbering, not a
    single-partition window."""
    tie = tie or ["ticker"]
    order = [F.col(t).asc()] + [F.col(x).asc() for x in tie]
    pos = global_position(df, order, "_pos")
    # the count is read from the materialised numbering, not from ``df`` again
    cut = pos.agg(F.floor(F.count(F.lit(1)) * F.lit(train_fraction)).alias("_cut")).scalar()
    return (pos.withColumn(name, F.when(F.col("_pos") < cut, F.lit("train"))
                           .otherwise(F.lit("validate")))
            .drop("_pos"))


def score_directions(df: DataFrame, probs: dict[str, Column], thresholds: dict[str, Column],
                     keep: list[str]) -> DataFrame:
    """One frame with a row per (bar, contract) for every scored direction."""
    entries = [F.struct(F.lit(CONTRACTS[d]).alias("contract_type"), p.cast("double").alias("prob"),
                        thresholds[d].cast("double").alias("threshold"))
               for d, p in probs.items()]
    return (df.select(*keep, F.explode(F.array(*entries)).alias("_e"))
            .select(*keep, "_e.contract_type", "_e.prob", "_e.threshold"))
