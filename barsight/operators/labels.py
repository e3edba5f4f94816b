"""L1-L3: volatility-scaled next-bar labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG, SHORT = "LONG", "SHORT"
LABEL_ATR_MULTIPLE = 0.5


def label_column(direction: str = LONG, atr_col: str = "atrr_14",
                 multiple: float = LABEL_ATR_MULTIPLE) -> Column:
    """1 if the next close moves beyond ``multiple * ATR`` in ``direction``, else 0.

    A comparison with a missing value (last bar, no ATR yet) gives 0, as in the
    reference, so the last bar of every series keeps target 0 (L3)."""
    move = (F.col("next_close") - F.col("close")) if direction == LONG else (
        F.col("close") - F.col("next_close"))
    return F.when(move > F.lit(multiple) * F.col(atr_col), F.lit(1)).otherwise(F.lit(0))


def with_labels(features: DataFrame, directions=(LONG, SHORT), drop_unlabelled: bool = False,
                atr_col: str = "atrr_14") -> DataFrame:
    """Add ``target_long`` / ``target_short`` (or one ``target`` for a single direction)."""
    cols = {f"target_{d.lower()}": label_column(d, atr_col) for d in directions}
    if len(directions) == 1:
        cols = {"target": label_column(directions[0], atr_col)}
    out = features.withColumns(cols)
    if drop_unlabelled:
        out = out.where(F.col("next_close").isNotNull())
    return out
