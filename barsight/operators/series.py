"""Generic per-series window operators (W1-W7) and the as-of history join.

A *series* is the set of rows sharing the ``by`` columns, ordered by ``t``.
All windows of one series plan share a single hash exchange on ``by``:
``hashpartitioning(by)`` satisfies every clustering used below, including
``(by, _blk)``, and every window is ordered by ``(_blk, rn)`` so one sort serves
the rolling windows, the in-block scans and the carry windows alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256  # rows per block; r**-255 must stay finite (checked)


def number_rows(df: DataFrame, by: list[str], t: str, block: int = BLOCK) -> DataFrame:
    """Add ``rn`` (0-based bar number), ``_blk`` and ``_off`` per series."""
    w = Window.partitionBy(*by).orderBy(F.col(t).asc())
    return (df.withColumn("rn", F.row_number().over(w) - 1)
            .withColumn("_blk", F.floor(F.col("rn") / F.lit(block)))
            .withColumn("_off", F.col("rn") % F.lit(block)))


def ordered(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy("_blk", "rn")


def rolling(by: list[str], length: int) -> Window:
    return ordered(by).rowsBetween(-(length - 1), 0)


def cumulative(by: list[str]) -> Window:
    return ordered(by).rowsBetween(Window.unboundedPreceding, 0)


def full_window(agg_fn, x, by: list[str], length: int) -> Column:
    """Rolling aggregate that is NULL unless the frame holds ``length`` non-null values."""
    w = rolling(by, length)
    return F.when(F.count(x).over(w) == F.lit(length), agg_fn(x).over(w))


def sma(x, by, length):
    """Full-window rolling mean."""
    return full_window(F.avg, x, by, length)


def lag(x, by, n=1):
    return F.lag(x, n).over(ordered(by))


def lead(x, by, n=1):
    """W3."""
    return F.lead(x, n).over(ordered(by))


def pct_change(x, by, n=1) -> Column:
    """``x_t / x_{t-n} - 1`` after forward-filling NULLs (pad)."""
    padded = F.last(x, ignorenulls=True).over(cumulative(by))
    return F.try_subtract(F.try_divide(padded, F.lag(padded, n).over(ordered(by))), F.lit(1.0))


def cumsum(x, by) -> Column:
    """Running sum; NULL where the input is NULL (the sum itself skips NULLs)."""
    return F.when(x.isNotNull(), F.sum(x).over(cumulative(by)))


# --------------------------------------------------------------------------- W7
def _in_block(by: list[str]) -> Window:
    return Window.partitionBy(*by, "_blk").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)


def _block_back(by: list[str], j: int) -> Window:
    """Frame holding exactly block ``_blk - j`` (a range frame on the block number:
    all rows of one block share it, so it is re-evaluated once per block)."""
    return Window.partitionBy(*by).orderBy("_blk").rangeBetween(-j, -j)


def scan_inputs(specs: list[tuple[str, Column, float]], by: list[str]) -> list[Column]:
    """Phase 1 of the block scan: in-block partial sums ``_u_<name>``."""
    off = F.col("_off")
    cols = []
    for name, b, r in specs:
        r = float(r)
        bb = F.coalesce(b, F.lit(0.0))
        if r > 0:
            u = F.sum(bb * F.pow(F.lit(r), -off)).over(_in_block(by)) * F.pow(F.lit(r), off)
        else:
            u = bb
        cols.append(u.alias(f"_u_{name}"))
    return cols


def _earlier_blocks(by: list[str]) -> Window:
    """All rows of earlier blocks: a range frame that grows once per block."""
    return Window.partitionBy(*by).orderBy("_blk").rangeBetween(Window.unboundedPreceding, -1)


def scan_carries(specs: list[tuple[str, Column, float]], by: list[str],
                 block: int = BLOCK) -> list[Column]:
    """Phase 2: the end values of all earlier blocks, oldest first, ``_e_<name>``
    (bars / ``block`` values)."""
    last = F.col("_off") == block - 1
    return [F.collect_list(F.when(last, F.col(f"_u_{name}")))
            .over(_earlier_blocks(by)).alias(f"_e_{name}") for name, _b, r in specs if float(r) > 0]


def _fold(ratio: float):
    return lambda carried, end: carried * F.lit(ratio) + end


def scan_results(specs: list[tuple[str, Column, float]], block: int = BLOCK) -> tuple[list[Column], list[str]]:
    """Phase 3: ``y = u + r^(off+1) * Y``, ``Y`` the fold ``Y = R * Y + e`` of the
    earlier block ends, ``R = r^block``; returns (columns, helper names)."""
    off = F.col("_off")
    out, helpers = [], []
    for name, _b, r in specs:
        r = float(r)
        if r >= 1.0 or (r > 0 and r ** -(block - 1) == math.inf):
            raise ValueError(f"decayed scan in blocks of {block} needs r = 0 or {10 ** (-300 / block):.2f} < r < 1")
        y = F.col(f"_u_{name}")
        helpers.append(f"_u_{name}")
        if r > 0:
            big_r = r ** block
            fold = F.aggregate(f"_e_{name}", F.lit(0.0), _fold(big_r))
            y = y + F.pow(F.lit(r), off + 1) * fold
            helpers.append(f"_e_{name}")
        out.append(y.alias(name))
    return out, helpers


def decayed_sums(df: DataFrame, specs: list[tuple[str, Column, float]], by: list[str],
                 block: int = BLOCK) -> DataFrame:
    """``y_t = r * y_{t-1} + b_t`` (``y_{-1} = 0``, NULL ``b`` counts as 0) for
    every ``(name, b, r)`` in ``specs``, all in the same window passes.

    Block scan, native windows only:

    1. inside a block of ``block`` rows: ``u_t = r^off * sum_{j<=t} b_j r^-off_j``
       (partition ``(by, _blk)``, running sum);
    2. block ends ``e_k = u`` at ``off = block-1``; the value carried into block
       k is the fold ``Y = R Y + e`` over all earlier block ends, ``R =
       r^block`` (one value per block, so bars / block per series): no block is
       left out, however long ago, so ratios of two decayed sums stay right
       when both have decayed far;
    3. ``y_t = u_t + r^(off+1) * Y_{k-1}``.

    ``df`` must come from :func:`number_rows` with the same ``block``.
    """
    df = df.select("*", *scan_inputs(specs, by))
    carries = scan_carries(specs, by, block)
    if carries:
        df = df.select("*", *carries)
    out, helpers = scan_results(specs, block)
    return df.select("*", *out).drop(*helpers)


def block_running(x: Column, by: list[str], name: str) -> list[Column]:
    """Rolling-sum phase 1: in-block running sum and non-null count of ``x``."""
    return [F.sum(F.coalesce(x, F.lit(0.0))).over(_in_block(by)).alias(f"_cs_{name}"),
            F.count(x).over(_in_block(by)).alias(f"_cc_{name}")]


def block_previous_totals(name: str, by: list[str], block: int = BLOCK) -> list[Column]:
    """Rolling-sum phase 2: totals of the previous block."""
    off = F.col("_off")
    return [F.last(F.when(off == block - 1, F.col(f"_{k}_{name}")), ignorenulls=True)
            .over(_block_back(by, 1)).alias(f"_{k}p_{name}") for k in ("cs", "cc")]


def block_lags(name: str, by: list[str], length: int) -> list[Column]:
    """Rolling-sum phase 2': running values ``length`` rows back."""
    return [F.lag(F.col(f"_{k}_{name}"), length).over(ordered(by)).alias(f"_{k}l{length}_{name}")
            for k in ("cs", "cc")]


def window_total(name: str, length: int, kind: str = "cs") -> Column:
    """Rolling-sum phase 3: sum (``cs``) or count (``cc``) of the last ``length`` rows."""
    off, rn = F.col("_off"), F.col("rn")
    cur, lagged, prev = (F.col(f"_{kind}_{name}"), F.col(f"_{kind}l{length}_{name}"),
                         F.col(f"_{kind}p_{name}"))
    return (F.when(rn < length, cur).when(off >= length, cur - lagged)
            .otherwise(cur + prev - lagged))


def rolling_sums(df: DataFrame, specs: list[tuple[str, Column, int]], by: list[str],
                 block: int = BLOCK) -> DataFrame:
    """Rolling sum and non-null count over the last ``L`` rows (``L <= block``) for
    every ``(name, x, L)``: adds ``<name>_sum`` and ``<name>_n``.

    Spark re-aggregates a sliding row frame for every row (O(L) per row).  Here
    the window sum is a difference of running sums *inside a block*, plus the
    previous block's total when the window straddles a block edge — O(1) per
    row, and the rounding error is that of a sum of at most ``2*block`` terms
    (counts are exact)."""
    if any(length > block for _n, _x, length in specs):
        raise ValueError("rolling length must not exceed the block size")
    df = df.select("*", *[c for name, x, _l in specs for c in block_running(x, by, name)])
    df = df.select("*", *[c for name, _x, length in specs
                          for c in (*block_lags(name, by, length), *block_previous_totals(name, by, block))])
    out = [window_total(name, length, kind).alias(f"{name}_{suffix}")
           for name, _x, length in specs for kind, suffix in (("cs", "sum"), ("cc", "n"))]
    drop = [f"_{kind}{part}_{name}" for name, _x, length in specs
            for kind in ("cs", "cc") for part in ("", f"l{length}", "p")]
    return df.select("*", *out).drop(*drop)


def rolling_means(df: DataFrame, specs: list[tuple[str, Column, int]], by: list[str],
                  block: int = BLOCK) -> DataFrame:
    """W5 for several ``(name, x, L)`` at once: full-window means via
    :func:`rolling_sums` (windows longer than a block use a direct frame)."""
    fast = [(n, x, length) for n, x, length in specs if length <= block]
    slow = [(n, x, length) for n, x, length in specs if length > block]
    if fast:
        df = rolling_sums(df, [(f"_rm_{n}", x, length) for n, x, length in fast], by, block)
    out = [F.when(F.col(f"_rm_{n}_n") == length, F.col(f"_rm_{n}_sum") / F.lit(float(length))).alias(n)
           for n, _x, length in fast]
    out += [sma(x, by, length).alias(n) for n, x, length in slow]
    drop = [c for n, _x, _l in fast for c in (f"_rm_{n}_sum", f"_rm_{n}_n")]
    return df.select("*", *out).drop(*drop)


def seeded_average_terms(x: Column, by: list[str], length: int, alpha: float,
                         seen_before: Column | None = None, sum_before: Column | None = None) -> tuple[Column, Column]:
    """Input ``b`` and validity for a seeded exponential average.

    Contract: NULL until ``length`` non-null inputs have been seen; at that row
    the value is their mean; afterwards ``y = alpha*x + (1-alpha)*y_prev``.
    ``seen_before`` and ``sum_before``: count and sum of the non-null inputs that
    precede the rows of ``by``, where these are one segment of a series.
    Returns ``(b, valid)`` for :func:`decayed_sums` with ``r = 1 - alpha``."""
    cw = cumulative(by)
    seen, total = F.count(x).over(cw), F.sum(x).over(cw)
    if seen_before is not None:
        seen, total = seen + seen_before, total + sum_before
    b = (F.when((seen == length) & x.isNotNull(), total / F.lit(float(length)))
         .when(seen > length, F.lit(alpha) * x)
         .otherwise(F.lit(0.0)))
    return b, seen >= length


def wilder_terms(x: Column, by: list[str]) -> tuple[Column, Column, Column]:
    """Numerator/denominator inputs of the ``adjust=True`` Wilder average.

    ``y_t = sum r^(t-j) x_j / sum r^(t-j)`` over non-null ``x_j``; NULL inputs
    leave the average unchanged but still age the older inputs.  Returns
    ``(b_num, b_den, n_seen)``."""
    return (F.coalesce(x, F.lit(0.0)), F.when(x.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)),
            F.count(x).over(cumulative(by)))


# --------------------------------------------------------------------------- W1/W2
def latest_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the greatest row per key under ``order`` (a total order).

    Expressed as ``groupBy(keys).agg(max_by(struct(row), struct(order)))`` so the
    selection is combined map-side: a key holding a third of all rows is
    reduced on every mapper before the shuffle instead of being sorted in one
    task."""
    payload = [x for x in df.columns]
    row = F.struct(*[F.col(x) for x in payload])
    best = F.max_by(row, F.struct(*order)).alias("_best")
    return df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(best).select("_best.*")


def desc_nulls_last_key(x: Column) -> list[Column]:
    """Sort key components that, under ``max``, give ``x DESC NULLS LAST``."""
    return [x.isNotNull(), x]
