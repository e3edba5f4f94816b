"""Feature-table maintenance: the merge gate sequence (M4), discovery (J2 ->
K3) and the late backfill (M2) as driver functions over DataFrames."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsight.operators.tables import (
    NULL_THRESHOLD_PCT, backfill_source, existing_keys, merge_counts, merge_snapshot,
    merge_upsert, missing_work, plan_backfill, post_merge_profile, quality_report,
    schema_difference, work_items,
)
from barsight.sources import versioned

log = logging.getLogger(__name__)


def run_merge(final: DataFrame, staging: DataFrame, keys: list[str] | None = None,
              strict: list[str] | None = None, soft: list[str] | None = None, gate: bool = True,
              threshold: float = NULL_THRESHOLD_PCT) -> tuple[str, DataFrame]:
    """M4: profile (A3) -> empty check -> schema check (U3) -> MERGE (M1).

    Returns ``(status, next snapshot)``; on any stop the snapshot is ``final``
    unchanged.  The profile is one aggregate; only its per-column summary
    (one row per checked column) reaches the driver."""
    report = quality_report(staging, strict, soft, threshold).collect()
    row_count = report[0]["row_count"] if report else staging.count()
    for r in report:
        log.info("null profile: %s", r.asDict())
    if gate and any(r["level"] == "abort" for r in report):
        bad = [r["column_name"] for r in report if r["level"] == "abort"]
        log.error("nulls in strict columns %s; merge aborted", bad)
        return "aborted_strict_nulls", final
    if row_count == 0:
        return "empty_staging", final
    only_staging, only_final = schema_difference(staging, final)
    if only_staging or only_final:
        log.error("schema mismatch: staging extra %s, final extra %s", only_staging, only_final)
        return "schema_mismatch", final
    plan = merge_upsert(final, staging, keys, strict)
    return "merged", merge_snapshot(plan)


def merge_tables(spark, final_root: str, staging_root: str, truncate_staging: bool = False,
                 **kwargs) -> dict:
    """M4 + M3 over snapshot tables: the merged snapshot is committed as a new
    version first; only then is staging truncated (an empty new version)."""
    final = versioned.read_current(spark, final_root)
    staging = versioned.read_current(spark, staging_root)
    status, snapshot = run_merge(final, staging, **kwargs)
    out = {"status": status}
    if status == "merged":
        counts = merge_counts(merge_upsert(final, staging, kwargs.get("keys"), kwargs.get("strict")))
        out["counts"] = counts.first().asDict()
        out["path"] = versioned.write_next(snapshot, final_root)
        merged = spark.read.parquet(out["path"])
        out["post_profile"] = post_merge_profile(merged, kwargs.get("soft")).first().asDict()
        if truncate_staging:
            versioned.write_next(spark.createDataFrame([], staging.schema), staging_root)
            out["staging_truncated"] = True
    return out


def discover(features: DataFrame, listing: DataFrame, base_uri: str,
             suffix: str = ".txt", key_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Discovery (S3 -> S4 -> J2 -> P12 -> P13): (work items, unparsable keys)."""
    items = work_items(missing_work(listing, existing_keys(features, key_cols), suffix), base_uri)
    return items.where("ok").drop("ok"), items.where(~F.col("ok")).select("key", "summary_path")


def backfill(features: DataFrame, prices: DataFrame, as_of=None, mode: str = "as_coded",
             days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, number of updated rows as a one-row frame)."""
    plan = plan_backfill(features, backfill_source(features, prices, as_of, mode, days))
    return plan.drop("_updated"), plan.agg(F.count_if("_updated").alias("updated"))


__all__ = ["run_merge", "merge_tables", "discover", "backfill", "merge_counts", "merge_snapshot"]
