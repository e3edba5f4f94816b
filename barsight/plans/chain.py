"""The ingestion chain: load stream -> staging batches -> gates -> MERGE into a
partitioned table -> late backfill, with a ledger of merged batches.

``start_load_stream`` (K1) writes one folder ``batch=N`` for each micro-batch.
``merge_batches`` takes the batches that are complete (``_SUCCESS``) and not yet
in the ledger, runs the gates of M4 on them, merges them by partition (M1), and
then writes their numbers to the ledger.  A replayed micro-batch rewrites its own
folder and is found in the ledger, so it is merged once.  If the job dies between
the table write and the ledger, the next run merges the same rows again, to the
same table (the MERGE sets rows, it does not add to them).  Staging is truncated
only by folders that the ledger names (M3), so a batch that arrives meanwhile is
never lost.

Counts (A9) are observed while the table is written: the plan runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barsight.functions.columns import all_not_null
from barsight.operators.tables import (
    NULL_THRESHOLD_PCT, PRIMARY_KEYS, STRICT_NOT_NULL_COLUMNS, backfill_source, latest_per_key, plan_backfill,
    plan_merge, quality_report, schema_difference,
)
from barsight.sources import partitioned

PARTITION = "quarter_end_date"
LEDGER = "_merged"
ACTIONS = ("update", "insert", "skip", "keep")


def merge_partitions(spark: SparkSession, root: str, staging: DataFrame, schema: StructType, keys: list[str] | None = None,
                     strict: list[str] | None = None, by: str = PARTITION, tie: list[str] | None = None) -> dict:
    """M1 on a table partitioned by a key column: only the partitions that staging
    touches are read, joined and written.

    Returns the counts of actions (``keep``: rows of those partitions) and the
    number of partitions touched.  Rows without a partition value match nothing;
    they are inserted where ``strict`` lets them be."""
    keys = keys or PRIMARY_KEYS
    strict = STRICT_NOT_NULL_COLUMNS if strict is None else strict
    if by not in keys:
        raise ValueError(f"a row's partition must follow from its key: {by} is none of {keys}")
    source = latest_per_key(staging.select(*schema.names), keys, tie=tie)
    values = partitioned.touched(staging, by)
    if not values:
        return dict.fromkeys(ACTIONS, 0) | {"partitions": 0}
    plan = plan_merge(partitioned.read(spark, root, schema, by, values), source, keys, all_not_null(strict))
    seen = Observation("merge")
    plan = plan.observe(seen, *[F.count_if(F.col("_action") == a).alias(a) for a in ACTIONS])
    partitioned.overwrite(plan.where("_action <> 'skip'").drop("_action"), root, by)
    return {a: seen.get[a] for a in ACTIONS} | {"partitions": len(values)}


def backfill_partitions(spark: SparkSession, root: str, schema: StructType, prices: DataFrame, as_of=None,
                        mode: str = "as_coded", days: int = 30, by: str = PARTITION) -> dict:
    """M2/M2b on a partitioned table: three columns of all partitions are read to
    find the rows that can be filled in; only their partitions are rewritten."""
    found = backfill_source(partitioned.read(spark, root, schema, by), prices, as_of, mode, days)
    values = partitioned.touched(found, by)
    if not values:
        return {"updated": 0, "partitions": 0}
    plan = plan_backfill(partitioned.read(spark, root, schema, by, values), found)
    seen = Observation("backfill")
    plan = plan.observe(seen, F.count_if("_updated").alias("updated"))
    partitioned.overwrite(plan.drop("_updated"), root, by)
    return {"updated": seen.get["updated"], "partitions": len(values)}


# ------------------------------------------------------------------- batches
def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def loaded_batches(spark: SparkSession, staging_dir: str) -> list[int]:
    """Numbers of the batch folders whose write is complete."""
    fs, p = _folder(spark, staging_dir)
    if not fs.exists(p):
        return []
    names = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("batch=")]
    done = [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
    return sorted(int(n.getName().removeprefix("batch=")) for n in done)


def merged_batches(spark: SparkSession, staging_dir: str) -> set[int]:
    """Numbers in the ledger."""
    fs, p = _folder(spark, f"{staging_dir}/{LEDGER}")
    return {int(s.getPath().getName()) for s in fs.listStatus(p)} if fs.exists(p) else set()


def _note(spark: SparkSession, staging_dir: str, batches: list[int]) -> None:
    fs, p = _folder(spark, f"{staging_dir}/{LEDGER}")
    fs.mkdirs(p)
    for n in batches:
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(p, str(n)), True).close()


def merge_batches(spark: SparkSession, staging_dir: str, root: str, schema: StructType, keys: list[str] | None = None,
                  strict: list[str] | None = None, soft: list[str] | None = None, gate: bool = True,
                  threshold: float = NULL_THRESHOLD_PCT, truncate: bool = False, by: str = PARTITION) -> dict:
    """M4 over the batches that are loaded and not yet merged: profile (A3), empty
    check, schema check (U3), MERGE (M1), ledger, truncation (M3)."""
    merged = merged_batches(spark, staging_dir)
    pending = [n for n in loaded_batches(spark, staging_dir) if n not in merged]
    out: dict = {"batches": pending}
    if not pending:
        return out | {"status": "empty_staging"}
    staging = spark.read.parquet(*[f"{staging_dir}/batch={n}" for n in pending])
    report = quality_report(staging, strict, soft, threshold).collect()      # one row for each checked column
    if gate and any(r["level"] == "abort" for r in report):
        return out | {"status": "aborted_strict_nulls"}
    if staging.isEmpty():
        out["status"] = "empty_staging"
    else:
        extra, absent = schema_difference(staging, spark.createDataFrame([], schema))
        if extra or absent:
            return out | {"status": "schema_mismatch"}
        out |= {"status": "merged", "counts": merge_partitions(spark, root, staging, schema, keys, strict, by)}
    _note(spark, staging_dir, pending)
    if truncate:
        fs, _ = _folder(spark, staging_dir)
        for n in sorted(merged_batches(spark, staging_dir)):
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_dir}/batch={n}")
            if fs.exists(path):
                fs.delete(path, True)
    return out


def run_chain(spark: SparkSession, envelopes_dir: str, staging_dir: str, rejects_dir: str, checkpoint: str, root: str,
              schema: StructType, required, max_files_per_trigger: int | None = None, **merge) -> dict:
    """X2 -> X4 -> M4: load all envelopes that are there, wait until they are
    staged, then merge."""
    from barsight.streaming.pipelines import start_load_stream

    start_load_stream(spark, envelopes_dir, staging_dir, rejects_dir, checkpoint, schema, required,
                      max_files_per_trigger).awaitTermination()
    return merge_batches(spark, staging_dir, root, schema, **merge)
