"""Structured Streaming entry points.

Each stream reads a folder of JSON files, so a producer (discovery, an
upstream service) appends files and the consumer picks them up.  Sinks are
``foreachBatch`` appends of Parquet/JSON with a checkpoint: a replayed
micro-batch rewrites the same batch folder (idempotent), and the staging
table is de-duplicated again by W1 at merge time (X3).

``trigger(availableNow=True)`` + ``awaitTermination`` replaces the reference's
fixed one-hour wait before the merge (X4); ``max_files_per_trigger`` is the
throttle that replaces the publisher's 10 messages/s (K4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barsight.operators.history import distinct_requests, pruned_bars
from barsight.plans.scoring import service_rows
from barsight.sources.messages import decode_messages, load_counts, split_valid

REQUEST_SCHEMA = "ticker STRING, date STRING"
ENVELOPE_SCHEMA = "envelope_id BIGINT, body STRING"


def _reader(spark: SparkSession, path: str, schema: str, max_files: int | None):
    r = spark.readStream.schema(schema).option("multiLine", False)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def start_feature_stream(spark: SparkSession, prices: DataFrame, requests_dir: str, out_dir: str,
                         checkpoint: str, limit: int = 300, min_bars: int = 50,
                         max_files_per_trigger: int | None = None, available_now: bool = True):
    """Request files -> validate (P9) -> as-of history (S2) -> features by
    (ticker, target_date) (I31) -> last row (P14) -> JSON rows (K5).

    The per-request warehouse query of the reference becomes one plan per
    micro-batch, over the bars of the tickers and up to the newest date that the
    batch asks for; invalid requests, also ones whose date is none, are dropped
    (acknowledged).  Missing values are written as JSON nulls."""
    stream = _reader(spark, requests_dir, REQUEST_SCHEMA, max_files_per_trigger)

    def handle(batch: DataFrame, batch_id: int) -> None:
        reqs = batch.select("ticker", F.col("date").try_cast("date").alias("date"))
        rows = service_rows(pruned_bars(prices, distinct_requests(reqs)), reqs, limit, min_bars)
        rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")) \
            .write.mode("overwrite").text(f"{out_dir}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_load_stream(spark: SparkSession, envelopes_dir: str, staging_dir: str, rejects_dir: str,
                      checkpoint: str, row_schema: StructType, required,
                      max_files_per_trigger: int | None = None, available_now: bool = True):
    """Envelope files -> decode (S5) -> validate (P7/P8) -> append valid rows
    to staging (K1) and rejects with their reason; per-batch counts (A9) go to
    ``<staging_dir>/_counts``."""
    stream = _reader(spark, envelopes_dir, ENVELOPE_SCHEMA, max_files_per_trigger)

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch, row_schema).persist()
        valid, rejects = split_valid(decoded, required)
        valid.drop("envelope_id", "pos").write.mode("overwrite").parquet(f"{staging_dir}/batch={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch_id}")
        load_counts(decoded, required).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(f"{staging_dir}/_counts/batch={batch_id}")
        decoded.unpersist()

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def publish_json(df: DataFrame, folder: str, files: int | None = None) -> None:
    """K3: emit work items / requests as JSON files for a stream to consume."""
    out = df.repartition(files) if files else df
    out.write.mode("append").json(folder)
