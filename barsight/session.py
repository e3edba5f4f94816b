"""Session helpers.

Library code never creates a session; it receives one.  ``build_session`` is
for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# With some hundred aliased columns under a completeness filter over 32 of them,
# Catalyst's constraint inference grows combinatorially and can stall planning for
# minutes; the feature plans have no join that it would serve.  No operator sets
# this: it is for whoever owns the session to choose.
PLANNER_CONF = {"spark.sql.constraintPropagation.enabled": "false"}

DEFAULT_CONF = {
    **PLANNER_CONF,
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "barsight", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set on a session of the caller's own what the feature plans are best planned with."""
    for k, v in PLANNER_CONF.items():
        spark.conf.set(k, v)
    free_shuffles(spark)
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when their query has ended, not when the driver collects its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always respected.
    Only when it is unset (local tests, the bench) is a scratch folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name shared storage on a cluster")
        configured = tempfile.mkdtemp(prefix="barsight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
