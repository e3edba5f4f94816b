"""Helpers shared by the operators: tables, written cuts, size-checked joins,
distributed numbering, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.session import ensure_checkpoint_dir, free_shuffles

#: A side of at most so many rows (of at most a few dozen bytes each) is
#: broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


#: Rows of an Arrow batch; Spark's default of 10,000 whole texts is held twice,
#: in the JVM's buffers and in the Python worker, for each running task.
ARROW_ROWS = 500


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session asks for a size of its own; and
    shuffle files go when their query has ended, not when the driver's memory fills."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))
    free_shuffles(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Folders of the cuts made inside the innermost :func:`passing`.
_MADE: ContextVar[list[str] | None] = ContextVar("cuts made", default=None)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Lineage ends there: a lost executor costs a re-read of a shared file."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    if _MADE.get() is not None:
        _MADE.get().append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def dropped(*cuts: DataFrame) -> None:
    """Delete the files of ``cuts``, frames that :func:`cut` returned, once no frame
    still to be computed reads them."""
    for df in cuts:
        _delete(df.sparkSession, [df.cut_path])


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Files of the cuts made inside go at its end, except of those passed to what it
    gives: the cuts that later frames read."""
    outer, made, kept = _MADE.get(), [], []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.cut_path)
        return df

    token = _MADE.set(made)
    try:
        yield keep
    finally:
        _MADE.reset(token)
        _delete(spark, [p for p in made if p not in kept])
        if outer is not None:
            outer += kept


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column."""
    used = {c.lower() for f in frames for c in f.columns}
    while name.lower() in used:
        name = "_" + name
    return name


def small_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a written table: broadcast it only if its row count is at most
    ``rows``; otherwise both sides are shuffled (AQE splits skewed keys)."""
    if small.limit(rows + 1).count() <= rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def held_out(doc_id: Column) -> Column:
    """Fold 0 of five by crc32 of the id as text (null ids: never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def same_fields(df: DataFrame, *more: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *more])


def global_index(df: DataFrame, order: list[Column], name: str,
                 partitions: int | None = None) -> DataFrame:
    """Number rows 0, 1, ... in ``order`` without a one-partition sort.

    Rows are range-partitioned and written once with their place inside the
    partition; only one count per partition reaches the driver.  The order must
    be total up to rows that are alike in every column."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid, local = fresh(f"{name}_part", df), fresh(f"{name}_local", df)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(local, F.monotonically_increasing_id()))
    ranged = cut(ranged.withColumn(pid, F.shiftright(F.col(local), 33).cast("int"))
                 .withColumn(local, F.col(local).bitwiseAND(F.lit((1 << 33) - 1))))
    offsets, total = [], 0
    for p, c in sorted((r[0], r[1]) for r in ranged.groupBy(pid).count().collect()):
        offsets += [F.lit(p), F.lit(total).cast("long")]
        total += c
    if not offsets:
        return ranged.withColumn(name, F.lit(0).cast("long")).drop(pid, local)
    start = F.create_map(*offsets)
    return ranged.withColumn(name, start[F.col(pid)] + F.col(local)).drop(pid, local)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node on an edge; component = smallest node.

    Each round takes the smallest label among neighbours, then follows the
    label's own label (pointer jumping), until nothing changes."""
    both = cut(edges.select(F.col(a).alias("node"), F.col(b).alias("near"))
               .unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("near")))
               .where("node <> near").distinct())
    labels = cut(both.groupBy("node").agg(F.least("node", F.min("near")).alias("component")))
    while True:
        near = labels.select(F.col("node").alias("near"), F.col("component").alias("c2"))
        best = (both.join(near, "near").groupBy("node").agg(F.min("c2").alias("c3")))
        step = labels.join(best, "node", "left").select(
            "node", F.col("component").alias("before"), F.least("component", "c3").alias("c4"))
        step = cut(step)
        jump = step.select(F.col("node").alias("c4"), F.col("c4").alias("c5"))
        moved = cut(step.join(jump, "c4", "left").select(
            "node", "before", F.least("c4", "c5").alias("component")))
        if moved.where("component <> before").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")
