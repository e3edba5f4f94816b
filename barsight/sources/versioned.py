"""Snapshot tables on plain Parquet.

A table is a folder of ``v=NNNNNN`` snapshots; the newest snapshot holding a
``_SUCCESS`` marker is current.  A new version is always written to a new
folder, so a MERGE never overwrites the files it is reading, and a failed or
retried write never becomes visible.  Works on any Hadoop file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def current_path(spark: SparkSession, root: str) -> str | None:
    v = versions(spark, root)
    return f"{root.rstrip('/')}/v={v[-1]:06d}" if v else None


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame:
    path = current_path(spark, root)
    if path is None:
        if schema is None:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def write_next(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version and return its path."""
    spark = df.sparkSession
    v = versions(spark, root)
    nxt = (v[-1] + 1) if v else 1
    path = f"{root.rstrip('/')}/v={nxt:06d}"
    df.write.mode("overwrite").parquet(path)
    return path
