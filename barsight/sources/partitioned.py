"""Tables laid out in one folder per partition value, on plain Parquet.

``read`` prunes to the values asked for (the scan lists no other folder);
``overwrite`` replaces only the folders of the values that its rows hold
(dynamic partition overwrite, set on the write, not on the session).  Rows are
rebalanced by the partition value, so that a folder gets few files while a value
with a large share of the rows is still written by several tasks.

The values of a batch reach the driver: one for each folder touched, so their
number is bounded by the table's layout (quarters here), not by its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def in_values(by: str, values: list) -> Column:
    """``by`` is one of ``values``; None stands for rows without a value."""
    some = [v for v in values if v is not None]
    hit = F.col(by).isin(some) if some else F.lit(False)
    return hit | F.col(by).isNull() if None in values else hit


def touched(df: DataFrame, by: str) -> list:
    """The distinct partition values of ``df``."""
    return [r[0] for r in df.select(by).distinct().collect()]


def overwrite(df: DataFrame, root: str, by: str) -> None:
    """Replace the folders of the values that ``df`` holds; others stay as they are."""
    (df.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(root))


def read(spark: SparkSession, root: str, schema: StructType, by: str, values: list | None = None) -> DataFrame:
    """The table with the columns of ``schema``, or only the folders of ``values``.
    A table that does not exist yet is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(root)
    if values is not None:
        table = table.where(in_values(by, values))
    return table.select(*schema.names)
