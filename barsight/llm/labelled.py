"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsight.llm.common import cut, held_out


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limits: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of at most ``limits[value]`` labelled rows per label value,
    the smallest by hash of the id, fold 0 left out; and how many labelled rows
    each value has in all.  The ids of the sample (bounded by ``limits``) are
    broadcast; a doc_id labelled twice has its largest label."""
    known = (labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(*limits))
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")))
    known = cut(known.groupBy("doc_id").agg(F.max("label").alias("label")))
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    picks = None
    for value, most in limits.items():
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picks = part if picks is None else picks.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picks), "doc_id").select("text", "label"), totals
