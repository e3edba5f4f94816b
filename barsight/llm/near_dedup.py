"""MinHash near-duplicate detection by Fast Similarity Sketching.

Method: a document's set (distinct 5-word shingles) fills a sketch of
``BINS`` coordinates in rounds.  In round i < BINS every element is thrown into
a hashed bin; in round BINS + b every element goes to bin b, so each coordinate
is sure to fill.  A coordinate holds the smallest value of the first round that
reached it, hence two sets agree in it with probability J, and the agreement is
concentrated as for independent hashes.  Coordinates are banded; documents in
one bucket are candidates and are confirmed on their full sets.

No bucket emits all its pairs.  Documents with equal sets (equal sha256 of the
whole sorted set) are one node.  Buckets become links by :mod:`settle`: each
compares its members with its smallest doc_id, and what is then left in more than
one component in pairs or in tiles, which return spanning forests.  So no pair
that shares a bucket and could join two components stays unchecked: no cap, no
lost candidate.

Defined cases: null or empty text, or text of white space: empty set, linked
with nothing.  1 to 4 words: the sequence is the one shingle.  Rows that share a
doc_id are one document, linked if any of their texts is.  A null doc_id stays
alone (component_id null, kept).  An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.llm.common import cut, fresh, passing, read, small_join
from barsight.llm.settle import settle, with_copies
from barsight.llm.textarrays import U, list_column, mix, seeds, shingles, text_chunks, word_hashes

BINS = 128
ROWS = 4
#: A pair of similarity 0.75 shares none of the 32 bands with probability 5e-6.
BANDS = BINS // ROWS
THRESHOLD = 75

_ROUND = seeds(2 * BINS, 51)
_BAND = seeds(BANDS, 53)
_COL = seeds(ROWS, 57) | U(1)
_BITS = BINS.bit_length() - 1


def distinct_sets(data, offs, n: int):
    """(elements, sizes): the sorted distinct shingles of each of n texts."""
    words, _, _, text = word_hashes(data, offs)
    found, _, where = shingles(words, text)
    cuts = np.searchsorted(where, np.arange(n + 1))
    parts = [np.unique(found[cuts[i]:cuts[i + 1]]) for i in range(n)]
    return (np.concatenate(parts) if parts else np.zeros(0, U),
            np.array([len(p) for p in parts], np.int64))


def sketch(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of BINS coordinates for each set; empty sets stay unfilled."""
    n = len(sizes)
    none = U(0xFFFFFFFFFFFFFFFF)
    flat = np.full(n * BINS, none, U)
    owner = np.repeat(np.arange(n), sizes)
    for i in range(2 * BINS):
        if not len(elements):
            break
        h = mix(elements ^ _ROUND[i])
        bins = (h >> U(64 - _BITS)).astype(np.int64) if i < BINS else np.full(len(h), i - BINS)
        at = owner * BINS + bins
        empty = flat[at] == none
        now = np.full(len(flat), none, U) if i == 0 else None
        if now is not None:
            np.minimum.at(now, at, h)
            flat = now
        else:
            spots, values = at[empty], h[empty]
            order = np.lexsort((values, spots))
            spots, values = spots[order], values[order]
            head = np.flatnonzero(np.r_[True, spots[1:] != spots[:-1]]) if len(spots) else []
            flat[spots[head]] = values[head]
        open_sets = (flat.reshape(n, BINS) == none).any(axis=1)
        live = open_sets[owner]
        elements, owner = elements[live], owner[live]
    return flat.reshape(n, BINS)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    parts = mix(sketches.copy()).reshape(len(sketches), BANDS, ROWS) * _COL
    return mix(parts.sum(axis=2, dtype=U) ^ _BAND).view(np.int64)


def _sketches(batches):
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offs in text_chunks(batch.column(1)):
            elements, sizes = distinct_sets(data, offs, hi - lo)
            keys = band_keys(sketch(elements, sizes))
            ends = np.r_[0, np.cumsum(sizes)].tolist()
            view = memoryview(elements).cast("B") if len(elements) else memoryview(b"")
            digests = [sha256(view[8 * x:8 * y]).digest() for x, y in zip(ends[:-1], ends[1:])]
            bands = list_column(keys[sizes > 0].ravel(), np.where(sizes > 0, BANDS, 0), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(digests, pa.binary()), bands], names=["doc_id", "n", "digest", "bands"])


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``
    (columns doc_id, text; further columns are not looked at)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(texts.mapInArrow(_sketches, "doc_id long, n long, digest binary, bands array<long>"))
    found = rows.where("n > 0 and doc_id is not null")

    classes = cut(found.groupBy("digest").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last"))
                  .where("a < last").drop("last"))
    same = cut(small_join(found.select("doc_id", "digest"), classes, "digest").where("doc_id <> a").distinct())
    nodes = small_join(found.select("doc_id", "n", "digest", "bands"), same.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")
    spread = nodes.select(F.explode(F.array_distinct("bands")).alias("bucket"), "doc_id", "n")
    joined = settle(texts, spread, distinct_sets, THRESHOLD)
    label = with_copies(joined, same.select("doc_id", "a"), found.select("doc_id", "digest").distinct())

    out = small_join(rows.select("doc_id", F.col("n").alias("n_shingles")), label, "doc_id", "left")
    return (out.withColumn("component_id", F.coalesce("component", "doc_id")).drop("component")
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without the near-duplicates of a smaller doc_id, and one
    row of those that share a doc_id; all columns stay."""
    with passing(docs.sparkSession) as keep:
        linked = cut(link_documents(docs.select("doc_id", "text")))
        drop = keep(cut(linked.where(~F.col("kept")).select("doc_id").distinct()))
        twice = keep(cut(linked.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")))
    key = fresh("doc_key", docs)
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    out = small_join(keyed, drop.withColumnRenamed("doc_id", key), key, "left_anti")
    if not twice.isEmpty():
        twice = twice.withColumnRenamed("doc_id", key)
        once = small_join(out, twice, key, "left_semi").dropDuplicates([key])
        out = small_join(out, twice, key, "left_anti").unionByName(once)
    return out.select(*docs.columns)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"))
