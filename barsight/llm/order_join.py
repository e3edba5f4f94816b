"""Exact Jaccard join of word n-gram sets by multiple-global-order filtering.

Sort each set's elements by a global order.  Two sets of Jaccard similarity of at
least ``PERCENT`` % share an element of their prefixes (the first n - need + 1, need
= the elements a partner must share), under every global order.  So a candidate
pair has to pass several orders, and only what passes all is verified:

* order 1, by hash: prefixes that are longer by ``least(need)`` - 1 elements, of
  which linked sets share at least ``least`` (a share of the prefix, not one
  element).  Whoever has fewer prefix elements that any other document's prefix
  holds is out at once; a passage or line shared by many keeps nobody in.
* order 2, by the number of documents (rarest first, counted over all that are
  left): elements of one document come first and match nobody; the elements of
  the prefix that others hold too are the buckets of candidates.
* order 3, by another hash: prefixes have to meet.

Orders 1 and 3 are looked at together, set against set, before the intersection
of the whole sets decides (a tile of a large bucket counts intersections
outright).  Documents with equal sets (equal sha256 of the sorted elements) are
one node.  Buckets become links by :mod:`settle`: no bucket emits all its pairs,
none is cut.

The filters lose nothing, so the result is exact (elements are 64-bit hashes of
shingles).

Defined cases: null, empty or white texts: empty set, linked with nothing.  1 to
3 words: the sequence is the one element.  Rows that share a doc_id are one
document, linked if any of their texts is.  A null doc_id stays alone
(component_id null).  An empty table gives an empty result; further columns are
not looked at.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.llm.common import cut, read, small_join
from barsight.llm.settle import set_maker, settle, with_copies
from barsight.llm.textarrays import U, list_column, mix, seeds, shingles, text_chunks, word_hashes

WORDS = 4
PERCENT = 85
#: Order 1: one element in so many has to be shared by the prefixes.
PART = 20

_THIRD = seeds(1, 307)[0]


def word_sets(data, offs, n: int):
    """(elements, sizes): the sorted distinct shingles of each of n texts."""
    words, _, _, text = word_hashes(data, offs)
    found, _, where = shingles(words, text, WORDS)
    cuts = np.searchsorted(where, np.arange(n + 1))
    parts = [np.unique(found[cuts[i]:cuts[i + 1]]) for i in range(n)]
    return (np.concatenate(parts) if parts else np.zeros(0, U), np.array([len(p) for p in parts], np.int64))


def need(n):
    """Elements that a set of n shares with any linked set at least."""
    return -(-PERCENT * n // 100)


def least(n):
    """Elements that the order-1 prefix of a set of n and of any linked set share."""
    return np.maximum(1, need(n) // PART)


def first_prefix(n):
    """Length of the order-1 prefix of a set of n."""
    return n - need(n) + least(n)


def admits(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets (sorted elements) pass orders 1 and 3."""
    x, y = x.view(U), y.view(U)
    a, b = x[:first_prefix(len(x))], y[:first_prefix(len(y))]
    both = np.sort(np.concatenate([a, b]))
    if np.count_nonzero(both[1:] == both[:-1]) < min(least(len(x)), least(len(y))):
        return False
    heads = []
    for s in (x, y):
        keys, k = mix(s ^ _THIRD), len(s) - need(len(s)) + 1
        heads.append(np.partition(keys, k - 1)[:k] if k < len(keys) else keys)
    return bool(np.isin(heads[0], heads[1], assume_unique=True).any())


def _firsts(batches):
    """(doc_id, n, digest of the set, least partner share, order-1 prefix)."""
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offs in text_chunks(batch.column(1)):
            elements, sizes = word_sets(data, offs, hi - lo)
            edge = np.r_[0, np.cumsum(sizes)]
            view = memoryview(elements).cast("B") if len(elements) else memoryview(b"")
            digests = [sha256(view[8 * a:8 * b]).digest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            length = np.where(sizes > 0, first_prefix(sizes), 0)
            inside = np.arange(len(elements)) - np.repeat(edge[:-1], sizes) < np.repeat(length, sizes)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(least(need(sizes)), pa.int64()),
                 list_column(elements[inside].view(np.int64), length, pa.int64())],
                names=["doc_id", "n", "digest", "least", "prefix"])


def shared_elements(rows: DataFrame) -> DataFrame:
    """Those of ``rows`` (e, doc_id, ...) whose e several documents hold, with
    that number as ``df``.  Both sides lie by e: one shuffle, and a frequent e can
    be split by the join."""
    several = rows.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return rows.join(several, "e")


def join_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(texts.mapInArrow(_firsts, "doc_id long, n long, digest binary, least long, prefix array<long>"))
    found = rows.where("n > 0 and doc_id is not null")
    classes = cut(found.groupBy("digest").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").drop("last"))
    same = cut(small_join(found.select("doc_id", "digest"), classes, "digest").where("doc_id <> a").distinct())
    nodes = small_join(found, same.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")

    first = nodes.select("doc_id", "least", F.explode("prefix").alias("e"))
    alive = cut(shared_elements(first).groupBy("doc_id").agg(F.count(F.lit(1)).alias("held"), F.min("least").alias("least"))
                .where("held >= least").select("doc_id"))
    sets = cut(small_join(texts, alive, "doc_id", "left_semi").mapInArrow(set_maker(word_sets), "doc_id long, elements array<long>"))
    sized = sets.select("doc_id", F.size("elements").cast("long").alias("n"), "elements")
    second = shared_elements(sized.select("doc_id", "n", F.explode("elements").alias("e")))
    open_ = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.size("held"))     # after the elements of its own
    members = (second.groupBy("doc_id", "n").agg(F.collect_list(F.struct("df", "e")).alias("held"))
               .withColumn("open", open_.cast("int")).where("open > 0")
               .select("doc_id", "n", F.explode(F.slice(F.array_sort("held"), F.lit(1), F.col("open"))).alias("x"))
               .select(F.col("x.e").alias("bucket"), "doc_id", "n"))
    joined = settle(texts, cut(members.distinct()), word_sets, PERCENT, admits)

    label = with_copies(joined, same.select("doc_id", "a"), found.select("doc_id", "digest").distinct())
    out = small_join(rows.select("doc_id", F.col("n").alias("n_shingles")), label, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(read(spark, sf_dir, "documents"))
