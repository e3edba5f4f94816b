"""From buckets of candidate documents to links, without all pairs of a bucket.

``settle`` takes (bucket, doc_id, n): documents that share a bucket are
candidates, n is the size of their sets.  It returns enough confirmed links that
their components are those of all linked candidates:

1. Every bucket compares its members with its smallest doc_id; members that are
   then in one component need no further check among themselves.
2. A bucket of at most ``SMALL`` members that still holds two components compares
   what is left of its pairs.
3. Larger ones are joined to clusters.  In a cluster, members outside the largest
   component meet the members of other components in tiles of about ``TILE_ITEMS``
   elements a side, unless the shingles that no other member has already rule
   every link out.  A tile returns component labels that it joins, at most one
   link fewer than it holds components, so links do not grow with its pairs.

No candidate pair that could join two components stays unchecked.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsight.llm.common import components, cut, small_join
from barsight.llm.textarrays import list_column, text_chunks

#: Members up to which a bucket pairs what its first comparison left.
SMALL = 8
#: Set elements on a tile's side, about.
TILE_ITEMS = 16_384

#: sets of n texts: (data, offs, n) -> (sorted elements, sizes)
Sets = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def set_maker(sets: Sets):
    """Arrow batches of (doc_id, text) to (doc_id, elements)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                elements, sizes = sets(data, offs, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), list_column(elements.view(np.int64), sizes, pa.int64())],
                    names=["doc_id", "elements"])

    return run


def sets_of(texts: DataFrame, ids: DataFrame, sets: Sets) -> DataFrame:
    """(doc_id, elements) of the documents in ``ids``, written."""
    return cut(small_join(texts, ids, "doc_id", "left_semi").mapInArrow(set_maker(sets), "doc_id long, elements array<long>"))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.values), np.asarray(column.offsets)


def linked(shared, x, y, percent: int):
    """Whether sets of sizes x and y with so many elements in common are linked."""
    return 100 * shared >= percent * (x + y - shared)


def _confirmer(percent: int, admits: Callable | None):
    def run(batches):
        for batch in batches:
            lv, lo = _lists(batch.column(2))
            rv, ro = _lists(batch.column(3))
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or admits and not admits(x, y):
                    continue
                both = np.concatenate([x, y])
                both.sort()
                ok[i] = linked(int(np.count_nonzero(both[1:] == both[:-1])), len(x), len(y), percent)
            kept = batch.select([0, 1]).filter(pa.array(ok))
            if kept.num_rows:
                yield kept

    return run


def confirm(texts: DataFrame, pairs: DataFrame, sets: Sets, percent: int, admits: Callable | None = None) -> DataFrame:
    """The pairs (a, b) of ``pairs`` that are linked on the full sets of ``texts``;
    ``admits`` (two sets of elements) may turn a pair away beforehand."""
    ids = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct())
    made = sets_of(texts, ids, sets)
    left = made.select(F.col("doc_id").alias("a"), F.col("elements").alias("left"))
    right = made.select(F.col("doc_id").alias("b"), F.col("elements").alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return cut(rows.mapInArrow(_confirmer(percent, admits), "a long, b long"))


def _side(column, i: int):
    """Component labels, elements and their edges of one side of tile i."""
    offs = np.asarray(column.offsets)
    entries = column.values.slice(int(offs[i]), int(offs[i + 1] - offs[i]))
    labels, lists = entries.field(0), entries.field(1)
    values, edges = _lists(lists)
    return np.asarray(labels), values[edges[0]:edges[-1]], edges - edges[0]


def tile_links(left, right, percent: int) -> list[tuple[int, int]]:
    """A forest over the component labels that linked members of two sides join."""
    (label_x, x, cut_x), (label_y, y, cut_y) = left, right
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            v = up
        return v

    names, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    near, far = place[:len(x)], place[len(x):]
    size_y, here = np.diff(cut_y), np.zeros(len(names), np.int64)
    out = []
    for i in range(len(label_x)):
        own = near[cut_x[i]:cut_x[i + 1]]
        here[own] = 1
        shared = np.add.reduceat(here[far], cut_y[:-1])
        here[own] = 0
        for j in np.flatnonzero(linked(shared, len(own), size_y, percent)).tolist():
            a, b = root(int(label_x[i])), root(int(label_y[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((min(a, b), max(a, b)))
    return out


def _tiler(percent: int):
    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                out += tile_links(_side(batch.column(0), i), _side(batch.column(1), i), percent)
            if out:
                a, b = zip(*set(out))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _cluster_links(texts: DataFrame, members: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """Links between component labels inside clusters of large buckets;
    ``members``: (bucket, doc_id, n, component)."""
    labels = cut(members.select("bucket", "component").distinct())
    heads = cut(labels.groupBy("bucket").agg(F.min("component").alias("a")))
    joins = small_join(labels, heads, "bucket").where("a <> component").select("a", F.col("component").alias("b")).distinct()
    clusters = components(joins).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    docs = small_join(cut(members.select("doc_id", "component").distinct()), clusters, "component")
    made = sets_of(texts, docs.select("doc_id").distinct(), sets)
    docs = cut(small_join(made, docs, "doc_id").withColumn("n", F.size("elements")).where("n > 0"))
    alone = (docs.select("cluster", "doc_id", F.explode("elements").alias("e")).groupBy("cluster", "e")
             .agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("doc_id")).where("df = 1")
             .groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone")))
    parts = (docs.groupBy("cluster", "component").agg(F.sum("n").alias("items"), F.min("n").alias("n"))
             .groupBy("cluster").agg(F.max_by("component", F.struct("items", "component")).alias("major"),
                                     F.min("n").alias("least"), F.sum("items").alias("all_items"),
                                     (F.sum("items") - F.max("items")).alias("rest_items")))
    docs = small_join(small_join(docs, cut(alone), "doc_id", "left"), cut(parts), "cluster")
    # linked: (100 + percent) |x and y| >= percent (|x| + |y|), and what x shares with any y is at most |x| - alone
    could = ((F.col("n") - F.coalesce("alone", F.lit(0))) * (100 + percent)
             >= (F.col("n") + F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))) * percent)
    docs = cut(docs.where(could))
    entry = F.struct("component", "elements")
    rows_of, columns_of = F.ceil(F.col("rest_items") / TILE_ITEMS), F.ceil(F.col("all_items") / TILE_ITEMS)
    right = docs.groupBy("cluster", F.pmod(F.xxhash64("doc_id"), columns_of).alias("y")).agg(F.collect_list(entry).alias("right"))
    left = (docs.where("component <> major")
            .groupBy("cluster", "all_items", F.pmod(F.xxhash64("doc_id", F.lit(3)), rows_of).alias("x"))
            .agg(F.collect_list(entry).alias("left"))
            .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), columns_of - 1))))
    tiles = left.join(right, ["cluster", "y"]).select("left", "right")
    return cut(tiles.mapInArrow(_tiler(percent), "a long, b long").distinct())


def settle(texts: DataFrame, members: DataFrame, sets: Sets, percent: int, admits: Callable | None = None) -> DataFrame:
    """(doc_id, component): the component (its smallest doc_id) of every document
    that is linked with another one; ``texts``: (doc_id, text); ``members``:
    (bucket, doc_id, n), each text of a document once in a bucket."""
    full = cut(members.groupBy("bucket").agg(F.min(F.struct("doc_id", "n")).alias("p"), F.max("doc_id").alias("last"))
               .where("p.doc_id < last").select("bucket", F.col("p.doc_id").alias("pivot"), F.col("p.n").alias("pn")))
    live = cut(small_join(members, full, "bucket").where("doc_id <> pivot"))
    fits = F.least("pn", "n") * 100 >= F.greatest("pn", "n") * percent
    pairs = cut(live.where(fits).select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = confirm(texts, pairs, sets, percent, admits)
    first = cut(components(links).select(F.col("node").alias("doc_id"), "component"))

    named = cut(small_join(live.select("bucket", "doc_id", "n"), first, "doc_id", "left")
                .withColumn("component", F.coalesce("component", "doc_id")))
    mixed = cut(named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                            F.count(F.lit(1)).alias("size")).where("lo < hi").select("bucket", "size"))
    if mixed.isEmpty():
        return first
    left = cut(small_join(named, mixed, "bucket"))
    few = left.where(F.col("size") <= SMALL).groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "n", "component"))).alias("m"))
    few = (few.select(F.posexplode("m").alias("i", "p"), "m")
           .select("p", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("q")).where("p.component <> q.component"))
    fits = F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent
    few = few.where(fits).select(F.col("p.doc_id").alias("a"), F.col("q.doc_id").alias("b")).distinct()
    more = confirm(texts, cut(few.join(pairs, ["a", "b"], "left_anti")), sets, percent, admits)
    for end in ("a", "b"):                              # documents to the labels of their components
        of = first.select(F.col("doc_id").alias(end), F.col("component").alias("label"))
        more = small_join(more, of, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    many = left.where(F.col("size") > SMALL).drop("size")
    if not many.isEmpty():
        more = more.unionByName(_cluster_links(texts, many, sets, percent))
    second = components(cut(more.where("a <> b").distinct())).withColumnRenamed("component", "label")
    known = first.unionByName(second.select(F.col("node").alias("doc_id"), F.col("node").alias("component"))).distinct()
    merged = small_join(known, second.withColumnRenamed("node", "component"), "component", "left")
    return cut(merged.groupBy("doc_id").agg(F.min(F.coalesce("label", "component")).alias("component")))


def with_copies(joined: DataFrame, same: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, component) of ``joined`` and of the copies in ``same`` (doc_id, a:
    the smallest doc_id of equal sets); ``texts``: (doc_id, ...), distinct.  A
    doc_id with several texts ties their components together."""
    if not texts.groupBy("doc_id").count().where("count > 1").isEmpty():
        edges = joined.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).unionByName(
            same.select("a", F.col("doc_id").alias("b"))).where("a <> b")
        return components(edges).select(F.col("node").alias("doc_id"), "component")
    extra = small_join(same, joined.select(F.col("doc_id").alias("a"), "component"), "a", "left")
    extra = extra.select("doc_id", F.coalesce("component", "a").alias("component"))
    return cut(joined.unionByName(extra).groupBy("doc_id").agg(F.min("component").alias("component")))
