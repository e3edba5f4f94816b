"""Exact top-k inner products by best-first search in an M-tree.

Inner product becomes distance by one more coordinate: x' = (x, sqrt(R^2 -
|x|^2)), R the largest norm, and q' = (q, 0) give |q' - x'|^2 = |q|^2 + R^2 -
2 q.x.  The tree has routing objects (a hashed sample, their number the square
root of the number of pages), below them pages of about ``PAGE`` vectors, and in
each page leaf nodes of about ``LEAF``.  Every node keeps its covering radius and
every node and vector its distance to its parent.

Queries run in blocks.  A block first searches the pages below its own routing
object, which bounds the k-th score of each query; then only pages that some
query's bound does not rule out.  In a page a query leaves out the leaf nodes
that |d(q, parent) - d(node, parent)| - radius > bound rules out before their
distance is computed, takes the others best first until the next lower bound
exceeds the k-th distance, and computes inner products only of vectors that the
stored parent distances let pass.  Bounds have a margin for rounding that grows
with the vectors; scores are exact integers: float64 products while no product of
two norms reaches 2^53, 64-bit integers up to 2^63, Python integers beyond (a
score that does not fit a long is cut to the nearest long).

Defined cases: vectors that are null or hold null or non-finite components (or
ones from 2^53 on after scaling, which doubles hold no more exactly) take no part;
shorter vectors are as if filled
with zeros; rows with the query's vec_id are no candidates; other repeated rows
each are candidates; a query repeated with equal vector is asked once; null
vec_ids take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barsight.llm.common import cut, read

TOP = 5
EVERY = 50
PAGE, LEAF, BLOCK = 1024, 64, 128
MOST_ROUTES = 1024
LIMIT = 2.0 ** 53
LONGEST = (1 << 63) - 1

ORACLE = """
WITH bad AS (SELECT DISTINCT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
             WHERE x IS NULL OR isnan(x) OR isinf(x)),
v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS c
      FROM embeddings WHERE embedding IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(sum(q.c * x.c) AS BIGINT) AS score
      FROM v q JOIN v x ON q.i = x.i WHERE q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id GROUP BY 1, 2),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def whole_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v): components floor(256 x) of the vectors that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) * 256 >= LIMIT))
    return (rows.where("vec_id is not null and embedding is not null").where(good)
            .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<long>").alias("v")))


def _matrix(lists, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim))
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _whole(lists, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _kind(norm2: float):
    """The numbers in which products of vectors of up to this squared norm are exact."""
    return float if norm2 < 2.0 ** 53 else np.int64 if norm2 < 2.0 ** 62 else object


def _slack(norm2: float) -> float:
    """Rounding of a distance between vectors of so much squared norm in all."""
    return 1e-4 + 4e-7 * math.sqrt(norm2)


def _lifted(x: np.ndarray, radius2: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(0.0, radius2 - (x * x).sum(1)))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, d))


def _page(routes: np.ndarray, dim: int, radius2: float):
    """Builder of one page: leaf nodes around spread-out vectors."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        x = _matrix(rows["v"].tolist(), dim)
        y = _lifted(x, radius2)
        parent = routes[int(rows["route"].iloc[0])][None, :]
        far = _distances(y, parent)[:, 0]
        centres, near = [int(np.argmin(far))], None
        near = _distances(y, y[centres])[:, 0]
        owner = np.zeros(len(y), np.int64)
        while len(centres) < -(-len(y) // LEAF) and near.max() > 0:
            centres.append(int(np.argmax(near)))
            d = _distances(y, y[centres[-1:]])[:, 0]
            owner[d < near] = len(centres) - 1
            near = np.minimum(near, d)
        order = np.argsort(owner, kind="stable")
        sizes = np.bincount(owner, minlength=len(centres))
        radius = [float(near[owner == j].max(initial=0.0)) for j in range(len(centres))]
        pack = lambda z, kind: np.ascontiguousarray(z, kind).tobytes()
        return pd.DataFrame([{
            "route": int(rows["route"].iloc[0]), "page": int(rows["page"].iloc[0]),
            "ids": pack(rows["vec_id"].to_numpy()[order], np.int64), "vectors": pack(_whole(rows["v"].to_numpy()[order], dim), np.int64),
            "near": pack(near[order], np.float64), "sizes": pack(sizes, np.int64), "centres": pack(x[centres], np.float64),
            "radius": pack(radius, np.float64), "up": pack(far[centres], np.float64)}])

    return build


PAGES = "route int, page int, ids binary, vectors binary, near binary, sizes binary, centres binary, radius binary, up binary"


def search_page(q: np.ndarray, exact: np.ndarray, own: int, floor: float, up: float, page: dict, radius2: float, k: int) -> list[tuple[int, int]]:
    """The best (score, vec_id) of a page for one query, scores of at least
    ``floor``; ``up``: the query's distance to the page's routing object;
    ``exact``: the query in the numbers of the page's vectors."""
    q2 = float(q @ q)
    slack = _slack(q2 + radius2)

    def reach(score: float) -> float:
        return math.sqrt(max(0.0, q2 + radius2 - 2 * score)) * (1 + 1e-9) + slack if score > -math.inf else math.inf

    bound = reach(floor)
    low = np.abs(up - page["up"]) - page["radius"]
    some = np.flatnonzero(low <= bound)
    if not len(some):
        return []
    far = np.sqrt(np.maximum(0.0, q2 + radius2 - 2 * (page["centres"][some] @ q)))
    low = np.maximum(low[some], far - page["radius"][some])
    best: list[tuple[int, int]] = []
    for i in np.argsort(low, kind="stable"):
        if low[i] > bound:
            break
        a, b = page["cuts"][some[i]], page["cuts"][some[i] + 1]
        at = a + np.flatnonzero((np.abs(far[i] - page["near"][a:b]) <= bound) & (page["ids"][a:b] != own))
        score = page["vectors"][at] @ exact
        good = np.asarray(score >= floor, bool)
        if good.any():
            best += zip((-int(x) for x in score[good]), page["ids"][at[good]].tolist())
            best.sort()
            best = best[:k]
            if len(best) == k:
                floor = max(floor, -best[-1][0])
                bound = reach(floor)
    return [(-s, v) for s, v in best]


def _searcher(dim: int, radius2: float, routes: np.ndarray, k: int, kind):
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                arr = lambda name, kind: np.frombuffer(row[name], kind)
                page = {"ids": arr("ids", np.int64), "near": arr("near", np.float64), "radius": arr("radius", np.float64),
                        "up": arr("up", np.float64), "vectors": arr("vectors", np.int64).reshape(-1, dim).astype(kind),
                        "centres": arr("centres", np.float64).reshape(-1, dim),
                        "cuts": np.r_[0, np.cumsum(arr("sizes", np.int64))]}
                whole = _whole([x["v"] for x in row["queries"]], dim)
                asked, exact = whole.astype(float), whole.astype(kind)
                up = _distances(np.c_[asked, np.zeros(len(asked))], routes[row["route"]][None, :])[:, 0]
                for q, e, x, u in zip(asked, exact, row["queries"], up):
                    floor = -math.inf if x["floor"] is None else x["floor"]
                    out += [(x["vec_id"], v, max(-LONGEST - 1, min(LONGEST, s)))
                            for s, v in search_page(q, e, x["vec_id"], floor, u, page, radius2, k)]
            if out:
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())],
                                                 names=["query_id", "vec_id", "score"])

    return run


def _router(routes: np.ndarray, dim: int, radius2: float, lift: bool):
    """Nearest routing object of each vector, and all distances to them."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist(), dim)
            d = _distances(_lifted(x, radius2) if lift else np.c_[x, np.zeros(len(x))], routes)
            near = d.argmin(1)
            more = [pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])]
            if not lift:
                more[1] = pa.array(list(d), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *more], names=["vec_id", "v", "route", "far"])

    return run


def top_products(rows: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each
    query among the other rows; both frames have (vec_id, embedding)."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    known = cut(whole_vectors(rows).withColumn("n2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    asked = cut(whole_vectors(queries).distinct())
    n, radius2, dim = known.agg(F.count(F.lit(1)), F.max("n2"), F.max(F.size("v"))).first()
    most, longest = asked.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)), F.max(F.size("v"))).first()
    dim = max(dim or 0, longest or 0)
    kind = _kind(max(radius2 or 0.0, most or 0.0))
    if not n or not dim or asked.isEmpty():
        return empty
    count = min(MOST_ROUTES, max(1, math.isqrt(-(-n // PAGE)) + 1))
    sample = known.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(count).collect()
    routes = _lifted(_matrix([r["v"] for r in sample], dim), radius2)
    placed = cut(known.select("vec_id", "v").mapInArrow(_router(routes, dim, radius2, True),
                                                        "vec_id long, v array<long>, route int, far double"))
    tops = {r["route"]: (r["c"], r["far"]) for r in placed.groupBy("route").agg(F.count(F.lit(1)).alias("c"), F.max("far").alias("far")).collect()}
    pages_of = F.element_at(F.array(*[F.lit(-(-tops[i][0] // PAGE) if i in tops else 0) for i in range(count)]), F.col("route") + 1)
    paged = placed.withColumn("page", F.pmod(F.xxhash64("vec_id", F.lit(5)), pages_of).cast("int"))
    pages = cut(paged.groupBy("route", "page").applyInPandas(_page(routes, dim, radius2), PAGES))

    homes = asked.mapInArrow(_router(routes, dim, radius2, False), "vec_id long, v array<long>, route int, far array<double>")
    homes = cut(homes.withColumnRenamed("route", "home"))
    blocks = max(1, -(-homes.count() // BLOCK))

    def blocked(frame: DataFrame) -> DataFrame:
        """Blocks of queries for every page of the route they ask."""
        group = frame.groupBy("route", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).agg(
            F.collect_list(F.struct("vec_id", "v", "floor")).alias("queries"))
        each = F.explode(F.sequence(F.lit(0), pages_of - 1)).alias("page")
        return group.select("route", "queries", each).join(pages, ["route", "page"]).mapInArrow(
            _searcher(dim, radius2, routes, k, kind), "query_id long, vec_id long, score long")

    has = F.array(*[F.lit(i in tops) for i in range(count)])
    first = homes.where(F.element_at(has, F.col("home") + 1)).select(
        "vec_id", "v", F.col("home").alias("route"), F.lit(None).cast("long").alias("floor"))
    found = cut(blocked(first))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = (found.withColumn("rank", rank).where(f"rank = {k}").select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor")))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    reach = F.sqrt(F.greatest(F.lit(0.0), norm + F.lit(float(radius2)) - 2.0 * F.col("floor").cast("double"))) * (1 + 1e-9) + 1e-4 + 4e-7 * F.sqrt(norm + F.lit(float(radius2)))
    cover = F.element_at(F.array(*[F.lit(float(tops[i][1]) if i in tops else -1e300) for i in range(count)]), F.col("route") + 1)
    rest = (homes.join(floors, "vec_id", "left").select("vec_id", "v", "home", "floor", F.posexplode("far").alias("route", "d"))
            .where((F.col("route") != F.col("home")) & F.element_at(has, F.col("route") + 1))
            .where(F.col("floor").isNull() | (F.col("d") - cover <= reach)))
    found = found.unionByName(blocked(rest.select("vec_id", "v", "route", "floor")))
    return found.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_products(rows, rows.where(f"vec_id % {EVERY} = 0"))
