"""Sharding by balanced label propagation (law ``rows``).

Documents of equal text are linked.  Linked documents are dealt evenly over the
shards by hash; in each round every one asks for the shard that holds most of
its group.  From the shards x shards table of requests the driver takes cycles:
swaps, longer exchanges, and chains that end in a free place; along these
documents move, so no shard ever holds more than its quota.  Documents move only
towards shards that hold more of their group, so the rounds end; they go on until
one moves nothing.  A group of more than a quarter of a shard is split into
hashed parts, which move towards as many of its fullest shards as it needs.
Documents without links have no cut edge to lose; they fill the shards up, so
counts end at most one apart.

Defined cases: null text: no bytes, no link, text_crc32 null; repeated rows are
rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.llm.common import cut, global_index, read, small_join

SHARDS = 40


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index + 1)


def _cycle(follow: dict[int, list[int]]) -> list[int] | None:
    """Nodes of a cycle, first one repeated at the end, or None."""
    dead: set[int] = set()
    for start in follow:
        path, at = [start], {start: 0}
        if start in dead:
            continue
        while path:
            to = next((j for j in follow.get(path[-1], ()) if j not in dead), None)
            if to is None:
                dead.add(path[-1])
                del at[path.pop()]
            elif to in at:
                return path[at[to]:] + [to]
            else:
                at[to] = len(path)
                path.append(to)
    return None


def flows(asked: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """How many of the requests ``asked`` (from, to) move at once, so that no
    shard takes in more than it gives away and has free: swaps, then longer
    cycles, then chains into free places."""
    left, free = {k: v for k, v in asked.items() if v}, list(free)
    taken: dict[tuple[int, int], int] = {}

    def take(edge: tuple[int, int], amount: int) -> None:
        taken[edge] = taken.get(edge, 0) + amount
        left[edge] -= amount
        if not left[edge]:
            del left[edge]

    for i, j in sorted(left):
        if i < j and (j, i) in left:
            amount = min(left[i, j], left[j, i])
            take((i, j), amount)
            take((j, i), amount)
    while True:
        follow: dict[int, list[int]] = {}
        for i, j in sorted(left):
            follow.setdefault(i, []).append(j)
        nodes = _cycle(follow)
        if nodes is None:
            break
        edges = list(zip(nodes, nodes[1:]))
        amount = min(left[e] for e in edges)
        for e in edges:
            take(e, amount)
    moved = True
    while moved:
        moved = False
        for i, j in sorted(left):
            if amount := min(left[i, j], free[j]):
                take((i, j), amount)
                free[i], free[j], moved = free[i] + amount, free[j] - amount, True
    return taken


def _propagate(linked: DataFrame, shards: int, quota: list[int], size: int) -> DataFrame:
    """Rounds of label propagation over (doc_id, g, part, shard, ...) until one
    moves nothing; parts have about ``size`` rows, a shard has room for its quota."""
    columns, room, r = linked.columns, max(1, min(quota)), 0
    while True:
        used = dict(linked.groupBy("shard").count().collect())
        here = linked.groupBy("g", "shard").agg(F.count(F.lit(1)).alias("c"))
        free = [quota[j] - used.get(j, 0) for j in range(shards)]
        rank = F.struct("c", (_pick(free, F.col("shard")) > 0).alias("open"), F.xxhash64("g", "shard", F.lit(r)).alias("tie"), "shard")
        best = cut(here.groupBy("g").agg(F.sort_array(F.collect_list(rank), asc=False)["shard"].alias("order"))
                   .where("size(order) > 1"))
        # the parts of a large group fill the group's fullest shards one after the other
        nth = F.expr(f"cast(least(part * {size} div {room}, size(order) - 1) as int) + 1")
        asked = cut(small_join(linked, best, "g", "left").withColumn("nth", nth)
                    .withColumn("want", F.when(F.array_position("order", F.col("shard")) > F.col("nth"), F.element_at("order", F.col("nth"))))
                    .drop("order", "nth"))
        sums = {(i, j): c for i, j, c in asked.where("want is not null").groupBy("shard", "want").count().collect()}
        taken = flows(sums, free)
        if not taken:
            return linked
        # groups come one after the other among the requests from one shard to another
        order = [F.col("shard"), F.col("want"), F.xxhash64("g", F.lit(r)), *[F.col(c) for c in columns if c != "shard"]]
        movers = global_index(asked.where("want is not null"), order, "place")
        first, total = {}, 0
        for edge in sorted(sums):
            first[edge], total = total, total + sums[edge]
        ends = F.create_map(*[F.lit(x) for (i, j), c in taken.items() for x in (i * shards + j, first[i, j] + c)])
        goes = F.col("place") < F.coalesce(ends[F.col("shard") * shards + F.col("want")], F.lit(0))
        moved = movers.withColumn("shard", F.when(goes, F.col("want")).otherwise(F.col("shard")))
        linked = cut(asked.where("want is null").select(*columns).unionByName(moved.select(*columns)))
        r += 1


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.col("text").cast("string")
    rows = cut(docs.select(
        F.col("doc_id").cast("long"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("g")))
    n = rows.count()
    quota = [n // shards + (j < n % shards) for j in range(shards)]
    groups = cut(rows.where("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    known = cut(small_join(rows, groups, "g", "left"))
    part = max(1, n // shards // 4)
    linked = known.where("m is not null").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("m") / part))).drop("m")
    linked = global_index(linked, [F.xxhash64("doc_id", F.lit(11)), *[F.col(c) for c in linked.columns]], "place")
    linked = linked.withColumn("shard", (F.col("place") % shards).cast("int")).drop("place")
    linked = _propagate(linked, shards, quota, part)

    linked = global_index(linked, [F.col(c) for c in ("shard", "g", "doc_id", "size", "text_crc32")], "place")
    count = dict(linked.groupBy("shard").count().collect())
    begin = [sum(count.get(i, 0) for i in range(j)) for j in range(shards)]
    linked = linked.withColumn("slot", F.col("place") - _pick(begin, F.col("shard")))
    stays = F.col("slot") < _pick(quota, F.col("shard"))
    keep = ["doc_id", "size", "text_crc32"]
    settled = linked.where(stays).select(*keep, "shard", "slot")
    others = (known.where("m is null").select(*keep).unionByName(linked.where(~stays).select(*keep)))
    others = global_index(others, [F.xxhash64("doc_id"), *[F.col(c) for c in keep]], "place")
    held = [min(count.get(j, 0), quota[j]) for j in range(shards)]
    first = [sum(quota[i] - held[i] for i in range(j)) for j in range(shards)]
    ends = F.array(*[F.lit(first[j] + quota[j] - held[j]).cast("long") for j in range(shards)])
    to = F.size(F.filter(ends, lambda e: e <= F.col("place")))
    filled = (others.withColumn("shard", to)
              .withColumn("slot", F.col("place") - _pick(first, F.col("shard")) + _pick(held, F.col("shard"))))
    return (settled.unionByName(filled.select(*keep, "shard", "slot"))
            .select(*keep, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
