"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources, in order of their names' code points (null last), weigh 5, 2, 1,
repeating, and share 150 % of all words; a target stops at twice its source's
words and the excess is shared again by weight.  The total is a house of equal
blocks of ``BLOCK_WORDS`` words; each block goes to the source with the highest
quotient target / (2 seats + 1).  The method is house-monotone, so the seats of
the first h shards, taken for each h, differ by whole, never negative quotas per
shard.  A source's documents stand in a seeded order as one stream of words; its
seats take that stream's blocks one after the other from a seeded start, round
and round, at most twice.

Only numbers go to the driver: totals, the water level, seats left per shard.  A
source's stream is summed in hashed buckets of about ``BUCKET_ROWS`` documents,
so no task holds a whole source.

Defined cases: a null text has no words; a null source is a source of its own;
sources without words get target 0; repeated rows are documents of their own;
an empty table gives an empty result.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barsight.llm.common import cut, fresh, global_index, read, small_join

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 32
BUCKET_ROWS = 512
SHARDS = 8
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["no_source", "source"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def with_targets(sources: DataFrame) -> DataFrame:
    """Add weight and target to (no_source, source, words, n).

    The water level rises until no further source is capped; each step is one
    aggregate over the table of sources."""
    ranked = global_index(sources, [F.col(k) for k in KEY], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).drop("place")
    total = SHARE * (ranked.agg(F.sum("words")).first()[0] or 0)
    level = 0.0
    while True:
        capped = F.col("words") * MOST <= F.col("weight") * F.lit(level)
        full, open_weight = ranked.agg(
            F.sum(F.when(capped, F.col("words") * MOST)), F.sum(F.when(~capped, F.col("weight")))).first()
        step = (total - (full or 0)) / open_weight if open_weight else level
        if step <= level:
            break
        level = step
    target = F.least(F.col("words") * F.lit(float(MOST)), F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def apportion(sources: DataFrame, houses: list[int]) -> DataFrame:
    """(key, house, seats): Sainte-Lague seats of each source for each house.

    A divisor a little too large gives seats that are sure; of the few
    quotients between it and one a little too small, the highest get the rest
    (ties: the earlier source)."""
    total, n = sources.agg(F.sum("target"), F.count(F.lit(1))).first()
    total, n = total or 0.0, n or 0
    slack = 2 * n + 2
    rows = sources.withColumn("house", F.explode(F.array(*[F.lit(h) for h in range(len(houses))])))

    def pick(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("house") + 1)

    def seats(divisors) -> Column:
        share = F.col("target") * pick(divisors)
        return F.least(F.col("cap"), F.floor(share + 0.5))

    low = [max(0.0, (h - slack) / total) if total else 0.0 for h in houses]
    high, wider = list(low), [1.0] * len(houses)
    rows = cut(rows)
    short = list(range(len(houses))) if total else []
    while short:                                    # widened only where caps keep sources from their seats
        for i in short:
            high[i], wider[i] = (houses[i] + slack * wider[i]) / total, wider[i] * 4
        sums = {r[0]: r[1:] for r in rows.groupBy("house").agg(F.sum(seats(high)), F.sum("cap")).collect()}
        short = [i for i in short if sums[i][0] < min(houses[i], sums[i][1])]
    rows = cut(rows.withColumn("sure", seats(low)).withColumn("most", seats(high)))
    sure = dict(rows.groupBy("house").agg(F.sum("sure")).collect())
    left = F.element_at(F.array(*[F.lit(h - (sure.get(i) or 0)) for i, h in enumerate(houses)]), F.col("house") + 1)
    quotients = (rows.where("most > sure")
                 .select(*KEY, "house", "target", F.explode(F.sequence("sure", F.col("most") - 1)).alias("k"))
                 .withColumn("quotient", F.col("target") / (2 * F.col("k") + 1)))
    order = Window.partitionBy("house").orderBy(F.desc("quotient"), *KEY, "k")
    extra = (quotients.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= left)
             .groupBy(*KEY, "house").agg(F.count(F.lit(1)).alias("extra")))
    return rows.join(extra, [*KEY, "house"], "left").select(
        *KEY, "house", (F.col("sure") + F.coalesce("extra", F.lit(0))).alias("seats"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text_key, size, source_size, target, passes
    (whole takes), [lo1, hi1) and [lo2, hi2) (words of the last, partial take),
    first_shard, taken."""
    rows = cut(docs.select(
        F.col("doc_id").cast("long"), F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")))
    sources = cut(rows.groupBy(*KEY).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    sources = cut(with_targets(sources).withColumn("blocks", F.ceil(F.col("words") / block).cast("long"))
                  .withColumn("cap", F.col("blocks") * MOST))
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    house = round(total / block)
    seats = apportion(sources, [house * (h + 1) // shards for h in range(shards)])
    held = seats.groupBy(*KEY).agg(F.max("seats").alias("seats"), F.sort_array(F.collect_list("seats")).alias("upto"))
    sources = cut(sources.join(held, KEY).withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS).cast("long"))
                  .withColumn("start", F.pmod(F.xxhash64("source", F.lit(seed)), F.greatest("blocks", F.lit(1)))))

    dealt = (small_join(rows, sources.drop("n", "weight"), KEY)
             .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("buckets"))))
    parts = dealt.groupBy(*KEY, "bucket").agg(F.sum("size").alias("part"))
    before = Window.partitionBy(*KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.select(*KEY, "bucket", F.coalesce(F.sum("part").over(before), F.lit(0)).alias("ahead")))
    inside = (Window.partitionBy(*KEY, "bucket")
              .orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "text_key", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = (dealt.join(parts, [*KEY, "bucket"])
              .withColumn("at", F.col("ahead") + F.sum("size").over(inside) - F.col("size")))

    n, end = F.greatest("blocks", F.lit(1)), F.col("at") + F.col("size")
    rest = F.col("seats") % n
    last = F.col("start") + rest
    hi1 = F.least(F.least(last, n) * block, F.col("words"))
    hi2 = F.greatest(last - n, F.lit(0)) * block

    def inner(lo: Column, hi: Column) -> tuple[Column, Column]:
        a = F.greatest(F.col("at"), lo)
        return a - F.col("at"), F.greatest(F.least(end, hi), a) - F.col("at")

    (a1, b1), (a2, b2) = inner(F.col("start") * block, hi1), inner(F.lit(0).cast("long"), hi2)
    out = placed.select(
        "doc_id", "text_key", "size", F.col("words").alias("source_size"), "target",
        F.floor(F.col("seats") / n).alias("passes"), a1.alias("lo1"), b1.alias("hi1"), a2.alias("lo2"), b2.alias("hi2"),
        F.expr(f"size(filter(upto, u -> u <= pmod(floor(at / {block}) - start, greatest(blocks, 1))))").alias("first_shard"))
    out = out.withColumn("taken", F.col("size") * F.col("passes") + F.col("hi1") - F.col("lo1")
                         + F.col("hi2") - F.col("lo2"))
    return out.withColumn("first_shard", F.when(F.col("taken") > 0, F.col("first_shard")))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each document as often as the mix takes it; where it takes
    a part, the text holds that part's words.  All columns stay; n_chars, where
    there is one, follows the text."""
    plan = mix(docs.select("doc_id", "source", "text"))
    piece = "named_struct('lo', {0}, 'hi', {1})"
    takes = (f"filter(concat(array_repeat({piece.format('0L', 'size')}, cast(passes as int)), "
             f"array({piece.format('lo1', 'hi1')}, {piece.format('lo2', 'hi2')})), p -> p.hi > p.lo)")
    plan = cut(plan.where("taken > 0").select("doc_id", "text_key", "size", F.expr(takes).alias("takes")))
    ids, key, size, take, copy = (fresh(c, docs) for c in ("mix_id", "mix_key", "mix_size", "mix_take", "mix_copy"))
    plan = plan.select(F.col("doc_id").alias(ids), F.col("text_key").alias(key), F.col("size").alias(size), "takes")
    keyed = docs.withColumn(ids, F.col("doc_id").cast("long")).withColumn(key, F.xxhash64("text"))
    if plan.groupBy(ids, key).count().where("count > 1").isEmpty():
        plan, keyed = plan.withColumn(copy, F.lit(1)), keyed.withColumn(copy, F.lit(1))
    else:                                           # rows of one doc_id and text: each takes its own part
        number = F.row_number().over(Window.partitionBy(ids, key).orderBy(key))
        plan, keyed = plan.withColumn(copy, number), keyed.withColumn(copy, number)
    plan = cut(plan.select(ids, key, copy, size, F.explode("takes").alias(take)))
    null_safe = keyed.alias("d").join(
        (F.broadcast(plan) if plan.limit(500_001).count() <= 500_000 else plan).alias("m"),
        F.col(f"d.{ids}").eqNullSafe(F.col(f"m.{ids}")) & (F.col(f"d.{key}") == F.col(f"m.{key}"))
        & (F.col(f"d.{copy}") == F.col(f"m.{copy}")))
    whole = (F.col(f"m.{take}.lo") == 0) & (F.col(f"m.{take}.hi") == F.col(f"m.{size}"))
    words = F.regexp_extract_all(F.col("d.text"), F.lit(WORD), F.lit(0))
    some = F.array_join(F.slice(words, (F.col(f"m.{take}.lo") + 1).cast("int"),
                                (F.col(f"m.{take}.hi") - F.col(f"m.{take}.lo")).cast("int")), " ")
    text = F.when(whole, F.col("d.text")).otherwise(some)
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(text.alias("text"))
        elif c == "n_chars":
            cols.append(F.when(whole, F.col("d.n_chars")).otherwise(F.length(some)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(f"d.`{c}`"))
    return null_safe.select(*cols)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_shard")
