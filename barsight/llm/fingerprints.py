"""Document fingerprints by winnowing, in DataFrame functions only.

Words are hashed, runs of ``GRAM`` words give rolling gram hashes, and of every
``WINDOW`` consecutive grams the smallest hash is chosen, the rightmost on ties.
A fingerprint is the chosen (hash, position) pairs, so any run of
``GRAM + WINDOW - 1`` words that two texts share puts a common hash into both.
Hash and position are one long, hash << 31 | (2^31 - 1 - position), whose
minimum is the wanted choice.

A document's follower (the next in descending doc_id, the first after the last)
comes from a window over blocks of ids: the blocks' bounds are ids taken from
the data, a block's largest id is also dealt to the block above as its last
row, and so one exchange of the texts suffices and no block holds more than a
small share of them.

Defined cases: null text counts as empty; a text of fewer than ``GRAM`` words has
its whole word sequence as only gram; no word: empty fingerprint; two empty
fingerprints are alike (1), one empty and one not are unlike (0).  Null doc_ids
come last in the order; among equal ids the texts' order decides.  The only
document is its own follower.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barsight.llm.common import read

GRAM = 5
WINDOW = 8
#: Blocks of ids for each shuffle partition.
BLOCKS = 8
_LAST = (1 << 31) - 1


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the array of chosen (hash, position) longs of a text column.

    Steps are columns of their own, so that no step is evaluated anew for every
    element of the next one."""
    w, g = f"{name}_words", f"{name}_grams"
    df = df.withColumn(w, F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != ""), lambda x: F.xxhash64(x)))
    rest = ", ".join(f"get({w}, i + {j})" for j in range(1, GRAM))
    packed = "shiftleft({0} & 4294967295L, 31) + ({1} - i)"
    df = df.withColumn(g, F.expr(
        f"CASE WHEN size({w}) >= {GRAM} THEN transform(slice({w}, 1, size({w}) - {GRAM - 1}), "
        f"(x, i) -> {packed.format(f'xxhash64(x, {rest})', f'{_LAST}L')}) "
        f"WHEN size({w}) > 0 THEN array(shiftleft(xxhash64({w}) & 4294967295L, 31) + {_LAST}L) "
        f"ELSE cast(array() as array<bigint>) END"))
    df = df.withColumn(name, F.expr(
        f"CASE WHEN size({g}) > {WINDOW} THEN array_distinct(transform(slice({g}, 1, size({g}) - {WINDOW - 1}), "
        f"(x, i) -> array_min(slice({g}, i + 1, {WINDOW})))) "
        f"WHEN size({g}) > 0 THEN array(array_min({g})) ELSE {g} END"))
    return df.drop(w, g)


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, 31)))


def positions(fingerprint: Column) -> Column:
    """Word positions of the chosen grams."""
    return F.transform(fingerprint, lambda v: (F.lit(_LAST) - v.bitwiseAND(F.lit(_LAST))).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def digest(fingerprint: Column) -> Column:
    return F.md5(F.array_join(F.transform(fingerprint, lambda v: F.hex(v)), ","))


def with_follower(docs: DataFrame) -> tuple[DataFrame, object]:
    """(id, text, block, tail) rows and the window that runs through a block in
    descending id; rows with tail = 1 only serve as followers."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / n for i in range(n)]
    found = rows.agg(F.percentile_approx("id", shares, 20 * n).alias("b"), F.max("id").alias("last")).first()
    bounds = sorted({*(found["b"] or []), *([found["last"]] if found["last"] is not None else [])}) or [0]
    literal = "array(" + ", ".join(f"{b}L" if b > -(1 << 63) else "(-9223372036854775807L - 1L)" for b in bounds) + ")"
    halves = ", ".join(str(1 << k) for k in reversed(range(len(bounds).bit_length())))
    # how many bounds lie below the id, by halving
    block = F.expr(f"aggregate(array({halves}), 0, (at, step) -> "
                   f"if(coalesce(get({literal}, at + step - 1) < id, false), at + step, at))")
    rows = rows.withColumn("block", block)
    head = F.col("id") == F.element_at(F.expr(literal), F.col("block") + 1)
    above = F.pmod(F.col("block") + 1, F.lit(len(bounds)))
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("tail"))
    places = F.when(head, F.array(own, F.struct(above.alias("block"), F.lit(1).alias("tail")))).otherwise(F.array(own))
    rows = rows.withColumn("place", F.explode(places)).select("id", "doc_id", "text", "place.block", "place.tail")
    return rows, Window.partitionBy("block").orderBy("tail", F.desc("id"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint, edited, edited_fingerprint."""
    rows, order = with_follower(docs)
    rows = with_fingerprint(rows, "text", "fingerprint")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "next_fingerprint", F.lead("fingerprint").over(order)).where("tail = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    return with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_fingerprint")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints(read(spark, sf_dir, "documents"))
    rows = rows.withColumn("own", hashes(F.col("fingerprint"))).withColumn("other", hashes(F.col("edited_fingerprint")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("fingerprint")).alias("fingerprint"), digest(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), hashes(F.col("next_fingerprint"))).alias("near_next"))
