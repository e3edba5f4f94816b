import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barsight.operators.metrics import average_precision, average_precision_by, brier, positive_weight
from barsight.operators.ordering import global_position
from barsight.operators.ranking import chronological_split, top_k_per_group
from barsight.operators.labels import with_labels


def ap_reference(probs, labels):
    pairs = sorted(zip(probs, labels), key=lambda x: -x[0])
    total = sum(labels)
    ap, tp, n, i = 0.0, 0, 0, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        step_tp = sum(l for _, l in pairs[i:j])
        tp += step_tp
        n += j - i
        ap += (step_tp / total) * (tp / n)
        i = j
    return ap


def test_average_precision_matches_reference(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(data, "prob double, target int")
    got = average_precision(df).first()["pr_auc"]
    assert got == pytest.approx(ap_reference(*zip(*data)), rel=1e-12)
    grouped = df.withColumn("g", (F.monotonically_increasing_id() % 3).cast("int"))
    rows = grouped.collect()
    by = {r["g"]: r["pr_auc"] for r in average_precision_by(grouped, "g").collect()}
    for g in range(3):
        sub = [(r["prob"], r["target"]) for r in rows if r["g"] == g]
        assert by[g] == pytest.approx(ap_reference(*zip(*sub)), rel=1e-12)
    assert brier(df).first()[0] == pytest.approx(sum((p - y) ** 2 for p, y in data) / len(data))


def test_auto_weight_undefined_for_single_class(spark):
    pos = spark.createDataFrame([(1,), (1,)], "target int")
    neg = spark.createDataFrame([(0,), (0,)], "target int")
    assert positive_weight(pos).first()["suggested_weight"] == 0.0
    assert positive_weight(neg).first()["suggested_weight"] is None
    assert positive_weight(neg, override=3.0).first()["pos_weight"] == 3.0


def test_global_position_and_split(spark):
    rng = random.Random(9)
    rows = [(f"T{rng.randint(0, 30)}", dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 50)), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "ticker string, date date, id int").dropDuplicates(["ticker", "date"])
    local = sorted(df.collect(), key=lambda r: (r["date"], r["ticker"]))
    pos = {r["id"]: r["pos"] for r in global_position(df, [F.col("date"), F.col("ticker")], partitions=5).collect()}
    assert [pos[r["id"]] for r in local] == list(range(len(local)))
    split = {r["id"]: r["split"] for r in chronological_split(df).collect()}
    cut = int(len(local) * 0.8)
    assert [split[r["id"]] for r in local] == ["train"] * cut + ["validate"] * (len(local) - cut)


def test_topk_ties_are_deterministic(spark):
    df = spark.createDataFrame([("B", 0.9), ("A", 0.9), ("C", 0.9), ("D", 0.1)], "ticker string, prob double") \
        .withColumn("g", F.lit("CALL"))
    top = top_k_per_group(df, ["g"], [F.col("prob").desc(), F.col("ticker").asc()], 2).collect()
    assert sorted(r["ticker"] for r in top) == ["A", "B"]


def test_labels_last_bar_and_exclusive(spark):
    df = spark.createDataFrame(
        [("T", dt.date(2020, 1, d), c, n, 1.0) for d, c, n in [(1, 10.0, 11.0), (2, 11.0, 9.0), (3, 9.0, None)]],
        "ticker string, date date, close double, next_close double, atrr_14 double")
    got = {r["date"].day: (r["target_long"], r["target_short"]) for r in with_labels(df).collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0)}
    assert with_labels(df, drop_unlabelled=True).count() == 2
