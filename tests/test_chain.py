"""Partitioned MERGE and backfill, the ledger of batches, and the whole chain."""
import datetime as dt
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType

from barsight.operators.tables import backfill_source, merge_snapshot, merge_upsert, plan_backfill
from barsight.plans.chain import (
    backfill_partitions, loaded_batches, merge_batches, merge_partitions, merged_batches, run_chain,
)
from barsight.sources import partitioned

SCHEMA = (StructType().add("ticker", StringType()).add("quarter_end_date", DateType()).add("earnings_call_date", DateType())
          .add("score", DoubleType()).add("max_close_30d", DoubleType()).add("load_seq", LongType()))
STRICT = ["ticker", "quarter_end_date", "score"]


def quarter(i):
    return dt.date(2010 + i // 4, 3 * (i % 4) + 1, 28)


@pytest.fixture
def table(spark, tmp_path):
    rows = [(f"t{t}", quarter(q), quarter(q) + dt.timedelta(days=20), float(q * 100 + t), None, t) for q in range(40) for t in range(6)]
    final = spark.createDataFrame(rows, SCHEMA)
    root = f"{tmp_path}/table"
    partitioned.overwrite(final, root, "quarter_end_date")
    return root, final


def files(root):
    return {d: sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for f in names if f.startswith("part-"))
            for d, _, names in os.walk(root) if "quarter_end_date=" in d}


def rows_of(df):
    return sorted(map(tuple, df.select(*SCHEMA.names).collect()), key=repr)


def staged(spark):
    q = [quarter(i) for i in (3, 17, 39)]
    call = q[0] + dt.timedelta(days=9)
    return spark.createDataFrame([
        ("t0", q[0], call, -1.0, None, 1), ("t0", q[0], call + dt.timedelta(days=1), -2.0, 5.0, 0), ("new", q[1], call, -3.0, None, 2),
        ("t5", q[2], call, None, None, 3), ("bad", q[2], call, None, None, 4), (None, q[2], call, 1.0, None, 5)], SCHEMA)


def test_merge_rewrites_only_the_partitions_that_staging_touches(spark, table):
    root, final = table
    before = files(root)
    counts = merge_partitions(spark, root, staged(spark), SCHEMA, strict=STRICT)
    after = files(root)
    assert counts == {"update": 2, "insert": 1, "skip": 2, "keep": 16, "partitions": 3}
    assert len(before) == len(after) == 40
    assert sum(before[d] == after[d] for d in before) == 37
    want = merge_snapshot(merge_upsert(final, staged(spark), strict=STRICT))
    assert rows_of(partitioned.read(spark, root, SCHEMA, "quarter_end_date")) == rows_of(want)
    assert merge_partitions(spark, root, staged(spark).where("false"), SCHEMA, strict=STRICT)["partitions"] == 0
    merge_partitions(spark, root, staged(spark), SCHEMA, strict=STRICT)                    # a second time: the same table
    assert rows_of(partitioned.read(spark, root, SCHEMA, "quarter_end_date")) == rows_of(want)


def test_reading_some_partitions_lists_no_others(spark, table):
    root, _ = table
    some = partitioned.read(spark, root, SCHEMA, "quarter_end_date", [quarter(3)])
    assert some.count() == 6 and len(some.inputFiles()) > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*quarter_end_date", plan)


def test_rows_without_a_partition_value_are_kept_together(spark, tmp_path):
    root = f"{tmp_path}/nulls"
    row = lambda t: spark.createDataFrame([(t, None, None, 1.0, None, 0)], SCHEMA)
    for t in ("a", "b"):
        merge_partitions(spark, root, row(t), SCHEMA, strict=["ticker"])
    assert {r.ticker for r in partitioned.read(spark, root, SCHEMA, "quarter_end_date").collect()} == {"a", "b"}


@pytest.mark.parametrize("mode", ["as_coded", "forward_window"])
def test_backfill_rewrites_only_partitions_with_something_to_fill(spark, table, mode):
    root, final = table
    days = [quarter(q) + dt.timedelta(days=20 + d) for q in (2, 9) for d in (0, 4)]
    prices = spark.createDataFrame([("t1", d, 7.0 + i) for i, d in enumerate(days)], "ticker STRING, date DATE, adj_close DOUBLE")
    before, as_of = files(root), dt.date(2030, 1, 1)
    got = backfill_partitions(spark, root, SCHEMA, prices, as_of, mode)
    after = files(root)
    assert got == {"updated": 2, "partitions": 2} and sum(before[d] == after[d] for d in before) == 38
    want = plan_backfill(final, backfill_source(final, prices, as_of, mode)).drop("_updated")
    assert rows_of(partitioned.read(spark, root, SCHEMA, "quarter_end_date")) == rows_of(want)


def batch(spark, folder, n, df):
    df.write.mode("overwrite").parquet(f"{folder}/batch={n}")


def test_a_replayed_batch_merges_once_and_truncation_spares_unmerged_ones(spark, table, tmp_path):
    root, _ = table
    folder, q = f"{tmp_path}/staging", quarter(5)
    row = lambda s, n: spark.createDataFrame([("t0", q, q, s, None, n)], SCHEMA)
    batch(spark, folder, 0, row(1.0, 1))
    assert merge_batches(spark, folder, root, SCHEMA, strict=STRICT, soft=[])["batches"] == [0]
    batch(spark, folder, 1, row(2.0, 2))
    assert merge_batches(spark, folder, root, SCHEMA, strict=STRICT, soft=[])["batches"] == [1]
    batch(spark, folder, 0, row(1.0, 1))                                       # the stream replays batch 0
    got = merge_batches(spark, folder, root, SCHEMA, strict=STRICT, soft=[])
    assert got == {"batches": [], "status": "empty_staging"}
    value = partitioned.read(spark, root, SCHEMA, "quarter_end_date", [q]).where("ticker = 't0'").first().score
    assert value == 2.0                                                         # not set back to batch 0
    os.makedirs(f"{folder}/batch=2")                                            # a write in progress: no _SUCCESS
    batch(spark, folder, 3, row(4.0, 4))
    merge_batches(spark, folder, root, SCHEMA, strict=STRICT, soft=[], truncate=True)
    assert merged_batches(spark, folder) == {0, 1, 3} and loaded_batches(spark, folder) == []
    assert os.path.isdir(f"{folder}/batch=2")


def test_gates_stop_the_merge_and_leave_the_batches_pending(spark, table, tmp_path):
    root, final = table
    folder = f"{tmp_path}/staging"
    batch(spark, folder, 0, staged(spark))
    got = merge_batches(spark, folder, root, SCHEMA, strict=STRICT, soft=[])
    assert got["status"] == "aborted_strict_nulls" and merged_batches(spark, folder) == set()
    batch(spark, folder, 0, staged(spark).drop("load_seq"))
    assert merge_batches(spark, folder, root, SCHEMA, strict=["quarter_end_date"], soft=[])["status"] == "schema_mismatch"
    assert rows_of(partitioned.read(spark, root, SCHEMA, "quarter_end_date")) == rows_of(final)


def test_chain_from_envelopes_to_the_table(spark, table, tmp_path):
    root, final = table
    good = staged(spark).where("score is not null and ticker is not null")
    data = F.base64(F.encode(F.to_json(F.struct(*SCHEMA.names)), "UTF-8"))
    body = F.to_json(F.struct(F.struct(data.alias("data")).alias("message")))
    base = f"{tmp_path}/{uuid.uuid4().hex}"
    out = good.select(F.col("load_seq").alias("envelope_id"), body.alias("body"))
    args = (f"{base}/in", f"{base}/staging", f"{base}/rejects", f"{base}/_checkpoint", root, SCHEMA, "ticker,quarter_end_date")
    out.write.json(f"{base}/in")
    got = run_chain(spark, *args, strict=STRICT, soft=[])
    assert got["status"] == "merged" and got["counts"]["partitions"] == 2
    want = rows_of(merge_snapshot(merge_upsert(final, good, strict=STRICT)))
    assert rows_of(partitioned.read(spark, root, SCHEMA, "quarter_end_date")) == want
    assert run_chain(spark, *args, strict=STRICT, soft=[])["status"] == "empty_staging"       # nothing new
