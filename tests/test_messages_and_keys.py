import base64
import json

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from barsight.operators.tables import existing_keys, missing_work, parse_key, work_items
from barsight.sources.messages import decode_messages, missing_fields, split_valid

ROW = StructType([StructField("ticker", StringType()), StructField("quarter_end_date", StringType()),
                  StructField("earnings_call_date", StringType()),
                  StructField("tags", ArrayType(StringType())), StructField("n", LongType()),
                  StructField("flag", BooleanType())])
REQUIRED = "ticker, quarter_end_date,earnings_call_date,,tags,n,flag"


def env(obj):
    return json.dumps({"message": {"data": base64.b64encode(json.dumps(obj).encode()).decode()}})


def test_required_fields_rules(spark):
    base = {"ticker": "A", "quarter_end_date": "2024-03-31", "earnings_call_date": "2024-04-20",
            "tags": ["x"], "n": 0, "flag": False}
    bodies = [(1, env(base)), (2, env({**base, "ticker": ""})), (3, env({**base, "tags": []})),
              (4, env({**base, "ticker": None})), (5, "{\"messages\": [{\"data\": \"@@@\"}]}"),
              (6, "{\"other\": 1}"), (7, json.dumps({"messages": [
                  {"data": base64.b64encode(json.dumps(base).encode()).decode()},
                  {"data": base64.b64encode(b"[1, 2]").decode()}]}))]
    df = spark.createDataFrame(bodies, "envelope_id bigint, body string")
    dec = decode_messages(df, ROW)
    miss = {(r["envelope_id"], r["pos"]): r["m"] for r in
            dec.select("envelope_id", "pos", missing_fields(dec, REQUIRED).alias("m")).collect()}
    assert miss[(1, 0)] == [] and miss[(7, 0)] == []          # 0 and false are present
    assert miss[(2, 0)] == ["ticker"] and miss[(3, 0)] == ["tags"] and miss[(4, 0)] == ["ticker"]
    status = {(r["envelope_id"], r["pos"]): r["status"] for r in dec.collect()}
    assert status[(5, 0)] == "malformed" and status[(6, 0)] == "bad_envelope"
    assert status[(7, 1)] == "malformed"                        # JSON but not an object
    valid, rejects = split_valid(dec, REQUIRED)
    assert sorted((r["envelope_id"], r["pos"]) for r in valid.collect()) == [(1, 0), (7, 0)]
    assert rejects.count() == 6


def test_key_parts_and_discovery(spark):
    keys = spark.createDataFrame([("A_2024-03-31",), ("A",), ("A_B_2024-03-31",)], "key string")
    t, d, ok = parse_key(F.col("key"))
    got = {r["key"]: (r["t"], r["d"], r["ok"]) for r in keys.select("key", t.alias("t"), d.alias("d"),
                                                                  ok.alias("ok")).collect()}
    assert got["A_2024-03-31"] == ("A", "2024-03-31", True)
    assert got["A"][2] is False and got["A_B_2024-03-31"][2] is False
    feats = spark.createDataFrame([("A", "2024-03-31")], "ticker string, quarter_end_date string") \
        .select("ticker", F.to_date("quarter_end_date").alias("quarter_end_date"))
    listing = spark.createDataFrame(
        [("summaries/A_2024-03-31.txt",), ("summaries/B_2024-03-31.txt",), ("summaries/C_2024-03-31.json",),
         ("summaries/sub/D_2024-06-30.txt",)], "path string")
    items = work_items(missing_work(listing, existing_keys(feats)), "s3://bucket")
    got = sorted((r["ticker"], r["summary_path"], r["transcript_path"]) for r in items.collect())
    assert got == [("B", "s3://bucket/summaries/B_2024-03-31.txt",
                    "s3://bucket/earnings-call-transcripts/B_2024-03-31.json"),
                   ("D", "s3://bucket/summaries/sub/D_2024-06-30.txt",
                    "s3://bucket/earnings-call-transcripts/D_2024-06-30.json")]


def test_listing_from_files(spark, tmp_path):
    from barsight.sources.listing import list_objects
    for name in ["A_2024-03-31.txt", "B_2024-06-30.txt", "C_2024-06-30.json"]:
        (tmp_path / name).write_text("summary")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "D_2024-06-30.txt").write_text("summary")
    (tmp_path / "E_2024-06-30.txt").write_text("")
    (tmp_path / "sub" / "deep").mkdir()
    (tmp_path / "sub" / "deep" / "F_2024-06-30.txt").write_text("")
    (tmp_path / "none").mkdir()
    rows = list_objects(spark, str(tmp_path), tasks=2)
    got = sorted((r["path"].rsplit("/", 1)[-1], r["size"]) for r in rows.collect())
    assert got == [("A_2024-03-31.txt", 7), ("B_2024-06-30.txt", 7), ("D_2024-06-30.txt", 7),
                   ("E_2024-06-30.txt", 0), ("F_2024-06-30.txt", 0)]
    existing = spark.createDataFrame([("A_2024-03-31",)], "key string")
    assert sorted(r["key"] for r in missing_work(rows, existing).collect()) == ["B_2024-06-30", "D_2024-06-30", "E_2024-06-30", "F_2024-06-30"]
    assert list_objects(spark, str(tmp_path / "none")).count() == 0
