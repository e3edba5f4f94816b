"""Message envelopes -> rows -> valid / rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from barsight.functions.columns import is_missing

ENVELOPE = StructType([
    StructField("message", StructType([StructField("data", StringType())])),
    StructField("messages", ArrayType(StructType([StructField("data", StringType())]))),
])
# Fixed value: the reference loader's default required fields.
DEFAULT_REQUIRED = "ticker,quarter_end_date,earnings_call_date"


def decode_messages(envelopes: DataFrame, row_schema: StructType, body: str = "body",
                    id_col: str = "envelope_id") -> DataFrame:
    """Envelope JSON -> one row per message.

    A single ``message`` or a list ``messages`` (``message`` wins if both are
    present); any other shape is a rejected envelope (``bad_envelope``).  Each
    ``data`` is base64 of a UTF-8 JSON object; anything else is ``malformed``.
    Output: ``id_col, pos, <row fields>, status`` with status in
    {'ok', 'malformed', 'bad_envelope'}."""
    env = envelopes.select(F.col(id_col), F.from_json(F.col(body), ENVELOPE).alias("_e"))
    msgs = F.when(F.col("_e.message").isNotNull(), F.array(F.col("_e.message"))).otherwise(F.col("_e.messages"))
    env = env.select(F.col(id_col), msgs.alias("_msgs"), msgs.isNull().alias("_bad"))
    # an envelope of another shape gives one row without message; an empty list gives none
    exploded = (env.where("_bad OR size(_msgs) > 0")
                .select(F.col(id_col), "_bad", F.posexplode_outer("_msgs").alias("pos", "_m")))
    decoded = exploded.select(
        F.col(id_col), "_bad", F.coalesce("pos", F.lit(0)).alias("pos"),
        F.expr("try_validate_utf8(cast(try_to_binary(_m.data, 'base64') AS STRING))").alias("_txt"))
    is_object = (F.col("_txt").isNotNull() & F.ltrim(F.col("_txt")).startswith("{")
                 & F.expr("try_parse_json(_txt) IS NOT NULL"))
    parsed = decoded.select(F.col(id_col), "pos", "_bad", F.from_json(F.col("_txt"), row_schema).alias("_r"),
                            is_object.alias("_okjson"))
    status = (F.when(F.col("_bad"), F.lit("bad_envelope")).when(F.col("_okjson"), F.lit("ok"))
              .otherwise(F.lit("malformed")))
    return parsed.select(F.col(id_col), "pos",
                         *[F.when(F.col("_okjson"), F.col(f"_r.{f.name}")).alias(f.name) for f in row_schema.fields],
                         status.alias("status"))


def missing_fields(df: DataFrame, fields) -> F.Column:
    """Array of the required field names that are missing (NULL, '' or [])."""
    if isinstance(fields, str):
        fields = fields.split(",")
    names = [f.strip() for f in fields if f.strip()]
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [F.when(is_missing(n, types[n]), F.lit(n)) if n in types else F.lit(n) for n in names]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def split_valid(decoded: DataFrame, fields) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``reason``)."""
    miss = missing_fields(decoded, fields)
    tagged = decoded.withColumn("_missing", miss)
    ok = (F.col("status") == "ok") & (F.size("_missing") == 0)
    valid = tagged.where(ok).drop("_missing", "status")
    rejects = tagged.where(~ok).select(
        *[c for c in decoded.columns if c != "status"],
        F.when(F.col("status") != "ok", F.col("status"))
         .otherwise(F.concat(F.lit("missing:"), F.array_join("_missing", ","))).alias("reason"))
    return valid, rejects


def load_counts(decoded: DataFrame, fields) -> DataFrame:
    """A9 for the loader: inserted / skipped."""
    miss = missing_fields(decoded, fields)
    ok = (F.col("status") == "ok") & (F.size(miss) == 0)
    return decoded.agg(F.count_if(ok).alias("inserted"), F.count_if(~ok).alias("skipped"))
