"""Change envelopes: classification and decoding with built-in functions.

The text is parsed once, as a one-element array, so that text after the value is an error. An
absent key is told from a JSON null by VARIANT paths. Field texts keep their key order. Two kinds
of text that a lenient parser takes, NaN or Infinity and repeated keys, are errors unless
strict_compat is set, which decodes with an Arrow function instead.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARSE_ERROR = "EnvelopeParseError"
#: Epoch milliseconds of the years 1 to 9999.
LEAST_MS, MOST_MS = -62135596800000, 253402300799999
FIELDS = ["operation", "before", "after", "source_timestamp", "source_lsn", "transaction_id", "parse_error_type", "parse_error_message"]


def event_id(topic: Column, partition: Column, offset: Column) -> Column:
    """The record's lasting key: SHA-256 of topic|partition|offset."""
    return F.sha2(F.concat_ws("|", topic, partition.cast("string"), offset.cast("string")), 256)


def _falsy(x: Column, schema: Column) -> Column:
    empty = F.to_json(x).isin("[]", "{}", '""', "0", "0.0", "-0", "-0.0", "false")
    return x.isNull() | (schema == "VOID") | F.coalesce(empty, F.lit(False))


def decode(df: DataFrame, value: str = "value_str") -> DataFrame:
    """df with FIELDS. parse_error_type is null for a good envelope, and then only it and the message are null by need."""
    path = lambda x, p: F.try_variant_get(x, p, "variant")
    df = df.withColumn("_doc", F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]"))))
    df = df.withColumns({"_e": path(F.col("_doc"), "$[0]"), "_more": path(F.col("_doc"), "$[1]")})
    e = F.col("_e")
    df = df.withColumns({"_source": path(e, "$.source"), "_tx": path(e, "$.transaction"), "_op": path(e, "$.op"), "_before": path(e, "$.before"), "_after": path(e, "$.after"), "_kind": F.schema_of_variant(e)})
    df = df.withColumns({"_source_kind": F.schema_of_variant("_source"), "_tx_kind": F.schema_of_variant("_tx")})
    source_falsy, tx_falsy = _falsy(F.col("_source"), F.col("_source_kind")), _falsy(F.col("_tx"), F.col("_tx_kind"))
    is_object = lambda kind: F.col(kind).startswith("OBJECT")
    df = df.withColumns({"_ts": F.when(is_object("_source_kind"), path(F.col("_source"), "$.ts_ms")), "_lsn": F.when(is_object("_source_kind"), path(F.col("_source"), "$.lsn")), "_txid": F.when(is_object("_tx_kind"), path(F.col("_tx"), "$.id"))})
    ts_kind = F.schema_of_variant("_ts")
    ts_given = F.col("_ts").isNotNull() & (ts_kind != "VOID")
    ts_number = ts_kind.isin("BIGINT", "BOOLEAN", "DOUBLE") | ts_kind.startswith("DECIMAL")
    ms = F.when(ts_kind == "BOOLEAN", F.try_variant_get("_ts", "$", "boolean").cast("double")).otherwise(F.try_variant_get("_ts", "$", "double"))
    whole = F.when(ts_kind == "BIGINT", F.try_variant_get("_ts", "$", "bigint")).otherwise(F.floor(ms).cast("bigint"))
    error = (
        F.when(F.col(value).isNull(), F.lit("value is null"))
        .when(F.col("_doc").isNull() | F.col("_more").isNotNull() | e.isNull(), F.lit("invalid JSON"))
        .when(~is_object("_kind"), F.lit("envelope is not a JSON object"))
        .when(F.col("_op").isNull(), F.lit("missing required field 'op'"))
        .when(F.col("_source").isNull(), F.lit("missing required field 'source'"))
    )
    kind = (
        F.when(error.isNotNull(), F.lit(PARSE_ERROR))
        .when(~source_falsy & ~is_object("_source_kind"), F.lit("AttributeError"))
        .when(ts_given & ~ts_number, F.lit("TypeError"))
        .when(ts_given & ~ms.between(LEAST_MS, MOST_MS), F.lit("ValueError"))
        .when(~tx_falsy & ~is_object("_tx_kind"), F.lit("AttributeError"))
    )
    # Through a generator of one row each: a filter on the verdict is not pushed below it, which would parse again.
    verdict = F.struct(kind.alias("parse_error_type"), error.alias("_error"))
    df = df.select("*", F.inline(F.array(verdict))).withColumn("parse_error_message", error_or(F.col("_error"), F.col("parse_error_type"))).drop("_error")
    good = F.col("parse_error_type").isNull()
    lsn = F.when(F.schema_of_variant("_lsn") == "BIGINT", F.try_variant_get("_lsn", "$", "bigint"))
    text = lambda name, p: F.when(good & (F.schema_of_variant(name) != "VOID"), F.get_json_object(value, p))
    df = df.withColumns({
        "operation": F.when(good, F.get_json_object(value, "$.op")),
        "before": text("_before", "$.before"),
        "after": text("_after", "$.after"),
        "source_timestamp": F.when(good & ts_given, F.timestamp_millis(whole)),
        "source_lsn": F.when(good, lsn),
        "transaction_id": F.when(good & is_object("_tx_kind"), F.get_json_object(value, "$.transaction.id")),
    })
    return df.drop("_doc", "_e", "_more", "_source", "_tx", "_op", "_before", "_after", "_kind", "_source_kind", "_tx_kind", "_ts", "_lsn", "_txid")


def error_or(error: Column, kind: Column) -> Column:
    return F.when(kind.isNotNull(), F.coalesce(error, F.concat(F.lit("envelope has a field of the wrong kind or range: "), kind)))


def decode_compat(df: DataFrame, value: str = "value_str") -> DataFrame:
    """decode() by a lenient JSON parser, for NaN, Infinity and repeated keys; an Arrow function."""
    @F.pandas_udf("operation string, before string, after string, source_timestamp timestamp, source_lsn bigint, transaction_id string, parse_error_type string, parse_error_message string")
    def fields(values: pd.Series) -> pd.DataFrame:
        rows = [lenient(v) for v in values]
        out = pd.DataFrame(rows, columns=FIELDS, dtype=object)
        out["source_timestamp"] = pd.to_datetime(out["source_timestamp"], utc=True)
        out["source_lsn"] = out["source_lsn"].astype("Int64")
        return out

    return df.withColumn("_f", fields(F.col(value))).select(*[c for c in df.columns if c not in FIELDS], "_f.*")


def lenient(text: str | None) -> tuple:
    """One envelope's FIELDS."""
    import datetime
    import json

    def wrong(kind: str, message: str) -> tuple:
        return (None,) * 6 + (kind, message)

    if text is None:
        return wrong(PARSE_ERROR, "value is null")
    try:
        found = json.loads(text)
    except ValueError:
        return wrong(PARSE_ERROR, "invalid JSON")
    if not isinstance(found, dict):
        return wrong(PARSE_ERROR, "envelope is not a JSON object")
    for name in ("op", "source"):
        if name not in found:
            return wrong(PARSE_ERROR, f"missing required field '{name}'")
    say = lambda x: x if isinstance(x, str) or x is None else json.dumps(x)
    given = lambda x: None if x is None else json.dumps(x)
    source, tx = found["source"] or {}, found.get("transaction") or {}
    odd = lambda kind: wrong(kind, f"envelope has a field of the wrong kind or range: {kind}")
    if not isinstance(source, dict) or not isinstance(tx, dict):
        return odd("AttributeError")
    ms, when = source.get("ts_ms"), None
    if ms is not None:
        if not isinstance(ms, int | float):
            return odd("TypeError")
        if not LEAST_MS <= ms <= MOST_MS:
            return odd("ValueError")
        when = datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(milliseconds=ms)
    lsn = source.get("lsn")
    lsn = lsn if isinstance(lsn, int) and not isinstance(lsn, bool) and abs(lsn) < 1 << 63 else None
    return (say(found["op"]), given(found.get("before")), given(found.get("after")), when, lsn, say(tx.get("id")), None, None)
