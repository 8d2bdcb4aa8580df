"""Exact decoding of raw records: JSON as Python reads it.

Plain records (one flat object, no escapes, whole numbers) are read by variant functions in the JVM; on these both readers
agree. Whatever the guards are not sure of goes to Python's own reader in an Arrow pass, which sees nulls for all others.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 1_000_000
# The fields of an order event, in the contract's order.
FIELDS = ("event_id", "event_type", "occurred_at", "ingested_at", "order_id", "merchant_id", "user_id", "amount_minor", "currency", "payment_method", "schema_version")
KINDS = {bool: "bool", int: "int", float: "float", str: "str", list: "list", dict: "dict", type(None): "NoneType"}
DECODED = f"malformed string, text struct<{', '.join(f'{f}: string' for f in FIELDS)}>, kind struct<{', '.join(f'{f}: string' for f in FIELDS)}>, unknown_fields array<string>, occurred_us long"
#: One object without braces, brackets, escapes or control characters in it: it ends where the text ends.
FLAT = r"^ *\{[^{}\[\]\\\x00-\x1F]*\} *$"
#: Date-times that Spark's cast reads as Python does.
PLAIN_TIME = r"^(?!0000)\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:\d\d)?$"


def _micros(text: str) -> int | None:
    try:
        t = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    t = t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)
    d = t - datetime(1970, 1, 1, tzinfo=UTC)
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def _text(value) -> str | None:
    return None if value is None else str(value).encode("utf-8", "replace").decode()


def _one(raw: bytes | None) -> tuple:
    if raw is None:
        return "record value is null (tombstone on a non-compacted topic)", None, None, None, None
    if len(raw) > MAX_BYTES:
        return f"record is {len(raw)} bytes, over the {MAX_BYTES} limit", None, None, None, None
    try:
        payload = json.loads(bytes(raw).decode("utf-8"))
    except UnicodeDecodeError as e:
        return f"record is not valid UTF-8: {e}", None, None, None, None
    except (ValueError, RecursionError) as e:
        return f"record is not valid JSON: {_text(e)}", None, None, None, None
    if not isinstance(payload, dict):
        return f"record is a JSON {type(payload).__name__}, expected an object", None, None, None, None
    text = {f: _text(payload.get(f)) for f in FIELDS}
    kind = {f: KINDS[type(payload[f])] if f in payload else None for f in FIELDS}
    at = payload.get("occurred_at")
    return None, text, kind, sorted(_text(k) for k in payload.keys() - set(FIELDS)), None if at is None else _micros(str(at))


def _decode(value: pd.Series, wanted: pd.Series) -> pd.DataFrame:
    nothing = (None,) * 5
    out = pd.DataFrame([_one(v) if w else nothing for v, w in zip(value, wanted, strict=True)], columns=["malformed", "text", "kind", "unknown_fields", "occurred_us"], dtype=object)
    return out.assign(occurred_us=out["occurred_us"].astype("Int64"))


def by_python(value: Column, wanted: Column) -> Column:
    """The decoded struct of the records that are wanted; the others' values are not sent to Python."""
    return F.pandas_udf(_decode, DECODED)(F.when(wanted, value), wanted)


def once(df: DataFrame, name: str, *columns: Column) -> DataFrame:
    """df with a struct of columns that is worked out once for each row: it comes out of a generator, which the optimizer does not
    look through, so that what refers to it often does not become a copy of it each time."""
    return df.select("*", F.explode(F.array(F.struct(*columns))).alias(name))


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """df with _d, struct(malformed, text, kind, unknown_fields, occurred_us): why the record can't be read, or its fields as text,
    their JSON kinds (null: not there), the names of other fields, and occurred_at."""
    raw, kept = F.col(value), [F.col(f"`{c}`") for c in df.columns]
    string = F.when(F.octet_length(raw) <= MAX_BYTES, raw.cast("string"))
    df = once(df, "_a", F.when(F.is_valid_utf8(string) & string.rlike(FLAT), string).alias("s"))
    df = once(df, "_b", F.try_parse_json("_a.s").alias("v"), F.json_object_keys("_a.s").alias("keys"))
    field = lambda f, kind: F.try_variant_get("_b.v", f"$.{f}", kind)
    df = once(df, "_c", F.struct(*(field(f, "string").alias(f) for f in FIELDS)).alias("text"), F.struct(*(F.schema_of_variant(field(f, "variant")).alias(f) for f in FIELDS)).alias("type"))
    kind = lambda f: F.when(F.array_contains("_b.keys", f), F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for x in ("STRING", "str", "BIGINT", "int", "VOID", "NoneType"))), F.col(f"_c.type.{f}")), F.lit("?")))
    at = F.col("_c.text.occurred_at")
    df = once(df, "_e", F.struct(*(kind(f).alias(f) for f in FIELDS)).alias("kind"), F.when(at.rlike(PLAIN_TIME), F.unix_micros(at.try_cast("timestamp"))).alias("us"))
    sure = F.col("_b.v").isNotNull() & F.col("_b.keys").isNotNull() & (at.isNull() | F.col("_e.us").isNotNull())
    for f in FIELDS:
        k = F.col(f"_e.kind.{f}")
        sure = sure & (k.isNull() | k.isin("str", "NoneType") | (k == "int") & F.col(f"_c.text.{f}").rlike(r"^(0|-?[1-9]\d*)$"))
    df = once(df, "_f", F.coalesce(sure, F.lit(False)).alias("sure"))
    fast = F.struct(F.lit(None).cast("string").alias("malformed"), F.col("_c.text").alias("text"), F.col("_e.kind").alias("kind"), F.array_sort(F.array_except("_b.keys", F.array(*map(F.lit, FIELDS)))).alias("unknown_fields"), F.col("_e.us").alias("occurred_us"))
    df = df.withColumn("_p", by_python(raw, ~F.col("_f.sure")))
    return once(df, "_g", F.when(F.col("_f.sure"), fast).otherwise(F.col("_p")).alias("d")).select(*kept, F.col("_g.d").alias("_d"))


def preview(value: Column | str, most: int = 10_000) -> Column:
    """The first characters of bytes, with replacements for what is not UTF-8."""
    return F.substring(F.coalesce(F.make_valid_utf8(F.col(value).cast("string") if isinstance(value, str) else value.cast("string")), F.lit("")), 1, most)


def decode_key(key: str = "key") -> Column:
    text = F.col(key).cast("string")
    return F.when(F.is_valid_utf8(text), text)
