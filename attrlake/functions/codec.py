"""Payload codecs: Avro (``from_avro``, needs the spark-avro package on the
class path) or JSON (``from_json``, built in).

Both return one struct column; a payload that cannot be decoded is told
apart from a good one so the caller can quarantine it instead of failing the
whole micro-batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_FIELD = "_corrupt_record"
# Fixed format: JSON timestamps carry all six fraction digits, so a
# round trip through the JSON codec is lossless.
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def to_json(record: Column) -> Column:
    """Struct -> JSON text with lossless timestamps."""
    return F.to_json(record, JSON_OPTIONS)


def with_corrupt_field(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_FIELD, T.StringType(), True)])


def decode(payload: Column, schema: T.StructType | str, codec: str = "json",
           mode: str = "PERMISSIVE") -> Column:
    """Decode a binary payload into a struct.

    ``json``: permissive parse; malformed or wrongly typed input keeps the raw
    text in ``_corrupt_record`` (an extra field), an empty payload gives NULL.
    ``avro``: ``from_avro`` with ``schema`` as an Avro schema string; a bad
    record gives a row of NULLs.  ``mode="FAILFAST"`` makes a bad record fail the query
    instead (``from_avro``'s own default) -- the pipeline routes bad records
    to quarantine, so it decodes permissively.
    """
    if codec == "json":
        if not isinstance(schema, T.StructType):
            raise TypeError("the json codec takes a StructType")
        text = F.decode(payload, "UTF-8")
        return F.from_json(
            F.when(F.length(payload) > 0, text),
            with_corrupt_field(schema),
            {"mode": mode, "columnNameOfCorruptRecord": CORRUPT_FIELD, **JSON_OPTIONS},
        )
    if codec == "avro":
        try:
            from pyspark.sql.avro.functions import from_avro
        except ImportError as exc:  # pragma: no cover - depends on the install
            raise RuntimeError("the avro codec needs pyspark's avro functions") from exc
        return from_avro(payload, schema, {"mode": mode})
    raise ValueError(f"unknown codec {codec!r}")


def is_corrupt(decoded: Column, codec: str = "json", fields: list[str] | None = None) -> Column:
    """True where the payload did not decode into a record.

    A damaged Avro record comes back as NULL or, permissively, as a row whose
    ``fields`` are all NULL; no event has neither id nor any other value.
    """
    if codec == "json":
        return decoded.isNull() | decoded[CORRUPT_FIELD].isNotNull()
    empty = reduce(lambda a, b: a & b, [decoded[f].isNull() for f in fields or []], F.lit(bool(fields)))
    return decoded.isNull() | empty


# Avro type names and the column types they decode to (fixed by the format).
AVRO_PRIMITIVES = {
    "null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(),
}


def avro_columns(schema: str) -> T.StructType:
    """The flat columns that an Avro record schema (JSON text) decodes to:
    primitive fields, alone or in a union with null.  Logical types and nested
    fields are refused, so a registry change can't alter a column unnoticed."""
    import json

    columns = []
    for field in json.loads(schema)["fields"]:
        union = field["type"] if isinstance(field["type"], list) else [field["type"]]
        kinds = [k["type"] if isinstance(k, dict) and set(k) <= {"type", "avro.java.string", "connect.type", "connect.default"}
                 else k for k in union]
        named = [k for k in kinds if k != "null"]
        if len(named) != 1 or not isinstance(named[0], str) or named[0] not in AVRO_PRIMITIVES:
            raise ValueError(f"field {field['name']!r} has no flat column type: {field['type']!r}")
        columns.append(T.StructField(field["name"], AVRO_PRIMITIVES[named[0]], "null" in kinds))
    return T.StructType(columns)


def registry_schema_string(registry_url: str, subject: str, timeout: float = 30.0) -> str:
    """The latest schema registered under ``subject`` (e.g.
    ``<topic>-value``), fetched once on the driver when a job starts.  An
    HTTP error raises.  Old messages are then decoded with this newest
    schema, so a breaking schema change needs a restart."""
    import json
    import urllib.request

    url = f"{registry_url.rstrip('/')}/subjects/{subject}/versions/latest"
    with urllib.request.urlopen(url, timeout=timeout) as resp:  # noqa: S310 - configured URL
        return json.loads(resp.read().decode("utf-8"))["schema"]
