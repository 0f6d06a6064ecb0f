"""Wire framing of a message value.

Fixed format of the schema-registry wire frame: one magic byte ``0x00``,
a 4-byte big-endian schema id, then the encoded payload.  All functions are
Column expressions (binary slicing, ``hex``/``conv``), so they stay in
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attrlake.functions.codec import to_json

MAGIC = 0
HEADER_BYTES = 5


def frame(schema_id: Column, payload: Column) -> Column:
    """Prefix ``payload`` (binary) with the 5-byte header."""
    header_id = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0"))
    return F.concat(F.unhex(F.lit("00")), header_id, payload)


def encode_json_frame(record: Column, schema_id: Column) -> Column:
    """Struct -> framed JSON payload (the JSON codec of the topic)."""
    return frame(schema_id, F.encode(to_json(record), "UTF-8"))


def payload(value: Column) -> Column:
    """Cut the header off: bytes 6.. of the value (empty if shorter)."""
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def magic_byte(value: Column) -> Column:
    """First byte as an int, NULL for an empty value."""
    first = F.substring(value, 1, 1)
    return F.when(F.length(value) >= 1, F.conv(F.hex(first), 16, 10).cast("int"))


def schema_id(value: Column) -> Column:
    """Big-endian int in bytes 2..5, NULL when the header is incomplete."""
    return F.when(
        F.length(value) >= HEADER_BYTES,
        F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint"),
    )


def damage(value: Column, key: Column) -> Column:
    """Test damage chosen by a rule on ``key``: the ways a topic value breaks.

    Per 101 keys: a tombstone, an empty value, 2 bytes, a wrong magic byte,
    a header only, a truncated payload, ``{}``, a wrongly typed id and a
    record without ``created_at``.  Every other value is left intact.
    """
    r = F.pmod(key, F.lit(101))
    header = F.substring(value, 1, HEADER_BYTES)
    body = payload(value)

    def with_body(text: Column) -> Column:
        return F.concat(header, F.encode(text, "UTF-8"))

    return (
        F.when(r == 1, F.lit(None).cast("binary"))
        .when(r == 2, F.unhex(F.lit("")))
        .when(r == 3, F.substring(value, 1, 2))
        .when(r == 4, F.concat(F.unhex(F.lit("01")), F.substring(value, 2, 2**31 - 1)))
        .when(r == 5, header)
        .when(r == 6, F.concat(header, F.substring(body, 1, 20)))
        .when(r == 7, with_body(F.lit("{}")))
        .when(r == 8, with_body(F.concat(F.lit('{"id": "x'), key.cast("string"), F.lit('"}'))))
        .when(r == 9, with_body(F.concat(F.lit('{"id": '), key.cast("string"), F.lit("}"))))
        .otherwise(value)
    )
