"""Bronze: framed messages -> flat event rows with a partition day.

Every function is ``DataFrame -> DataFrame`` and map-only (no shuffle), so
it runs unchanged on a batch scan of the topic and inside a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrlake.functions import codec as C
from attrlake.functions import framing
from attrlake.functions.time import event_date_from_micros
from attrlake.schemas import bronze_schema

DECODED = "_decoded"


def with_event_date(df: DataFrame, micros_col: str = "created_at") -> DataFrame:
    """Partition day of ``created_at`` (epoch micros, wall clock)."""
    return df.withColumn("event_date", event_date_from_micros(micros_col))


def frame_header(messages: DataFrame) -> DataFrame:
    """What the header strip throws away, per message (for routing)."""
    v = F.col("value")
    return messages.select(
        "key",
        framing.magic_byte(v).alias("magic_byte"),
        framing.schema_id(v).alias("schema_id"),
        F.greatest(F.length(v) - framing.HEADER_BYTES, F.lit(0)).alias("payload_bytes"),
    )


def _reader(schema: T.StructType | str | None, codec: str) -> tuple[T.StructType | str, T.StructType]:
    """What the codec decodes with and the flat columns that come out: for
    ``avro`` an Avro schema string and the columns derived from it."""
    if codec != "avro":
        return schema or bronze_schema(), schema or bronze_schema()
    if not isinstance(schema, str):
        raise TypeError("the avro codec takes an Avro schema string (see codec.registry_schema_string)")
    return schema, C.avro_columns(schema)


def _decoded_once(messages: DataFrame, schema: T.StructType | str, codec: str) -> DataFrame:
    """Decode as the output of a one-element ``explode``.

    The routing predicates test the decoded struct several times; a filter
    on them would otherwise be pushed below the decode and inline the parse
    into every test.  Predicates on a generator's output stay above it, so
    each payload is parsed exactly once.
    """
    payload = C.decode(framing.payload(F.col("value")), schema, codec)
    return messages.select("*", F.explode(F.array(payload)).alias(DECODED))


def decode_messages(
    messages: DataFrame,
    schema: T.StructType | str | None = None,
    codec: str = "json",
) -> DataFrame:
    """Strip the header, decode with one fixed schema, flatten, add
    ``event_date``.  Tombstones (NULL or empty values) are dropped; for input that may
    hold damaged messages use ``route_messages`` + ``good_records``, which
    set them aside instead of letting them through as NULL rows."""
    reader, columns = _reader(schema, codec)
    # A NULL or empty value decodes to NULL; filtering on the decoded struct
    # (above the decode barrier) drops it without re-running the decode.
    decoded = _decoded_once(messages, reader, codec).where(F.col(DECODED).isNotNull())
    flat = decoded.select(*[F.col(f"{DECODED}.{f.name}").alias(f.name) for f in columns.fields])
    return with_event_date(flat)


# Reasons a message is set aside, in the order they are tested.
REASONS = ["tombstone", "short_value", "bad_magic", "undecodable", "null_id", "null_created_at"]


def route_messages(
    messages: DataFrame,
    schema: T.StructType | str | None = None,
    codec: str = "json",
) -> DataFrame:
    """P10: one decode, every message labelled.

    Adds ``reason`` (NULL for a good record, else one of ``REASONS``) next to
    the flattened record and ``event_date``.  ``stored_messages`` is the form
    that one sink writes, good, damaged and tombstones alike.
    """
    reader, columns = _reader(schema, codec)
    v = F.col("value")
    d = F.col(DECODED)
    reason: Column = (
        F.when(v.isNull(), "tombstone")
        .when(F.length(v) <= framing.HEADER_BYTES, "short_value")
        .when(framing.magic_byte(v) != framing.MAGIC, "bad_magic")
        .when(C.is_corrupt(d, codec, columns.names), "undecodable")
        .when(d["id"].isNull(), "null_id")
        .when(d["created_at"].isNull(), "null_created_at")
    )
    decoded = _decoded_once(messages, reader, codec)
    out = decoded.select(
        "key", "value", "topic", "partition", "offset",
        reason.alias("reason"),
        *[d[f.name].alias(f.name) for f in columns.fields],
    )
    return with_event_date(out)


# Where a bronze row was read from: its topic partition and offset.  Copies
# of one key share a partition (the topic is keyed by id), so the lowest
# offset is the first arrival.
LINEAGE = ["source_partition", "source_offset"]


def good_records(routed: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The bronze rows of a routed frame: 55 columns, ``event_date`` and the
    topic position (``LINEAGE``)."""
    schema = schema or bronze_schema()
    return routed.where(F.col("reason").isNull()).select(
        *[f.name for f in schema.fields], "event_date",
        F.col("partition").cast("int").alias("source_partition"), F.col("offset").cast("bigint").alias("source_offset"),
    )


# ``reason`` of a good row in the stored message table.
GOOD = "good"
# What a stored message adds to a bronze row: kept only where it is not good.
RAW = ["key", "value", "topic"]


def stored_messages(routed: DataFrame) -> DataFrame:
    """Every message as one table stores it, so that the topic is read and
    decoded once: the bronze columns, ``reason`` (``GOOD`` for a good record)
    and, where it is not good, the raw message.  Bronze, quarantine and the
    count of tombstones are reads of its ``reason`` partitions."""
    good = F.col("reason").isNull()
    columns = [c for c in routed.columns if c not in (*RAW, "partition", "offset", "reason")]
    return routed.select(
        *columns,
        F.col("partition").cast("int").alias("source_partition"), F.col("offset").cast("bigint").alias("source_offset"),
        *[F.when(~good, F.col(c)).alias(f"raw_{c}") for c in RAW],
        F.coalesce("reason", F.lit(GOOD)).alias("reason"),
    )


def quarantined(routed: DataFrame) -> DataFrame:
    """Messages set aside: the raw value (to repair and replay), where it came
    from and why."""
    return routed.where(F.col("reason").isNotNull() & (F.col("reason") != "tombstone")).select(
        "key", "value", "topic", "partition", "offset", "reason"
    )


# CDC envelope ---------------------------------------------------------------

def envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row, True),
        T.StructField("after", row, True),
        T.StructField("op", T.StringType(), True),
        T.StructField("ts_ms", T.LongType(), True),
        T.StructField("source", T.StructType([T.StructField("lsn", T.LongType(), True)]), True),
    ])


def unwrap_changes(envelopes: DataFrame, row: T.StructType, key: str = "id", codec: str = "json") -> DataFrame:
    """P5: new row state of each change, done in Spark.

    ``c``/``r``/``u`` -> the after-image; ``d`` -> a delete marker carrying the
    key from the before-image; a NULL value (tombstone) or an envelope with
    neither image is dropped.  ``op`` and the log position ``lsn`` are kept so
    silver can order changes of one key.
    """
    env = C.decode(framing.payload(F.col("value")), envelope_schema(row), codec)
    # Decode once (see ``_decoded_once``); a NULL value decodes to NULL and
    # is dropped with the envelopes that carry neither image.
    e = envelopes.select(F.explode(F.array(env)).alias("e"))
    e = e.where(F.col("e.after").isNotNull() | F.col("e.before").isNotNull())
    cols = [
        F.col("e.op").alias("op"),
        F.coalesce(F.col(f"e.after.{key}"), F.col(f"e.before.{key}")).alias(key),
    ]
    cols += [F.col(f"e.after.{f.name}").alias(f.name) for f in row.fields if f.name != key]
    cols.append(F.col("e.source.lsn").alias("lsn"))
    return e.select(*cols)


def route_family(df: DataFrame, kind: str | list[str]) -> DataFrame:
    """Rows of one event family (a plain comparison, pushed to the scan)."""
    kinds = [kind] if isinstance(kind, str) else kind
    return df.where(F.col("activity_kind").isin(*kinds))
