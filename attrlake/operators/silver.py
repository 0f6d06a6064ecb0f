"""Silver: conform types, normalise timestamps, remove redeliveries.

``conform`` is map-only.  The two de-duplications are single aggregations
keyed by ``id``; both are partial (map-side) aggregates, so even an id that
was redelivered a billion times collapses to one row per map task before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrlake.functions.time import event_date_from_micros, micros_to_ntz
from attrlake.schemas import silver_schema


def _conform_column(src: Column, src_type: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.TimestampNTZType):
        if isinstance(src_type, (T.LongType, T.IntegerType)):
            return micros_to_ntz(src)
        if isinstance(src_type, T.TimestampNTZType):
            return src
        return src.try_cast(target)
    if src_type == target:
        return src
    return src.try_cast(target)


def conform(bronze: DataFrame, with_errors: bool = False) -> DataFrame:
    """Every column to its silver type.

    Numbers/strings are ``try_cast`` (a value that does not fit becomes NULL
    instead of failing the batch under ANSI mode); epoch-micros timestamps
    become ``TIMESTAMP_NTZ`` with the same wall clock.  ``event_date`` is kept
    from bronze or derived from ``created_at`` micros.  With
    ``with_errors=True`` a ``cast_errors`` column counts, per row, the
    values that were set but did not convert.
    """
    types = {f.name: f.dataType for f in bronze.schema.fields}
    target = silver_schema()
    cols = []
    for f in target.fields:
        if f.name == "event_date":
            continue
        if f.name in types:
            src = F.col(f.name)
            out = _conform_column(src, types[f.name], f.dataType)
        else:
            out = F.lit(None).cast(f.dataType)
        cols.append(out.alias(f.name))
    if "event_date" in types:
        cols.append(F.col("event_date").cast("date").alias("event_date"))
    else:
        cols.append(event_date_from_micros(F.col("created_at")).alias("event_date"))
    if with_errors:
        cols.append(cast_errors(bronze).cast("int").alias("cast_errors"))
    return bronze.select(*cols)


def cast_errors(bronze: DataFrame) -> Column:
    """Per bronze row, how many set values ``conform`` would lose."""
    types = {f.name: f.dataType for f in bronze.schema.fields}
    lost = [(F.col(f.name).isNotNull() & _conform_column(F.col(f.name), types[f.name], f.dataType).isNull()).cast("int")
            for f in silver_schema().fields if f.name in types and f.name != "event_date" and types[f.name] != f.dataType]
    return sum(lost[1:], lost[0]) if lost else F.lit(0)


ARRIVAL = ["source_partition", "source_offset"]


def dedupe_first(df: DataFrame, key: str = "id") -> DataFrame:
    """ST4a: one row per ``key``, the first arrival.

    With the topic position of bronze rows, the copy with the lowest
    ``(source_partition, source_offset)`` wins: a deterministic first
    arrival even if copies differ.  Without it (a source that kept no
    position), any copy is kept, which is right for redeliveries of one
    record.  Either way one partial aggregation; the streaming form also
    drops ids an earlier micro-batch already put in silver.
    """
    if not all(c in df.columns for c in ARRIVAL):
        return df.dropDuplicates([key])
    values = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in values]), F.struct(*[F.col(c) for c in ARRIVAL])).alias("_first")
    )
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in values])


def current_state(changes: DataFrame, key: str = "id", order: str = "lsn", op_col: str = "op") -> DataFrame:
    """ST4b: last state per key by log position; deleted keys removed.

    One partial aggregation (``latest_changes``), then drop keys whose last
    change is a delete.
    """
    return latest_changes(changes, key, order).where(F.col(op_col) != "d")


def latest_changes(changes: DataFrame, key: str = "id", order: str = "lsn") -> DataFrame:
    """Newest change per key, delete markers kept (the fold of ST4b that a
    stream applies batch by batch: an older change arriving later cannot
    bring a deleted key back)."""
    value_cols = [c for c in changes.columns if c != key]
    latest = changes.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order)).alias("_last")
    )
    return latest.select(key, *[F.col(f"_last.{c}").alias(c) for c in value_cols])
