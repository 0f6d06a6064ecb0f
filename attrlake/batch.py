"""Batch jobs over the lake: backfill gold from silver, compact gold.

Streaming keeps gold current; these jobs rebuild it after a fix or a
late bulk load, touching only the requested days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.streaming import pipeline as P
from attrlake.streaming.deltas import DeltaTable
from attrlake.streaming.runner import Lake


def _values(days: list[str]) -> list[tuple]:
    """Partition values of a fact's days."""
    return [(dt.date.fromisoformat(str(d)),) for d in days]


def _days(df: DataFrame, days: list[str] | None) -> DataFrame:
    if days is None:
        return df
    return df.where(F.col("event_date").isin(*[F.lit(d).cast("date") for d in days]))


def rebuild_facts(lake: Lake, days: list[str] | None = None) -> None:
    """Recompute every daily fact for ``days`` (all days if None) from silver
    and replace exactly those partitions, also the ones left without a row."""
    silver = _days(lake.silver.read(), days)
    values = _values(days) if days is not None else None
    if values == []:
        return
    for name, (fn, _keys) in A.FACTS.items():
        table, parts = lake.fact(name), lake.parts(name)
        if parts is not None:
            # The parts first: a day that the fact holds has complete ones.
            stale = [v for d in parts.days() if values is None or (d,) in values for v in parts.below((d,))]
            parts.replace_partitions(A.fact_parts(silver, name), stale)
        every = values
        if every is None and table.exists():
            every = table.touched_values(table.read())
        table.replace_partitions(fn(silver), every)


def rebuild_dimensions(lake: Lake) -> None:
    """Recompute both dimensions from the whole of silver (latest wins)."""
    silver = lake.silver.read()
    for name, (key, attributes) in D.DIMENSIONS.items():
        table, rows = lake.dim(name), D.latest_attributes(silver, key, attributes)
        if isinstance(table, DeltaTable):
            table.rebuild(rows)
        else:
            table.replace_partitions(P.bucketed(rows, key, table.buckets))


def compact_keyed(lake: Lake) -> None:
    """Fold the deltas of every keyed table into its base (nothing to do for
    bucketed tables)."""
    for table in (lake.current, *[lake.dim(name) for name in D.DIMENSIONS]):
        if isinstance(table, DeltaTable):
            table.compact()


def compact_gold(lake: Lake, name: str, days: list[str]) -> None:
    """Rewrite the given days of a gold fact into few, large files (no days,
    nothing done).  Gold is never a streaming source, so rewriting it in place
    is safe (silver and bronze are: compact those only into a new location)."""
    lake.fact(name).compact(_values(days))
