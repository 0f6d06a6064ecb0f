"""Keyed tables that are only ever appended to.

``LakeTable.upsert`` rewrites every hash bucket that holds an updated key; a
batch of random keys touches all of them, so each batch rewrites the table.
Here a batch costs its own size: its folded rows are one more delta folder.
A read folds the base and its deltas by key, with the fold the batch form uses
anyway (``max_by`` on an order column): associative, and idempotent, so a
delta that is there twice changes nothing.  Only base rows whose key some
delta holds go through the fold; the others are passed on without a shuffle.

    <location>/delta/<name>                    one micro-batch each
    <location>/base/generation=<n>             what compaction n left
    <location>/included/generation=<n>         names of the deltas it folded in

Compaction writes the next generation beside the present one.  A base counts
once its ``_SUCCESS`` marker is there, written last, so a run that dies leaves
the old generation in force.  Folders that a generation replaces are deleted
only by the compaction after it: a query that began before still finds its
files.  One compaction at a time; appends may go on meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrlake.operators import dims as D
from attrlake.operators import silver as S
from attrlake.store import _children, _delete

Fold = Callable[[DataFrame], DataFrame]
DONE = "_SUCCESS"


@dataclass
class DeltaTable:
    spark: SparkSession
    location: str
    key: str
    fold: Fold                       # rows of any number per key -> one row per key, same columns
    compact_every: int | None = 64   # deltas after which an append compacts; None: never

    def _path(self, *parts: str) -> str:
        return "/".join([self.location.rstrip("/"), *parts])

    # -- what is there -----------------------------------------------------
    def generation(self) -> int:
        """The newest complete base; 0 if there is none."""
        found = [int(c.split("=")[1]) for c in _children(self.spark, self._path("base")) if c.startswith("generation=")]
        return next((g for g in sorted(found, reverse=True)
                     if DONE in _children(self.spark, self._path("base", f"generation={g}"))), 0)

    def _included(self, generation: int) -> set[str]:
        if not generation:
            return set()
        return {r.name for r in self.spark.read.schema("name string").json(self._path("included", f"generation={generation}")).collect()}

    def deltas(self, generation: int | None = None) -> list[str]:
        """Complete deltas that the base does not hold, oldest first."""
        held = self._included(self.generation() if generation is None else generation)
        names = [c for c in _children(self.spark, self._path("delta")) if c not in held]
        return sorted(n for n in names if DONE in _children(self.spark, self._path("delta", n)))

    def exists(self) -> bool:
        return bool(self.generation() or self.deltas())

    # -- reads -------------------------------------------------------------
    def _read(self, schema: T.StructType | None, *paths: str) -> DataFrame:
        return (self.spark.read.schema(schema) if schema is not None else self.spark.read).parquet(*paths)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """One row per key, folded over base and deltas."""
        generation = self.generation()
        names = self.deltas(generation)
        base = self._read(schema, self._path("base", f"generation={generation}")) if generation else None
        if not names:
            if base is None:
                if schema is None:
                    raise FileNotFoundError(self.location)
                return self.spark.createDataFrame([], schema)
            return base
        changes = self._read(schema, *[self._path("delta", n) for n in names])
        if base is None:
            return self.fold(changes)
        changes = self.fold(changes)
        # AQE broadcasts these keys where they are few, by their measured size;
        # the base is not shuffled then.
        keys = changes.select(F.col(self.key).alias("_k"))
        mine = base[self.key].eqNullSafe(keys["_k"])
        changed = base.join(keys, mine, "left_semi").select(changes.columns).unionByName(changes)
        return base.join(keys, mine, "left_anti").select(changes.columns).unionByName(self.fold(changed))

    # -- writes ------------------------------------------------------------
    def append(self, rows: DataFrame, batch_id: int = 0) -> None:
        """One more delta: the folded ``rows``.  No file that is there is
        read or written again.  A batch that is replayed adds a second delta
        of the same rows, which folds away."""
        name = f"{batch_id:012d}-{uuid.uuid4().hex[:12]}"
        self.fold(rows).write.parquet(self._path("delta", name))
        if self.compact_every and len(self.deltas()) >= self.compact_every:
            self.compact()

    def compact(self) -> int:
        """Fold the deltas into a base of the next generation; its number."""
        old = self.generation()
        names = self.deltas(old)
        if not names:
            return old
        new = old + 1
        folded = self.read()
        if folded.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true":
            folded = folded.hint("rebalance", self.key)
        every = [(n,) for n in [*names, *self._listed(old)]]
        self.spark.createDataFrame(every, "name string").coalesce(1).write.mode("overwrite").json(
            self._path("included", f"generation={new}"))
        folded.write.mode("overwrite").parquet(self._path("base", f"generation={new}"))
        self._retire(old)
        return new

    def _listed(self, generation: int) -> list[str]:
        """Deltas that an earlier compaction folded in and that still lie there."""
        held = self._included(generation)
        return [c for c in _children(self.spark, self._path("delta")) if c in held]

    def _retire(self, generation: int) -> None:
        """Delete what ``generation`` had replaced: the base before it and the
        deltas it folded in."""
        if not generation:
            return
        for name in self._listed(generation):
            _delete(self.spark, self._path("delta", name))
        for folder in ("base", "included"):
            for c in _children(self.spark, self._path(folder)):
                if c.startswith("generation=") and int(c.split("=")[1]) < generation:
                    _delete(self.spark, self._path(folder, c))

    def rebuild(self, rows: DataFrame) -> None:
        """Make the table hold ``rows`` (one per key) and nothing else."""
        old = self.generation()
        every = [(c,) for c in _children(self.spark, self._path("delta"))]
        self.spark.createDataFrame(every, "name string").coalesce(1).write.mode("overwrite").json(
            self._path("included", f"generation={old + 1}"))
        rows.write.mode("overwrite").parquet(self._path("base", f"generation={old + 1}"))
        self._retire(old)


def current_state_table(spark: SparkSession, location: str, key: str = "id", order: str = "lsn",
                        compact_every: int | None = 64) -> DeltaTable:
    """ST4b: latest change per key, delete markers kept."""
    return DeltaTable(spark, location, key, lambda df: S.latest_changes(df, key, order), compact_every)


def dimension_table(spark: SparkSession, location: str, name: str, compact_every: int | None = 64) -> DeltaTable:
    """K3/K4: newest attributes per key."""
    key, attributes = D.DIMENSIONS[name]
    return DeltaTable(spark, location, key, lambda df: D.fold_dimension(df, key, attributes), compact_every)
