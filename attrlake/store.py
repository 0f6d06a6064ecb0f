"""Lake tables: append, read, stream-read, partition replace, keyed upsert
and insert-new-only.

Two back ends behind one small class:

* **iceberg** -- a catalog table; upsert is ``MERGE INTO`` (needs the Iceberg
  runtime and a configured catalog, not available in the test container);
* **parquet** -- a partitioned folder.  A write touches only what a batch
  needs: the batch's distinct partition values (days or hash buckets, never
  rows) choose the partition folders that are listed and read; keys the
  table does not hold are appended as new files; partitions holding an
  updated key are rewritten from a staged copy under the shared folder, then
  replaced with a dynamic partition overwrite.  Every step is idempotent, so
  a replayed micro-batch leaves the same table.  Single writer; not atomic
  across partitions (that is what Iceberg is for).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from functools import reduce
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrlake.session import shared_dir

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def _local(path: str) -> str | None:
    """The local path of a ``file:`` URI (or a bare path), else None."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if "://" not in path else None


def _has_jvm(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jvm is not None  # noqa: SLF001
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM gateway in this process
        return False


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (one level, no recursion)."""
    if not _has_jvm(spark) and _local(path) is not None:
        local = _local(path)
        return os.listdir(local) if os.path.isdir(local) else []
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds data (ignoring ``_``/``.`` entries)."""
    if not _has_jvm(spark) and _local(path) is not None:
        local = _local(path)
        return os.path.isdir(local) and any(not n.startswith(("_", ".")) for n in os.listdir(local))
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem via the JVM gateway
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return fs.exists(p) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)
    )


def _delete(spark: SparkSession, path: str) -> None:
    """Remove one folder of a table.  Data that ought to go must not stay
    unseen, so this raises where the file system can't be reached."""
    if not _has_jvm(spark):
        raise RuntimeError(f"{path} can't be removed without a JVM in this process")
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.delete(p, True) and fs.exists(p):
        raise RuntimeError(f"{path} could not be removed")


def _discard(spark: SparkSession, path: str) -> None:
    """Remove a staged copy; one that stays costs only room (a TTL on
    ``staging/`` clears it)."""
    if _has_jvm(spark):
        _delete(spark, path)


@dataclass
class LakeTable:
    spark: SparkSession
    location: str  # directory (parquet) or catalog identifier (iceberg)
    partition_by: list[str] = field(default_factory=list)
    fmt: str = "parquet"
    # Files per partition and write when AQE is off (streaming micro-batches):
    # rows are grouped by the partition columns plus a deterministic salt, so
    # a day gets about this many files per batch and a hot day is still
    # written by this many tasks.  None: write map-side (one file per task).
    files_per_partition: int | None = None
    # Hash buckets of a keyed table partitioned by ``bucket`` (dimensions,
    # current state).  A property of the table: change it only by rebuilding.
    buckets: int | None = None
    # A table that is part of a larger one: the condition on its rows (on
    # partition columns, so reads are pruned) and its columns (None: all).
    rows: str | None = None
    columns: list[str] | None = None

    # -- reads -------------------------------------------------------------
    def exists(self) -> bool:
        if self.fmt == "iceberg":
            return self.spark.catalog.tableExists(self.location)
        return _exists(self.spark, self.location)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        if self.fmt == "iceberg":
            return self._part(self.spark.table(self.location))
        if not self.exists():
            if schema is None:
                raise FileNotFoundError(self.location)
            return self.spark.createDataFrame([], schema)
        return self._part(self.spark.read.parquet(self.location))

    def _part(self, df: DataFrame) -> DataFrame:
        if self.rows:
            df = df.where(self.rows)
        return df.selectExpr(*self.columns) if self.columns else df

    def read_stream(self, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
        """S3: the table as a streaming source (append-only tables only)."""
        if self.fmt == "iceberg":
            return self._part(self.spark.readStream.format("iceberg").load(self.location))
        reader = self.spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return self._part(reader.parquet(self.location))

    # -- writes ------------------------------------------------------------
    def _writer(self, df: DataFrame):
        if not self.partition_by:
            return df.write
        aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
        if aqe:
            # Rebalance on the partition columns: AQE merges small output
            # partitions and splits a hot day, so neither tiny files nor one
            # giant task come out of a write.
            df = df.hint("rebalance", *self.partition_by)
        elif self.files_per_partition:
            salt = F.pmod(F.spark_partition_id(), F.lit(self.files_per_partition))
            df = df.repartition(*[F.col(c) for c in self.partition_by], salt)
        return df.write.partitionBy(*self.partition_by)

    def append(self, df: DataFrame) -> None:
        if self.fmt == "iceberg":
            df.writeTo(self.location).append() if self.exists() else self._create(df)
            return
        if self.logged():
            raise ValueError(f"{self.location} is written by a file sink: rows beside its log would not be read")
        self._writer(df).mode("append").parquet(self.location)

    def _create(self, df: DataFrame) -> None:
        w = df.writeTo(self.location).using("iceberg")
        if self.partition_by:
            w = w.partitionedBy(*[F.col(c) for c in self.partition_by])
        w.create()

    def replace_partitions(self, df: DataFrame, values: list | None = None) -> None:
        """Overwrite the partitions present in ``df``, and also those of
        ``values`` (partition-value rows) that ``df`` has no row for: they
        end up empty."""
        if self.fmt == "iceberg":
            if not self.exists():
                self._create(df)
            elif values:
                df.writeTo(self.location).overwrite(self._among(values))
            else:
                df.writeTo(self.location).overwritePartitions()
            return
        gone = []
        if values:
            # Read before the write: ``df`` may come from the folders it replaces.
            kept = {tuple(r) for r in df.select(*self.partition_by).distinct().collect()}
            gone = [d for v in values if tuple(v) not in kept and (d := self._partition_dir(v)) is not None]
        (self._writer(df).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(self.location))
        for d in gone:
            _delete(self.spark, f"{self.location.rstrip('/')}/{d}")

    def logged(self) -> bool:
        """Whether a streaming file sink writes the folder: its commit log
        then says which files are rows, not a listing."""
        return self.fmt == "parquet" and _exists(self.spark, f"{self.location.rstrip('/')}/_spark_metadata")

    def _among(self, values: list):
        """Null-safe condition: the row lies in a partition of ``values``."""
        return reduce(lambda a, b: a | b, [
            reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(self.partition_by, row)])
            for row in values
        ])

    def touched_values(self, batch: DataFrame) -> list:
        """Distinct partition values of ``batch`` (days or buckets, never rows)."""
        return batch.select(*self.partition_by).distinct().collect()

    def _partition_dir(self, row) -> str | None:
        """``col=value/...`` folder of one partition; None for value types
        whose folder name needs escaping (then a filter is used)."""
        parts = []
        for c, v in zip(self.partition_by, row):
            if v is None:
                parts.append(f"{c}=__HIVE_DEFAULT_PARTITION__")
            elif isinstance(v, (dt.date, int)) and not isinstance(v, bool):
                parts.append(f"{c}={v.isoformat() if isinstance(v, dt.date) else v}")
            else:
                return None
        return "/".join(parts)

    def days(self) -> list[dt.date | None]:
        """The day partitions of a table partitioned by one date column, from
        one listing (a catalog table: from its partition values)."""
        if self.fmt == "iceberg":
            return [r[0] for r in self.touched_values(self.read())]
        names = [c.split("=", 1)[1] for c in _children(self.spark, self.location) if c.startswith(f"{self.partition_by[0]}=")]
        return [None if n == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(n) for n in names]

    def below(self, value) -> list[tuple]:
        """The (value, bucket) partitions held under one value of the first
        partition column, from one listing."""
        top = replace(self, partition_by=self.partition_by[:1])._partition_dir(value)
        column = f"{self.partition_by[1]}="
        return [(*value, int(c[len(column):])) for c in _children(self.spark, f"{self.location.rstrip('/')}/{top}")
                if c.startswith(column)]

    def _empty(self, schema: T.StructType | None = None) -> DataFrame:
        """No rows, with ``schema`` or else the table's, read from one
        partition folder only."""
        if schema is not None:
            return self.spark.createDataFrame([], schema)
        first = next((c for c in _children(self.spark, self.location) if "=" in c), None)
        if first is None:
            return self.read().limit(0)
        one = f"{self.location.rstrip('/')}/{first}"
        return self.spark.read.option("basePath", self.location).parquet(one).limit(0)

    def touched(self, batch: DataFrame, values: list | None = None,
                schema: T.StructType | None = None) -> DataFrame:
        """The table's rows in the partitions ``batch`` has rows for, with the
        columns of ``schema`` where it is given (no inference job then).

        Only the touched partition folders are read (``basePath`` keeps the
        partition columns), whatever their number and with null values; which
        of them exist comes from one listing per touched parent folder.
        Partition values that need escaping, folders of a file sink and
        Iceberg use a null-safe filter, pruned from the table's partition
        metadata.
        """
        if not self.partition_by:
            return self.read()
        if values is None:
            values = self.touched_values(batch)
        if not values:
            return self._empty(schema) if self.fmt == "parquet" else self.read().limit(0)
        folders = self.fmt == "parquet" and not self.logged()
        dirs = [self._partition_dir(r) for r in values] if folders else [None]
        if any(d is None for d in dirs):
            return self.read(schema).where(self._among(values))
        paths = self._held(dirs)
        if not paths:
            return self._empty(schema)
        reader = self.spark.read.option("basePath", self.location)
        return (reader.schema(schema) if schema is not None else reader).parquet(*paths)

    def _held(self, dirs: list[str]) -> list[str]:
        """Paths of those partition folders that exist."""
        root = self.location.rstrip("/")
        parents = {d.rpartition("/")[0] for d in dirs}
        known = set(_children(self.spark, root)) if parents != {""} else None
        held: set[str] = set()
        for p in parents:
            if known is None:
                held |= set(_children(self.spark, root))
            elif p.split("/")[0] in known:
                held |= {f"{p}/{c}" for c in _children(self.spark, f"{root}/{p}")}
        return [f"{root}/{d}" for d in dirs if d in held]

    def _only(self, batch: DataFrame, keys: list[str]) -> T.StructType:
        """The schema of the keys and partition columns."""
        return batch.select(*dict.fromkeys([*keys, *self.partition_by])).schema

    def insert_new(self, batch: DataFrame, keys: list[str], values: list | None = None) -> None:
        """Append the rows of ``batch`` whose key the table does not hold yet
        (one row per key in ``batch``).  Only the touched partitions' key
        columns are read; replaying a batch appends nothing.  ``values``: the
        batch's partition values, when the caller has them already."""
        if self.fmt == "iceberg":
            self._merge_into(batch, keys, insert_only=True)
            return
        if self.exists():
            if values is None and self.partition_by:
                values = self.touched_values(batch)
            if values == []:  # empty batch
                return
            held = self.touched(batch, values, self._only(batch, keys)).select(*[F.col(c).alias(f"_k_{c}") for c in keys])
            on = [batch[c].eqNullSafe(held[f"_k_{c}"]) for c in keys]
            batch = batch.join(held, on, "left_anti")
        self.append(batch)

    def upsert(self, batch: DataFrame, keys: list[str], merge: Merge | None = None) -> None:
        """Make the table hold ``batch``'s rows for its keys.

        ``batch`` holds one row per key.  ``merge(current, batch)`` computes
        the new rows of keys the table already holds (default: the batch row
        replaces the stored one).  Keys the table does not hold yet are
        appended as new files; only partitions holding an updated key are
        rewritten.  Idempotent: the same batch applied twice leaves the same
        table, also when a run stopped between the rewrite and the append.
        """
        if self.fmt == "iceberg":
            if merge and self.exists():
                # The stored side decides first, so an older batch can't undo
                # a newer row: the source holds the merged rows of its keys.
                on = [F.col(c).alias(f"_k_{c}") for c in keys]
                mine = batch.select(*on).distinct()
                merged = merge(self.touched(batch), batch)
                batch = merged.join(mine, [merged[c].eqNullSafe(mine[f"_k_{c}"]) for c in keys], "left_semi")
            elif merge:
                batch = merge(batch.limit(0), batch)
            self._merge_into(batch, keys)
            return
        if not self.exists():
            self.append(merge(batch.limit(0), batch) if merge else batch)
            return
        # 1. Classify the batch against the keys held in the touched
        #    partitions, staged so that later steps do not depend on files
        #    the rewrite below replaces.
        batch_values = self.touched_values(batch) if self.partition_by else None
        if batch_values == []:  # empty batch: nothing to do
            return
        held = (self.touched(batch, batch_values, self._only(batch, keys))
                .select(*[F.col(c).alias(f"_k_{c}") for c in keys])
                .distinct().withColumn("_held", F.lit(True)))
        on = [batch[c].eqNullSafe(held[f"_k_{c}"]) for c in keys]
        classified = batch.join(held, on, "left").select(
            *batch.columns, F.coalesce(F.col("_held"), F.lit(False)).alias("_held"))
        staged, split = self._staged(classified)
        updates = staged.where(F.col("_held")).drop("_held")
        fresh = staged.where(~F.col("_held")).drop("_held")
        # 2. Rewrite only the partitions that hold an updated key.
        values = self.touched_values(updates) if self.partition_by else [()]
        if values == []:  # every key is new: nothing to rewrite
            self.append(fresh)
            _discard(self.spark, split)
            return
        current = self.touched(updates, values, batch.schema)
        if merge is None:
            k = updates.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
            kept = current.join(k, [current[c].eqNullSafe(k[f"_k_{c}"]) for c in keys], "left_anti")
            rewritten = kept.unionByName(updates.select(current.columns))
        else:
            rewritten = merge(current, updates)
        columns = rewritten.columns
        rewritten, copy = self._staged(rewritten)
        self.replace_partitions(rewritten)
        # 3. Keys the table did not hold: plain append, nothing rewritten.
        self.append(fresh.select(*columns))
        # 4. Both staged copies have done their work.
        _discard(self.spark, copy)
        _discard(self.spark, split)

    def compact(self, values: list) -> None:
        """Rewrite the partitions ``values`` into few, large files."""
        if not values:
            return
        held = self.read().limit(0)
        staged, copy = self._staged(self.touched(held, values, held.schema))
        self.replace_partitions(staged)
        _discard(self.spark, copy)

    def _staged(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write ``df`` under the shared folder and read it back: a lineage
        cut that survives executor loss (unlike a local checkpoint)."""
        path = f"{shared_dir(self.spark).rstrip('/')}/staging/{uuid.uuid4().hex}"
        self._writer(df).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def merge_statement(self, view: str, keys: list[str], insert_only: bool = False) -> str:
        on = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
        matched = "" if insert_only else "WHEN MATCHED THEN UPDATE SET * "
        return f"MERGE INTO {self.location} t USING {view} s ON {on} {matched}WHEN NOT MATCHED THEN INSERT *"

    def _merge_into(self, batch: DataFrame, keys: list[str], insert_only: bool = False) -> None:
        if not self.exists():
            self._create(batch)
            return
        spark = batch.sparkSession  # in foreachBatch, the micro-batch's own session holds the view
        view = f"upsert_src_{uuid.uuid4().hex[:8]}"
        batch.createOrReplaceTempView(view)
        try:
            spark.sql(self.merge_statement(view, keys, insert_only))
        finally:
            spark.catalog.dropTempView(view)
