"""Small helpers the operators share."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrlake.session import run_dir

#: A-Z to a-z, other ASCII that is no letter or digit to a space; bytes of
#: 0x80 and up (all of a non-ASCII character) stay.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes."""
    return text.translate(WORD_TABLE).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files that outlive any executor."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids that may be broadcast; a longer list joins by a shuffle.
BROADCAST_IDS = 1 << 21


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id (as long, nulls equal) is not in the one
    column ``gone`` of ``ids``.  The list is stored and counted first: a short
    one is broadcast, so texts are not shuffled for it."""
    ids = stored(ids, "gone-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["gone"]), "left_anti")


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text are not in ``rows`` (gone,
    digest: the id as long and the SHA-256 of the text), joined like the ids
    of ``without_ids``."""
    rows = stored(rows, "gone-rows")
    if rows.count() <= BROADCAST_IDS // 4:  # a row takes about four times an id's memory
        rows = F.broadcast(rows)
    digest = F.unhex(F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"), 256))
    same = docs["doc_id"].cast("long").eqNullSafe(rows["gone"]) & (digest == rows["digest"])
    return docs.join(rows, same, "left_anti")


#: Rows of a key that meet in one task of ``looked_up``: at most this many
#: salts on each of its two levels.
SALTS = 64


def looked_up(rows: DataFrame, found: DataFrame, key: str, salt: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``found`` (one row per ``key``), however many rows
    bear one key.

    The key's rows are dealt to SALTS * SALTS salts.  The salts that occur
    (combined map-side: a rare key has one) find their row of ``found`` in two
    steps, so a key meets at most SALTS salts in a task, and its own rows meet
    it salt by salt.
    """
    fine = F.pmod(F.xxhash64(salt), F.lit(SALTS * SALTS)).cast("int")
    rows = rows.withColumn("salt_fine", fine)
    near = rows.select(key, "salt_fine").distinct().withColumn("salt_coarse", F.expr(f"salt_fine div {SALTS}"))
    far = near.select(key, "salt_coarse").distinct().join(found, key)
    near = near.join(far, [key, "salt_coarse"]).drop("salt_coarse")
    return rows.join(near, [key, "salt_fine"], how).drop("salt_fine")


class Sent:
    """A broadcast object, pickled by value and loaded once per task."""

    def __init__(self, spark: SparkSession, thing):
        self.bytes = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    @property
    def value(self):
        if "thing" not in self.__dict__:
            self.thing = pickle.loads(self.bytes.value)
        return self.thing


def texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """A string column as UTF-8 bytes, null as empty; few at a time are Python
    objects."""
    column = batch.column(name).cast(pa.binary())
    for k in range(0, len(column), 256):
        yield from (t or b"" for t in column.slice(k, 256).to_pylist())


def doc_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, text) of each row."""
    for batch in batches:
        yield from zip(batch.column("doc_id").to_pylist(), texts(batch, "text"))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only what most operators read; extra columns never travel."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def packed(df: DataFrame) -> DataFrame:
    """The whole input row as one struct ``row``: the operator's own columns
    beside it can't clash with any input name."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """``row`` taken apart again plus ``new``, which replaces input columns of
    the same name (any letter case)."""
    taken = {n.lower() for n in new}
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled rows that are not held
    out, the lowest by a hash of the id.

    Null labels and ids are left out; an id labelled twice takes its larger
    label.  The id list is bounded by ``limit``, so it may be broadcast.
    """
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where("doc_id is not null and y is not null")
           .where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return id_and_text(docs).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y")
