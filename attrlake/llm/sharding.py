"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; a row's
fractional rank, (rank - u) / size with one seeded u per source, spreads every
source evenly over the whole order (a random start keeps many small sources
from meeting in one place).  The global order by fractional rank is cut into
shards of equal count, so each holds the mixture up to one row per source and
cut.

Rows that are equal in all columns are counted (map-side first) and numbered,
and the number is hashed too, so the copies that mixing makes of a row are
shuffled like different rows and spread over the shards.

No rank is taken over a whole source or table: rows go to hash ranges of
bounded size, the ranges' counts are added up in a small table, and ranks are
counted within a range from its offset.  Ranks are taken of hashes alone; the
rows meet their places last, copies in runs of at most ``COPY_RUN``.

Edge cases: null sources are one source; null ids, texts and repeated rows
take part (rows equal in all columns are interchangeable); fewer rows than
shards leave later shards empty of rows; an empty table stays empty; input
columns pass through, ``shard`` and ``slot`` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from attrlake.llm.common import packed, stored, unpacked

SHARDS = 40
SEED = 7
#: Rows of one hash range, on average.
RANGE_ROWS = 4096
#: Copies of one row that meet their places in one key of a join.
COPY_RUN = 4096


def _unit(value: Column) -> Column:
    return F.shiftrightunsigned(value, 11) / F.lit(float(2 ** 53))


def _offsets(counts: DataFrame, by: list[str], part: str, n: str) -> DataFrame:
    """Rows before each range, per group of ``by``."""
    order = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(order), F.lit(0)))


def _identity(df: DataFrame, seed: int) -> Column:
    """A hash of all of a packed row's columns, nulls told apart from values."""
    parts = []
    for field in df.schema["row"].dataType.fields:
        c = F.col("row").getField(field.name)
        plain = isinstance(field.dataType, AtomicType)
        parts += [c if plain else F.to_json(F.struct(c.alias("c"))), c.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def _in_runs(counted: DataFrame) -> DataFrame:
    """``counted`` (with ``n_same``) once for each run of its copies."""
    last = F.expr(f"(n_same - 1) div {COPY_RUN}")
    return counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _draws(rows: DataFrame, seed: int) -> DataFrame:
    """(stratum, h1, h2, run, draw) per row: its source, its hash, the run of
    copies it lies in, and the hash that shuffles it."""
    counted = stored(rows.groupBy("stratum", "h1", "h2").agg(F.count("*").alias("n_same")), "row-counts")
    runs = _in_runs(counted).repartition("h1", "h2", "run")  # one row's copies are made in many tasks
    first = F.col("run") * COPY_RUN
    ends = F.least(first + COPY_RUN, "n_same") - 1
    return (runs.withColumn("number", F.explode(F.sequence(first, ends)))
            .select("stratum", "h1", "h2", "run", F.xxhash64(F.lit(seed), "h1", "h2", "number").alias("draw")))


def places(draws: DataFrame, seed: int = SEED, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, int]:
    """``draws`` (stratum, draw and more) with ``place``, each row's number in
    the whole order from 0, and the number of rows."""
    columns = draws.columns
    sizes = stored(draws.groupBy("stratum").agg(F.count("*").alias("n")), "strata")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") / F.lit(range_rows))
    rows = draws.join(sizes, "stratum").withColumn("range", F.floor(_unit(F.col("draw")) * parts))
    counts = stored(rows.groupBy("stratum", "range").agg(F.count("*").alias("m")), "ranges")
    before = _offsets(counts, ["stratum"], "range", "m").select("stratum", "range", "before")
    within = Window.partitionBy("stratum", "range").orderBy(_unit(F.col("draw")), "draw")
    ranked = (rows.join(before, ["stratum", "range"])
              .withColumn("rank", F.col("before") + F.row_number().over(within)))
    start = _unit(F.xxhash64(F.lit(seed + 1), "stratum"))
    spans = max(1, -(-total // range_rows))
    ranked = (ranked.withColumn("fraction", (F.col("rank") - start) / F.col("n"))
              .withColumn("span", F.least(F.floor(F.col("fraction") * spans), F.lit(spans - 1)).cast("long"))
              .select(*columns, "fraction", "span"))
    whole = stored(ranked.groupBy("span").agg(F.count("*").alias("m")), "spans")
    order = Window.partitionBy("span").orderBy("fraction", "stratum", "draw")
    placed = ranked.join(_spread(whole, spans), "span")
    return placed.withColumn("place", F.col("before") + F.row_number().over(order) - 1).select(*columns, "place"), total


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0)."""
    rows = packed(docs)
    stratum = F.xxhash64(F.coalesce(F.col("row.source").cast("string"), F.lit("\0")))
    # Two hashes: 64 bits alone meet by chance at 100 TB.
    rows = rows.select("row", stratum.alias("stratum"), _identity(rows, seed).alias("h1"), _identity(rows, ~seed).alias("h2"))
    placed, total = places(_draws(rows, seed), seed, range_rows)
    total = max(total, 1)
    placed = placed.select("h1", "h2", "run", F.expr(f"place * {shards} div {total}").alias("cut"), "place")
    counted = rows.groupBy("row", "h1", "h2").agg(F.count("*").alias("n_same"))
    out = _in_runs(counted).join(placed, ["h1", "h2", "run"])
    first = F.expr(f"(cut * {total} + {shards - 1}) div {shards}")
    return unpacked(out, docs.columns, shard=F.col("cut").cast("int"), slot=(F.col("place") - first).cast("long"))


def _spread(counts: DataFrame, spans: int) -> DataFrame:
    """Offsets over all spans in two steps of about the root of their number."""
    wide = max(1, int(spans ** 0.5))
    group = F.floor(F.col("span") / F.lit(wide))
    groups = counts.withColumn("group", group)
    inner = Window.partitionBy("group").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.groupBy("group").agg(F.sum("m").alias("g"))
    outer = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("g").over(outer), F.lit(0))).select("group", "earlier")
    return (groups.withColumn("inside", F.coalesce(F.sum("m").over(inner), F.lit(0))).join(sums, "group")
            .select("span", (F.col("earlier") + F.col("inside")).alias("before")))


def shard_manifest(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document row: size in bytes (UTF-8 text plus 16), the text's CRC32,
    the law that holds (``rows``), shard and slot.  The text itself does not
    travel.  ``grown_shard`` is null: under this law another shard count deals
    all rows anew."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    return interleave(slim, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
