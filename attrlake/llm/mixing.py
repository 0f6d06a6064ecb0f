"""Mixing sources to target weights by Poisson replication.

Each source's mean repetition rate is its target share of the output over its
size.  A document's count is the Poisson quantile, at that mean, of a uniform
number hashed from its id, its text and the seed: the same document gets the
same count on every run and machine.  Documents are exploded by their count
and shuffled globally by a hash.

Edge cases: a null source is a source of its own; null texts and ids hash like
values; rows that repeat get equal counts; an empty table stays empty; input
columns pass through whatever their names.  ``copy`` (from 0) is added only
if ``copy_column`` is given and then replaces an input column of that name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from attrlake.llm.common import packed, stored, unpacked

SEED = 6
TEMPERATURE = 0.7


def poisson_steps(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... up to where doubles end at 1."""
    steps, total, k = [], 0.0, 0
    while k <= mean or total < 1 - 2 ** -53:
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else float(k == 0)
        if steps and total == steps[-1] and k > mean:
            break
        steps.append(min(total, 1.0))
        k += 1
    return steps


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) from the top 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(2 ** 53))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE,
          total: float | None = None) -> DataFrame:
    """(source, n, rate): rows of each source and its mean repetition rate.

    ``weights`` are target shares (sources without one go); without weights
    the share of a source is its size to the power ``temperature``.  The
    expected output is ``total`` rows, the input's number by default.
    """
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        pairs = [(F.lit(k), float(w)) for k, w in weights.items()]
        share = F.lit(0.0)
        for k, w in pairs:
            share = F.when(F.col("source").eqNullSafe(k), F.lit(w)).otherwise(share)
    sizes = stored(sizes.withColumn("share", share), "source-sizes")
    sums = sizes.agg(F.sum("share").alias("s"), F.sum("n").alias("n")).first()
    goal = float(total if total is not None else sums.n or 0)
    return sizes.select("source", "n", (F.col("share") * goal / F.lit(sums.s or 1.0) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE,
        total: float | None = None, seed: int = SEED, copy_column: str | None = None) -> DataFrame:
    """``docs``, each row repeated by its count, in globally shuffled order."""
    steps = F.udf(poisson_steps, ArrayType(DoubleType()), useArrow=False)  # one call per source, not per row
    table = stored(rates(docs, weights, temperature, total).where("rate > 0")
                   .select("source", steps("rate").alias("steps")), "poisson-steps")
    rows = packed(docs)
    field = rows.select("row.*").columns
    key = [F.col("row.doc_id").cast("string"), F.xxhash64("row.text")]
    rows = rows.select("row", F.col("row.source").cast("string").alias("from"), *[k.alias(f"key{i}") for i, k in enumerate(key)])
    rows = rows.join(table, rows["from"].eqNullSafe(table["source"]))
    u = uniform(seed, F.col("key0"), F.col("key1"))
    count = F.size(F.filter("steps", lambda p: p <= u))
    copies = (rows.select("row", "key0", "key1", count.alias("count")).where("count > 0")
              .select("row", "key0", "key1", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("copy")))
    place = F.xxhash64(F.lit(seed + 1), "key0", "key1", "copy")
    shuffled = copies.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    return unpacked(shuffled, field, **({copy_column: F.col("copy")} if copy_column else {}))
