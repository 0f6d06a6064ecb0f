"""Connected components of an edge table, without collecting it.

Alternating large-star and small-star contraction.  Each step is a per-node
minimum (combined map-side), stored, and one plain join of the edges to it:
Spark broadcasts a small table of minima and, as both sides come straight from
files, splits the partitions of a node that has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import stored

MAX_ROUNDS = 60
#: Links that a task writes, on average, before there are more than FILES files.
FILE_LINKS = 1 << 17
FILES = 16


def _least(edges: DataFrame, files: int) -> DataFrame:
    """(node, m, n): the smallest of a node and its neighbours, and their
    number; ``edges`` are distinct, with a > b."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                   F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
    ends = edges.select(F.explode(ends).alias("end")).select("end.*")
    least = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("m"), F.count("*").alias("n"))
    return stored(least.coalesce(files), "least")


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, F.col("b") == F.col("node")).select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame, files: int) -> DataFrame:
    """``edges`` have a > b."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is
    its smallest node.  Nulls and loops are ignored; no edges, no rows."""
    edges = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = stored(edges, "edges")
    files = max(FILES, edges.count() // FILE_LINKS)
    for _ in range(MAX_ROUNDS):
        least = _least(edges, files)
        # Stars: a node with a smaller neighbour has no other.
        if least.where("m < node and n > 1").isEmpty():
            break
        edges = stored(_large_star(edges, least).distinct().coalesce(files), "edges")
        edges = stored(_small_star(edges, files).distinct().coalesce(files), "edges")
    else:
        raise RuntimeError("components did not settle")
    # Each edge gives its node and its root, dealt anew: a file of many edges
    # is not one task's share.
    ends = F.array(*[F.struct(F.col(c).alias("node"), F.col("b").alias("component")) for c in ("a", "b")])
    return edges.select(F.explode(ends).alias("end")).select("end.*").distinct()
