"""Merkle manifest of a dataset: tree, proofs, verification.

A row's leaf is the SHA-256 of its columns.  Leaves of one source, by doc_id,
make a tree of up to ``FAN`` children a node; the sources' roots make one more
such tree.  Only every ``STEP``-th level is stored.  A proof needs the levels
between as well: each aligned subtree of FAN ** STEP stored nodes is rebuilt
inside one task, gives the siblings of its nodes, and is dropped again.

Positions are counted in range partitions plus their offsets, so no source is
ranked in one task; a subtree is the largest thing that is gathered.  Paths are
made from the top down, one row per subtree root; a document's own path exists
only while its row is being written.

Edge cases: null columns are written ``-``; a null source is a source, the
first one; null ids come first in their source; rows of equal id follow each
other by leaf; an empty table has no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrlake.llm.common import stored

FAN = 16
STEP = 2
#: Subtrees that are Python objects at a time.
AT_ONCE = 16

UPPER = "tree string, pos bigint, path binary, subroot binary, top_pos bigint, tops bigint"
PROOFS = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def digest(parts: bytes) -> bytes:
    """SHA-256 over the hex text of binary digests that follow each other."""
    return sha256(parts.hex().encode()).digest()


def parents(level: list[bytes]) -> list[bytes]:
    return [digest(b"".join(level[k:k + FAN])) for k in range(0, len(level), FAN)]


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def regenerate(nodes: list[bytes], n: int, step: int = STEP) -> list[list[bytes]]:
    """The levels of one aligned subtree, of a level of ``n`` nodes, from its
    stored lowest one up to its root."""
    levels = [nodes]
    for _ in range(min(step, height(n))):
        levels.append(parents(levels[-1]))
    return levels


def siblings(levels: list[list[bytes]], k: int) -> bytes:
    """The others of each run on the way from node ``k`` to the subtree's root."""
    found = []
    for level in levels[:-1]:
        run = k - k % FAN
        found += level[run:k] + level[k + 1:run + FAN]
        k //= FAN
    return b"".join(found)


def fold(node: bytes, path: bytes, pos: int, n: int) -> tuple[bytes, bytes]:
    """The root that ``node`` at ``pos`` of ``n`` and its siblings lead to, and
    the rest of ``path``."""
    while n > 1:
        run = pos - pos % FAN
        size = 32 * (min(FAN, n - run) - 1)
        at = 32 * (pos - run)
        node, path = digest(path[:at] + node + path[at:size]), path[size:]
        pos, n = pos // FAN, -(-n // FAN)
    return node, path


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Binary leaf of a document row."""
    fields = F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)])
    return F.unhex(F.sha2(fields.cast("binary"), 256))


def tampered_with(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def tampered_text(text: Column) -> Column:
    """A-Z lower-cased, all else as it was."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, node, found, tie): the leaf of each row and the one of
    the row as found later, where the two differ.  ``tree`` names the source
    and sorts like it, null first."""
    source = F.col("source").cast("string")
    columns = [F.col("doc_id"), source, F.col("lang"), F.col("n_chars")]
    text = F.col("text").cast("string")
    found = F.when(tampered_with(F.col("doc_id")), leaf(*columns, tampered_text(text)))
    rows = docs.select(F.coalesce(F.concat(F.lit("."), source), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf(*columns, text).alias("node"), found.alias("found"), F.monotonically_increasing_id().alias("tie"))
    return stored(rows, "leaves")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their position ``pos`` by ``order`` in their tree of ``n``.
    The whole order is cut into ranges; a range counts its own rows only."""
    dealt = rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    counts = stored(dealt.groupBy("part", "tree").agg(F.count("*").alias("m")), "counts")
    by_tree = Window.partitionBy("tree")
    offsets = counts.select("part", "tree", (F.sum("m").over(by_tree.orderBy("part")) - F.col("m")).alias("before"),
                            F.sum("m").over(by_tree).alias("n"))
    within = Window.partitionBy("part", "tree").orderBy(*order)
    return (dealt.join(offsets, ["part", "tree"])
            .withColumn("pos", F.col("before") + F.row_number().over(within) - 1).drop("part", "before"))


def subtrees(nodes: DataFrame, payload: tuple[str, ...] = (), step: int = STEP) -> DataFrame:
    """(tree, pos, n, nodes): the aligned subtrees over a stored level, at most
    FAN ** step rows each.  ``n`` counts the nodes of the level in the tree."""
    return (nodes.groupBy("tree", F.expr(f"pos div {FAN ** step}").alias("pos"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "node", *payload))).alias("nodes")))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            yield from batch.slice(k, AT_ONCE).to_pylist()


def climb(nodes: DataFrame, step: int = STEP) -> DataFrame:
    """The level ``step`` levels above ``nodes``; a tree's root stays as it is."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["tree"], r["pos"], -(-r["n"] // FAN ** step),
                     regenerate([x["node"] for x in r["nodes"]], r["n"], step)[-1][0]) for r in _each([batch])]
            yield pa.RecordBatch.from_pylist([dict(zip(("tree", "pos", "n", "node"), r)) for r in rows], schema=pa.schema(
                [("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.binary())]))

    return subtrees(nodes, step=step).mapInArrow(up, "tree string, pos bigint, n bigint, node binary")


def checkpoints(nodes: DataFrame, step: int = STEP) -> list[DataFrame]:
    """The stored levels: ``nodes`` and every ``step``-th above, up to one node
    per tree."""
    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(stored(climb(levels[-1], step), "level"))
    return levels


def _emit(level: DataFrame, upper: DataFrame, step: int, payload: tuple[str, ...], schema: str,
          row: Callable[[dict, int, dict, list[list[bytes]]], tuple]) -> DataFrame:
    """``row`` for every node of ``level``, with its subtree's levels and the
    subtree root's entry of ``upper``."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _each(batches):
            levels = regenerate([x["node"] for x in tree["nodes"]], tree["n"], step)
            rows = [row(tree, k, node, levels) for k, node in enumerate(tree["nodes"])]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    return subtrees(level, payload, step).join(upper, ["tree", "pos"]).mapInArrow(down, schema)


def paths(levels: list[DataFrame], upper: DataFrame, step: int = STEP) -> DataFrame:
    """Every stored node of the second level or above, down from the roots in
    ``upper`` (pos 0): the paths of the roots of the lowest subtrees."""

    def row(tree, k, node, levels):
        return (tree["tree"], node["pos"], siblings(levels, k) + tree["path"], tree["subroot"], tree["top_pos"], tree["tops"])

    for level in reversed(levels[1:-1]):
        upper = stored(_emit(level, upper, step, (), UPPER, row), "paths")
    return upper


def _sources(roots: DataFrame, step: int) -> tuple[DataFrame, bytes]:
    """The tree over the sources' roots (tree, node): each one's path, position
    and number, as the entry for its own tree; and the root of all."""
    one = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    nodes = stored(numbered(one, ["name"]), "subroots")
    levels = checkpoints(nodes, step)
    root = levels[-1].first()
    start = nodes.sparkSession.createDataFrame([("", 0, b"", b"", 0, 0)], UPPER)

    def row(tree, k, node, levels):
        return node["name"], 0, siblings(levels, k) + tree["path"], node["node"], node["pos"], tree["n"]

    found = _emit(levels[0], paths(levels, start, step), step, ("name",), UPPER, row)
    return stored(found, "top-paths"), bytes(root["node"]) if root else b""


def manifest(docs: DataFrame, step: int = STEP) -> DataFrame:
    """Per document row: its leaf, its source's root, the root of all, the
    SHA-256 of its proof, and the root that the row as found later (see
    ``leaves``) folds to with that proof."""
    levels = checkpoints(stored(numbered(leaves(docs), ["doc_id", "node", "tie"]), "numbered"), step)
    tops, root = _sources(levels[-1].select("tree", "node"), step)

    def row(tree, k, node, levels):
        path = siblings(levels, k) + tree["path"]
        found, rest = fold(node["found"] or node["node"], path, node["pos"], tree["n"])
        folded, _ = fold(found, rest, tree["top_pos"], tree["tops"])
        return (node["doc_id"], node["node"].hex(), tree["subroot"].hex(), root.hex(), digest(path).hex(), folded.hex(),
                folded == root)

    return _emit(levels[0], paths(levels, tops, step), step, ("doc_id", "found"), PROOFS, row)


def oracle(levels: int = 6) -> str:
    """The manifest in SQL, for at most FAN ** levels nodes a tree."""
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def put(c):
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    def tree(name, source, first):
        """CTEs of one tree per ``key``: levels, runs around each node, roots."""
        out = [f"{name}0 as (select key, pos, count(*) over (partition by key) as n, h from ({first}))"]
        for k in range(levels):
            here = f"partition by key, pos // {FAN} order by pos rows between"
            out.append(
                f"{name}r{k} as (select key, pos, n, h, case when n > 1 then coalesce(string_agg(h, '') over ({here} unbounded preceding and 1 preceding), '') else '' end as pre, "
                f"case when n > 1 then coalesce(string_agg(h, '') over ({here} 1 following and unbounded following), '') else '' end as post from {name}{k})")
            out.append(
                f"{name}{k + 1} as (select key, pos // {FAN} as pos, (any_value(n) + {FAN - 1}) // {FAN} as n, "
                f"case when any_value(n) > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h from {name}{k} group by key, pos // {FAN})")
        return out

    def climbed(name, key, pos, h, carry):
        """Fold ``h`` and gather the siblings, level by level."""
        sql = f"select *, {h} as fold_{name}, '' as path_{name} from {carry}"
        for k in range(levels):
            sql = (f"select x.* exclude (fold_{name}, path_{name}), case when r.n > 1 then sha256(r.pre || fold_{name} || r.post) else fold_{name} end as fold_{name}, "
                   f"path_{name} || r.pre || r.post as path_{name} from ({sql}) x join {name}r{k} r on r.key = {key} and r.pos = {pos} // {FAN ** k}")
        return sql

    bits = ("list_reduce(flatten([[4294967295]] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])), "
            "lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)")
    parts = [
        f"""d as (select coalesce('.' || source, '') as key, doc_id, coalesce(xor({bits}, 4294967295) % 5 = 0, false) as hit,
  sha256({' || '.join(put(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}) as leaf,
  sha256({' || '.join(put(c) for c in ('doc_id', 'source', 'lang', 'n_chars', f'translate(text, {az})'))}) as low from documents)""",
        "p as (select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos from d)",
        *tree("s", "p", "select key, pos, leaf as h from p"),
        f"t as (select key as name, h as subroot, row_number() over (order by key) - 1 as place from s{levels})",
        *tree("u", "t", "select '' as key, place as pos, subroot as h from t"),
        f"c as ({climbed('s', 'x.key', 'x.pos', 'case when hit then low else leaf end', 'p')})",
        "e as (select c.*, t.subroot, t.place from c join t on c.key = t.name)",
        f"f as ({climbed('u', chr(39) * 2, 'x.place', 'fold_s', 'e')})",
    ]
    return ("with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, u.h as root, sha256(path_s || path_u) as proof_sha256, fold_u as folded_root, fold_u = u.h as verified
from f, u{levels} u""")
