"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments, fewer than
exact-segment schemes need: of two fingerprints that differ in at most
``max_bits`` bits, one segment differs in at most one.  Each distinct
fingerprint is indexed under every one-wildcard variant of every segment (64
rows), rows that share a variant meet in an equality partition, and each
meeting pair is verified by its full bit distance.  A task keeps only a
spanning forest of the links it verified, so a group of near copies never
turns into all its pairs.

Edge cases: null or empty texts have fingerprint zero and link like any
other; copies share one fingerprint and are indexed once; a null doc_id takes
part but is never a component's id unless all its members are null; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import doc_rows, id_and_text, looked_up, packed, stored, texts, unpacked, without_ids
from attrlake.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
#: A variant's group beyond this is refined by exact pieces of the other bits.
REFINE = 4096
#: Links that a task holds before it passes on their spanning forest.
HELD_LINKS = 1 << 19


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Majority of the XXH64 bits over all word shingles, repeats included;
    lower-cased A-Z, words split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        h = xxhash.xxh64_intdigest
        hashes = [h(line[a:b], seed) for a, b in zip(start[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    count = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        bits = np.unpackbits(np.array(hashes[k:k + 65536], ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per document row; fp is the unsigned value's bits as long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for _, t in doc_rows([batch])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                                             names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(each, "doc_id bigint, fp bigint")


def _salted(docs: DataFrame, shingle: int) -> DataFrame:
    """``fingerprints`` stored with a row number as salt: rows without an id,
    or with equal ones, spread as well, and a task that runs again reads the
    same salts."""
    rows = fingerprints(docs, shingle)
    return stored(rows.withColumn("salt", F.monotonically_increasing_id()), "fingerprints")


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; never wider than 32 bits."""
    n = max(2, max_bits // 2 + 1)
    cut = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def variants(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(variant, fp): 64 rows per fingerprint.  A variant is the wildcard's
    bit number (which names the segment) above the segment's other bits."""
    keys = []
    for low, width in segments(max_bits):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(width):
            left = part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i)))
            keys.append(left.bitwiseOR(F.lit((low + i) << 32).cast("long")))
    return fps.select(F.explode(F.array(*keys)).alias("variant"), "fp")


def _close_pairs(group: np.ndarray, fp: np.ndarray, max_bits: int, refine: bool = True) -> np.ndarray:
    """Pairs of rows, equal in ``group`` (sorted), within ``max_bits`` bits."""
    out = [np.zeros((0, 2), np.uint64)]
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    runs = np.diff(cut)
    small = np.repeat(runs <= REFINE, runs) if refine else np.ones(len(fp), bool)
    f = fp[small]
    left = np.repeat(cut[1:], runs)[small] - np.flatnonzero(small)  # rows from here to the run's end
    at, lag = np.flatnonzero(left > 1), 1
    while len(at):
        near = np.bitwise_count(f[at] ^ f[at + lag]) <= max_bits
        out.append(np.stack([f[at[near]], f[at[near] + lag]], 1))
        lag += 1
        at = at[left[at] > lag]
    if refine:
        # Two fingerprints this close agree on one of max_bits + 1 pieces.
        pieces = [round(64 * i / (max_bits + 1)) for i in range(max_bits + 2)]
        for a, b in zip(cut[:-1][runs > REFINE], cut[1:][runs > REFINE]):
            for low, high in zip(pieces, pieces[1:]):
                piece = (fp[a:b] >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
                order = np.argsort(piece, kind="stable")
                out.append(_close_pairs(piece[order], fp[a:b][order], max_bits, refine=False))
    return np.concatenate(out)


class _Forest:
    """Union-find over the links a task has verified."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = parent[p]
        return x

    def add(self, pairs: np.ndarray) -> None:
        for a, b in np.unique(np.sort(pairs, axis=1), axis=0).tolist():
            a, b = self.root(a), self.root(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch:
        pairs = np.array([(x, r) for x in list(self.parent) if (r := self.root(x)) != x], np.uint64).reshape(-1, 2)
        self.parent = {}
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)],
                                          names=["a", "b"])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of ``fps``
    (distinct) that differ in at most ``max_bits`` bits."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        keys, fps = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys.append(batch.column("variant").to_numpy(zero_copy_only=False))
            fps.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            held += batch.num_rows
            first = next(k[0] for k in keys if len(k))
            if held >= 1 << 16 and keys[-1][-1] != first:  # else one group only, which may go on
                key, fp = np.concatenate(keys), np.concatenate(fps)
                whole = int(np.searchsorted(key, key[-1]))
                forest.add(_close_pairs(key[:whole], fp[:whole], max_bits))
                keys, fps, held = [key[whole:]], [fp[whole:]], len(key) - whole
            if len(forest.parent) > HELD_LINKS:
                yield forest.edges()
        forest.add(_close_pairs(np.concatenate(keys), np.concatenate(fps), max_bits))
        yield forest.edges()

    dealt = variants(fps, max_bits).repartition("variant").sortWithinPartitions("variant")
    return dealt.mapInArrow(meet, "a bigint, b bigint")


def classes(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, component_id) of each distinct fingerprint of ``rows``
    (doc_id, fp): its component's smallest fingerprint and smallest doc_id.

    Only linked fingerprints go through the components; the way from a
    component back to its members is salted, since one may hold very many, as
    is the way from a fingerprint back to its documents.
    """
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = connected_components(links(nodes.select("fp"), max_bits))
    least = linked.join(nodes, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("least").alias("component_id"))
    members = looked_up(linked, least, "component", F.col("node")).select("node", "component", "component_id")
    return (nodes.join(members, nodes["fp"] == members["node"], "left")
            .select("fp", F.coalesce("component", "fp").alias("component"),
                    F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document row; the component is
    the smallest doc_id that links of at most ``max_bits`` bits reach."""
    rows = _salted(docs, shingle)
    return (looked_up(rows, classes(rows, max_bits), "fp", F.col("salt"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document row of each near-duplicate group stays: one whose doc_id
    is the component's, or any if all ids of the group are null.  Rows that
    repeat a doc_id, or have none, stay one for each group they stand for."""
    rows = _salted(docs, shingle)
    named = stored(classes(rows, max_bits), "classes")
    found = looked_up(rows, named, "fp", F.col("salt"))
    ids = stored(found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("keep"),
                                             F.count("*").alias("n")), "kept")
    kept = without_ids(docs, ids.where("not keep").select(F.col("doc_id").alias("gone")))
    again = ids.where("keep and n > 1").select(F.col("doc_id").alias("again"))
    if again.isEmpty():
        return kept
    match = kept["doc_id"].cast("long").eqNullSafe(again["again"])

    def each(column: pa.Array) -> pa.Array:
        batch = pa.record_batch([column], ["text"])
        return pa.array(np.array([fingerprint(t, shingle) for t in texts(batch, "text")], np.uint64).view(np.int64))

    several = packed(kept.join(again, match, "left_semi"))
    several = several.withColumn("fp", F.arrow_udf(each, "bigint")(F.col("row.text").cast("string")))
    one = (several.join(named, "fp").where(F.col("row.doc_id").cast("long").eqNullSafe(F.col("component_id")))
           .dropDuplicates(["component"]))
    return kept.join(again, match, "left_anti").unionByName(unpacked(one, docs.columns))
