"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone, so documents are laid
out by m: the corpus is cut into ranges of m, ranges into shards of bounded
postings, and inside a shard the documents of one m are a stratum.  A term's
postings lie by stratum and by tf within it; postings of one term, stratum and
tf are a cell, and a cell's impact is worked out once.  A stratum's bound for
an item adds up the largest weighted impact of each term there.  Strata are
visited by falling bound and left out once the bound is below the item's k-th
best score so far, which a task carries on from shard to shard.  All scores
are exact; the tasks' best rows are ranked together at the end.

Corpus counts (N, L, every df) cover all documents.  Items go to the index in
blocks of about ``BLOCK_PAIRS`` (item, term) pairs; more items take more
passes, each stored before the next is sent.

Edge cases: null and empty texts have no terms and rank nowhere; a null doc_id
takes part and comes last among equal scores; repeated document rows are
documents of their own; rows of one item_id (null too) are one item with the
terms of all; an item without terms, or whose terms no document holds, has no
rows; extra columns are ignored.  A document of more than ``SHARD_POSTINGS``
terms is a shard of its own.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrlake.llm.common import Sent, alnum_words, doc_rows, id_and_text, stored

K = 50
SHARD_POSTINGS = 1 << 17
#: Terms, with repeats, of one range of m on average.
RANGE_TERMS = 1 << 20
BLOCK_PAIRS = 1 << 19
#: Distinct query terms that may be broadcast to the dictionaries.
BROADCAST_TERMS = 1 << 19

VECTORS = "doc_id bigint, n bigint, terms binary, tfs binary"
INDEX = ("doc_ids array<bigint>, strata array<bigint>, terms binary, dfs array<int>, cell_starts binary, "
         "cell_strata binary, cell_tfs binary, cell_sizes binary, docs binary")
HITS = "item int, doc_id bigint, score bigint"


@dataclass
class Index:
    """Stored shards and the counts that the normalisers were made with."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def packed_ints(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them, its code first."""
    narrow = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    return narrow.dtype.char.encode() + narrow.tobytes()


def unpacked_ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, blob[:1].decode(), offset=1).astype(np.int64)


def term_vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with a term: its terms, joined by a
    space, and how often each occurs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in doc_rows([batch]):
                words = alnum_words(text)
                if words:
                    tf = Counter(words)
                    rows.append((doc_id, len(words), b" ".join(tf), packed_ints(np.fromiter(tf.values(), np.int64, len(tf)))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["doc_id", "n", "terms", "tfs"])

    return id_and_text(docs).mapInArrow(each, VECTORS)


class _Shard:
    """Documents in order of m, gathered until they make a shard."""

    def __init__(self):
        self.code: dict[bytes, int] = {}
        self.ids, self.strata = [], []
        self.stratum, self.codes, self.tfs, self.sizes = array("i"), array("i"), [], array("i")

    def add(self, doc_id: int | None, m: int, terms: bytes, tfs: bytes) -> None:
        if not self.strata or self.strata[-1] != m:
            self.strata.append(m)
        code = self.code
        words = terms.split(b" ")
        self.codes.extend([code.setdefault(w, len(code)) for w in words])
        self.tfs.append(unpacked_ints(tfs).astype(np.int32))
        self.sizes.append(len(words))
        self.stratum.append(len(self.strata) - 1)
        self.ids.append(doc_id)

    def row(self) -> dict:
        terms = sorted(self.code)
        place = np.empty(len(terms), np.int64)
        place[[self.code[t] for t in terms]] = np.arange(len(terms))
        sizes = np.array(self.sizes)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        tf = np.concatenate(self.tfs)
        segment = place[np.array(self.codes)] * len(self.strata) + np.repeat(np.array(self.stratum, np.int64), sizes)
        order = np.lexsort((tf, segment))
        segment, tf = segment[order], tf[order]
        first = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (tf[1:] != tf[:-1])]))
        term = segment[first] // len(self.strata)
        ints = packed_ints
        return {"doc_ids": self.ids, "strata": self.strata, "terms": b" ".join(terms),
                "dfs": np.bincount(place[np.array(self.codes)], minlength=len(terms)).tolist(),
                "cell_starts": ints(np.searchsorted(term, np.arange(len(terms) + 1))),
                "cell_strata": ints(segment[first] % len(self.strata)), "cell_tfs": ints(tf[first]),
                "cell_sizes": ints(np.diff(np.append(first, len(segment)))), "docs": ints(doc[order])}


_INDEX_ARROW = pa.schema([("doc_ids", pa.list_(pa.int64())), ("strata", pa.list_(pa.int64())), ("terms", pa.binary()), ("dfs", pa.list_(pa.int32()))]
                         + [(c, pa.binary()) for c in ("cell_starts", "cell_strata", "cell_tfs", "cell_sizes", "docs")])


def build_index(docs: DataFrame, shard_postings: int = SHARD_POSTINGS) -> Index:
    """The index of all documents, stored in the shared folder.  Ranges of m
    hold about equally many terms, not documents; a document draws its place
    among those of its m, so many of one length are spread over ranges."""
    vectors = stored(term_vectors(docs), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L").alias("m")
    # One row per m, of which there are no more than different lengths.
    sizes = vectors.select(m, "n").groupBy("m").agg(F.sum("n").alias("size"))
    before = stored(sizes.withColumn("before", F.sum("size").over(Window.orderBy("m")) - F.col("size")), "lengths")
    draw = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = F.floor((F.col("before") + F.col("size") * draw) / F.lit(RANGE_TERMS)).alias("part")
    laid = (vectors.select(m, "doc_id", "terms", "tfs", F.monotonically_increasing_id().alias("row"))
            .join(before, "m").select(part, "m", "doc_id", "terms", "tfs")
            .repartition("part").sortWithinPartitions("part", "m"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = _Shard(), None
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                for r in batch.slice(k, 64).to_pylist():
                    if shard.ids and (r["part"] != part or len(shard.codes) + r["terms"].count(b" ") >= shard_postings):
                        yield pa.RecordBatch.from_pylist([shard.row()], schema=_INDEX_ARROW)
                        shard = _Shard()
                    part = r["part"]
                    shard.add(r["doc_id"], r["m"], r["terms"], r["tfs"])
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.row()], schema=_INDEX_ARROW)

    return Index(stored(laid.mapInArrow(shards, INDEX), "stratified-index"), n_docs, n_terms)


def weighted_terms(index: Index, items: DataFrame) -> DataFrame:
    """(item_id, term, w) of every item's terms that documents hold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(i, w) for i, text in doc_rows([batch]) for w in set(alnum_words(text))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())],
                                             names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = stored(rows.mapInArrow(each, "item_id bigint, term binary").distinct(), "item-terms")
    terms = asked.select("term").distinct()
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    held = index.shards.select(F.explode(F.arrays_zip(F.split(F.col("terms").cast("string"), " ").alias("term"), "dfs")).alias("x"))
    held = held.select(F.col("x.term").cast("binary").alias("term"), "x.dfs")
    df = held.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("dfs").alias("df"))
    ratio = F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    return asked.join(df, "term").select("item_id", "term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, ``size`` of them, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Items:
    """A block of items as arrays over its distinct terms."""

    def __init__(self, rows: list[tuple[int | None, bytes, int]]):
        weight = {t: w for _, t, w in rows}
        self.terms = sorted(weight)
        self.w = np.array([weight[t] for t in self.terms], np.int64)
        place = {t: i for i, t in enumerate(self.terms)}
        by_item: dict[int | None, list[int]] = {}
        for item, term, _ in rows:
            by_item.setdefault(item, []).append(place[term])
        self.ids = sorted(by_item, key=lambda i: (i is None, i or 0))
        self.asked = [np.sort(np.array(by_item[i], np.int64)) for i in self.ids]


class _Postings:
    """What one shard holds of a block's terms, by segment: a term's cells in
    one stratum."""

    def __init__(self, row: pa.RecordBatch, items: Items):
        ints = lambda name: unpacked_ints(row.column(name)[0].as_py())
        found = pc.index_in(pa.array(row.column("terms")[0].as_py().split(b" "), pa.binary()), value_set=pa.array(items.terms, pa.binary()))
        here = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        asked = found.take(pa.array(here)).to_numpy(zero_copy_only=False).astype(np.int64)
        start = ints("cell_starts")
        n_cells = start[here + 1] - start[here]
        cell = ranges(start[here], n_cells)
        term = np.repeat(asked, n_cells)
        m = np.array(row.column("strata")[0].as_py(), np.int64)
        stratum, tf, sizes = ints("cell_strata")[cell], ints("cell_tfs")[cell], ints("cell_sizes")
        gain = items.w[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[stratum]))
        posted = (np.cumsum(sizes) - sizes)[cell]
        self.n_docs, self.n_strata = len(row.column("doc_ids")[0]), len(m)
        self.docs = ints("docs")[ranges(posted, sizes[cell])]
        self.gain = np.repeat(gain, sizes[cell])
        # Cells of a segment follow each other by tf, so its last has the bound.
        last = np.flatnonzero(np.concatenate([(term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]), [True]])) if len(cell) else cell
        ends = np.cumsum(sizes[cell])[last]
        self.start, self.size = np.concatenate([[0], ends[:-1]])[:len(last)].astype(np.int64), np.diff(ends, prepend=0)
        self.bound, self.stratum = gain[last], stratum[last]
        order = np.argsort(term[last], kind="stable")
        self.of_term = np.searchsorted(term[last][order], np.arange(len(items.terms) + 1))
        self.start, self.size, self.bound, self.stratum = (a[order] for a in (self.start, self.size, self.bound, self.stratum))


@dataclass
class Best:
    """The k best (score, doc_id) of an item so far, best first."""

    score: np.ndarray
    doc_id: np.ndarray
    null: np.ndarray

    def with_more(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray, k: int) -> Best:
        score, doc_id, null = (np.concatenate(p) for p in ((self.score, score), (self.doc_id, doc_id), (self.null, null)))
        best = np.lexsort((doc_id, null, -score))[:k]
        return Best(score[best], doc_id[best], null[best])

    def least(self, k: int) -> int:
        """What a document must score to be among the best."""
        return max(1, int(self.score[-1])) if len(self.score) == k else 1


def visit(best: Best, asked: np.ndarray, held: _Postings, ids: np.ndarray, null: np.ndarray, k: int) -> Best:
    """The best after one shard: strata by falling bound, 4, 16, 64, ... at a
    time, until none can give a better row."""
    segment = ranges(held.of_term[asked], held.of_term[asked + 1] - held.of_term[asked])
    bound = np.zeros(held.n_strata, np.int64)
    np.add.at(bound, held.stratum[segment], held.bound[segment])
    order = np.argsort(-bound, kind="stable")
    at, size = 0, 4
    while at < len(order):
        part = order[at:at + size]
        part = part[bound[part] >= best.least(k)]
        if not len(part):
            break
        live = np.zeros(held.n_strata, bool)
        live[part] = True
        mine = segment[live[held.stratum[segment]]]
        posted = ranges(held.start[mine], held.size[mine])
        score = np.zeros(held.n_docs, np.int64)
        np.add.at(score, held.docs[posted], held.gain[posted])
        hit = np.flatnonzero(score >= best.least(k))
        best = best.with_more(score[hit], ids[hit], null[hit], k)
        at, size = at + size, 4 * size
    return best


def best_of_tasks(index: Index, sent: Sent, k: int) -> DataFrame:
    """(item, doc_id, score): each task's ``k`` best per item of the block, the
    item by its place in the block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        none = np.zeros(0, np.int64)
        best = [Best(none, none, none.astype(bool))] * len(items.ids)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                held = _Postings(row, items)
                column = row.column("doc_ids")[0].values
                null = column.is_null().to_numpy(zero_copy_only=False)
                ids = column.fill_null(0).to_numpy(zero_copy_only=False)
                best = [visit(b, a, held, ids, null, k) for b, a in zip(best, items.asked)]
        for i, b in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), i), pa.int32()), pa.array(b.doc_id, pa.int64(), mask=b.null),
                                              pa.array(b.score, pa.int64())], names=["item", "doc_id", "score"])

    return index.shards.mapInArrow(search, HITS)


def search(index: Index, items: DataFrame, k: int = K, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = items.sparkSession
    pairs = stored(weighted_terms(index, items), "weights")
    blocks = max(1, -(-pairs.count() // block_pairs))
    found = []
    for block in range(blocks):
        # About block_pairs rows: items are dealt by a hash, an item is never split.
        rows = pairs.where(F.pmod(F.xxhash64(F.lit(3), "item_id"), F.lit(blocks)) == block).toArrow().to_pydict()
        asked = Items(list(zip(rows["item_id"], rows["term"], rows["w"])))
        best = best_of_tasks(index, Sent(spark, asked), k)
        by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = stored(best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k), "ranked")
        names = spark.createDataFrame(list(enumerate(asked.ids)), "item int, item_id bigint")
        found.append(ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


ORACLE = r"""
with words as (
  select 'd' as kind, row_number() over () as k, doc_id as id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents
  union all
  select 'i', 0, item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') from benchmark),
docs as (select k, id, cast(len(t) as bigint) as n from words where kind = 'd' and len(t) > 0),
counts as (select cast(count(*) as bigint) as big_n, cast(sum(n) as bigint) as big_l from docs),
norm as (select k, id, 50 + (50 * n * big_n) // big_l as m from docs, counts),
asked as (select distinct id as item_id, unnest(t) as term from words where kind = 'i'),
tfs as (select k, term, cast(count(*) as bigint) as tf from (select k, unnest(t) as term from words where kind = 'd')
        where term in (select term from asked) group by k, term),
weights as (select term, cast(floor(1000 * ln(cast(2 * any_value(big_n) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
            from tfs, counts group by term),
scores as (select item_id, k, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
           from asked join tfs using (term) join weights using (term) join norm using (k) group by item_id, k),
ranked as (select item_id, id as doc_id, score, row_number() over (partition by item_id order by score desc, id nulls last) as rank
           from scores join norm using (k) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 50"""
