"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the corpus into shards of bounded token count and stores,
for each shard, its term dictionary and every term's positions (a document-
partitioned index: no posting ever crosses the network).  ``phrase_matches``
and ``document_hits`` answer test windows from it: the rarest term of a window
gives the candidate starts, and the other terms' offset-adjusted positions are
intersected with them from rare to frequent.  ``proximity_matches`` allows
each term to lie up to ``slop`` words off its place.

Test windows go to the shards in blocks of at most ``block_windows``; a larger
test set takes more passes over the index, never a larger broadcast.

Edge cases: a null or empty text has no words (n_words 0, never
contaminated); a null item id is ignored; repeated item rows count as one
item; repeated document rows each get their own result row; extra columns are
ignored.  A document longer than ``shard_tokens`` is a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import Sent, alnum_words, doc_rows, id_and_text, stored, without_rows

WINDOW = 13
SHARD_TOKENS = 1 << 18
BLOCK_WINDOWS = 200_000
#: Candidate starts that are intersected at once.
CHUNK = 1 << 20

INDEX_SCHEMA = ("shard string, doc_ids array<bigint>, digests array<binary>, doc_starts binary, terms array<binary>, "
                "term_starts binary, postings binary")
HITS_SCHEMA = ("shard string, ordinal int, doc_id bigint, digest binary, n_words bigint, "
               "hit_starts array<int>, hit_ends array<int>, items array<bigint>")


def _shard(name: str, ids: list, digests: list[bytes], starts: list[int], tokens: list[bytes]) -> dict:
    codes_of = dict.fromkeys(tokens)
    for code, term in enumerate(codes_of):
        codes_of[term] = code
    codes = np.fromiter(map(codes_of.__getitem__, tokens), np.int32, len(tokens))
    order = np.argsort(codes, kind="stable").astype(np.int32)
    ends = np.cumsum(np.bincount(codes, minlength=len(codes_of)), dtype=np.int32)
    return {"shard": name, "doc_ids": ids, "digests": digests, "doc_starts": np.array(starts, np.int32).tobytes(),
            "terms": list(codes_of), "term_starts": np.concatenate([[0], ends]).astype(np.int32).tobytes(),
            "postings": order.tobytes()}


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_INDEX_ARROW = pa.schema([("shard", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())),
                          ("doc_starts", pa.binary()), ("terms", pa.list_(pa.binary())), ("term_starts", pa.binary()),
                          ("postings", pa.binary())])


def build_index(docs: DataFrame, shard_tokens: int = SHARD_TOKENS, digests: bool = False) -> DataFrame:
    """Positional postings of every word of every document, stored in the
    shared folder, one row per shard; with ``digests``, also the SHA-256 of
    each document's text, which tells rows of one id apart."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        ids, marks, starts, tokens = [], [], [0], []
        for doc_id, text in doc_rows(batches):
            words = alnum_words(text)
            if ids and len(tokens) + len(words) > shard_tokens:
                yield _arrow([_shard(f"{part}-{n}", ids, marks, starts, tokens)], _INDEX_ARROW)
                n += 1
                ids, marks, starts, tokens = [], [], [0], []
            ids.append(doc_id)
            if digests:
                marks.append(sha256(text).digest())
            tokens.extend(words)
            starts.append(len(tokens))
        if ids:
            yield _arrow([_shard(f"{part}-{n}", ids, marks, starts, tokens)], _INDEX_ARROW)

    return stored(id_and_text(docs).mapInArrow(shards, INDEX_SCHEMA), "postings")


def test_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (words, item_id): each run of ``window`` item words; an item
    of fewer words, but not none, is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_of, ids = [], []
            for item, text in doc_rows([batch]):
                words = alnum_words(text)
                if item is not None and words:
                    n = max(1, len(words) - window + 1)
                    words_of += [b" ".join(words[i:i + window]) for i in range(n)]
                    ids += [item] * n
            yield pa.RecordBatch.from_arrays([pa.array(words_of, pa.binary()), pa.array(ids, pa.int64())],
                                             names=["words", "item_id"])

    items = items.select(F.col("item_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, "words binary, item_id bigint").distinct()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that only one shard is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


class _Windows:
    """A block of test windows, ready to be looked up in a shard."""

    def __init__(self, pairs: list[tuple[bytes, int]]):
        pairs = sorted(set(pairs))
        words = sorted({w for w, _ in pairs})
        at = {w: i for i, w in enumerate(words)}
        split = [w.split(b" ") for w in words]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for w in split for t in w}))}
        self.length = np.array([len(w) for w in split], np.int64)
        self.terms = np.full((len(words), int(self.length.max(initial=1))), -1, np.int64)
        for i, w in enumerate(split):
            self.terms[i, :len(w)] = [self.vocabulary[t] for t in w]
        self.items = np.array([i for _, i in pairs], np.int64)
        self.item_starts = np.searchsorted([at[w] for w, _ in pairs], np.arange(len(words) + 1))


class _Shard:
    """One index row, with its postings re-keyed by test term."""

    def __init__(self, row: dict, windows: _Windows):
        self.doc_ids = row["doc_ids"]
        self.digests = row["digests"] or [None] * len(self.doc_ids)
        self.doc_starts = np.frombuffer(row["doc_starts"], np.int32).astype(np.int64)
        starts = np.frombuffer(row["term_starts"], np.int32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.int32).astype(np.int64)
        get = windows.vocabulary.get
        tests = np.fromiter((get(t, -1) for t in row["terms"]), np.int64, len(row["terms"]))
        counts = np.diff(starts)
        self.begin = np.zeros(len(windows.vocabulary) + 1, np.int64)
        self.count = np.zeros(len(windows.vocabulary) + 1, np.int64)  # last: the pad term -1
        known = tests >= 0
        self.begin[tests[known]] = starts[:-1][known]
        self.count[tests[known]] = counts[known]
        self.at = np.full(len(self.postings), -2, np.int64)  # the test term at each position
        self.at[self.postings] = np.repeat(np.where(known, tests, -2), counts)

    def phrases(self, windows: _Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every exact occurrence."""
        pad = windows.terms < 0
        size = np.where(pad, np.iinfo(np.int64).max, self.count[windows.terms])
        order = np.argsort(size, axis=1, kind="stable")  # rare to frequent, pads last
        alive = np.flatnonzero(size.min(axis=1, initial=np.iinfo(np.int64).max) > 0)
        rare = windows.terms[alive, order[alive, 0]]
        expand = self.count[rare]
        found_w, found_s = [], []
        cuts = np.searchsorted(np.cumsum(expand), np.arange(CHUNK, expand.sum() + CHUNK, CHUNK), "right") if len(alive) else []
        lo = 0
        for hi in np.unique(np.append(cuts, len(alive))).astype(int):
            if hi <= lo:
                continue
            n = expand[lo:hi]
            w = np.repeat(alive[lo:hi], n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = self.postings[np.repeat(self.begin[rare[lo:hi]], n) + k] - order[w, 0]
            lo = hi
            ok = start >= 0
            w, start = w[ok], start[ok]
            doc = np.searchsorted(self.doc_starts, start, "right") - 1
            ok = start + windows.length[w] <= self.doc_starts[doc + 1]
            w, start = w[ok], start[ok]
            for j in range(1, windows.terms.shape[1]):
                if not len(w):
                    break
                place = order[w, j]
                term = windows.terms[w, place]
                ok = term < 0
                ok[~ok] = self.at[start[~ok] + place[~ok]] == term[~ok]
                w, start = w[ok], start[ok]
            found_w.append(w)
            found_s.append(start)
        none = np.zeros(0, np.int64)
        return np.concatenate([*found_w, none]), np.concatenate([*found_s, none])

    def near(self, windows: _Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) where every term has an occurrence within ``slop``
        words of its place, counted from the rarest term's occurrence."""
        found_w, found_s = [], []
        for w in range(len(windows.length)):
            terms = windows.terms[w, :windows.length[w]]
            order = np.argsort(self.count[terms], kind="stable")
            own = self.postings[self.begin[terms[order[0]]]:][:self.count[terms[order[0]]]]
            doc = np.searchsorted(self.doc_starts, own, "right") - 1
            start = own - order[0]
            for j in order[1:]:
                there = self.postings[self.begin[terms[j]]:][:self.count[terms[j]]]
                low = np.maximum(start + j - slop, self.doc_starts[doc])
                high = np.minimum(start + j + slop, self.doc_starts[doc + 1] - 1)
                ok = np.searchsorted(there, low) < np.searchsorted(there, high, "right")
                start, doc = start[ok], doc[ok]
            found_w.append(np.full(len(start), w))
            found_s.append(np.maximum(start, self.doc_starts[doc]))
        none = np.zeros(0, np.int64)
        return np.concatenate([*found_w, none]), np.concatenate([*found_s, none])

    def documents(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, start, "right") - 1


def _blocks(windows: DataFrame, block_windows: int) -> Iterator[_Windows]:
    """The test windows in blocks of about ``block_windows`` rows."""
    windows = stored(windows, "test-windows")
    n = max(1, -(-windows.count() // block_windows))
    for k in range(n):
        yield _Windows([(bytes(r[0]), r[1]) for r in
                        windows.where(F.pmod(F.xxhash64("words"), F.lit(n)) == k).collect()])


def _matches(index: DataFrame, items: DataFrame, find, window: int, block_windows: int) -> DataFrame:
    out = None
    for block in _blocks(test_windows(items, window), block_windows):
        sent = Sent(index.sparkSession, block)

        def look(batches, sent=sent):
            windows = sent.value
            for row in _each(batches):
                shard = _Shard(row, windows)
                w, s = find(shard, windows)
                n = np.diff(windows.item_starts)[w]
                k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = shard.documents(s)
                first = s - shard.doc_starts[doc] if len(s) else s
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * int(n.sum()), pa.string()),
                    pa.array(np.repeat(doc, n), pa.int32()),
                    pa.array([shard.doc_ids[d] for d in np.repeat(doc, n).tolist()], pa.int64()),
                    pa.array(windows.items[np.repeat(windows.item_starts[w], n) + k], pa.int64()),
                    pa.array(np.repeat(first, n), pa.int64()),
                    pa.array(np.repeat(windows.length[w], n), pa.int32())],
                    names=["shard", "ordinal", "doc_id", "item_id", "start", "words"])

        part = index.mapInArrow(look, "shard string, ordinal int, doc_id bigint, item_id bigint, start bigint, words int")
        out = part if out is None else out.unionByName(part)
    return out


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW,
                   block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per exact occurrence of an item's window: the document (shard,
    ordinal, doc_id), item_id, first word and length in words."""
    return _matches(index, items, lambda shard, w: shard.phrases(w), window, block_windows)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 2, window: int = WINDOW,
                      block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Like ``phrase_matches`` for windows whose words each lie within
    ``slop`` words of their place."""
    return _matches(index, items, lambda shard, w: shard.near(w, slop), window, block_windows)


_HITS_ARROW = pa.schema([("shard", pa.string()), ("ordinal", pa.int32()), ("doc_id", pa.int64()),
                         ("digest", pa.binary()), ("n_words", pa.int64()), ("hit_starts", pa.list_(pa.int32())),
                         ("hit_ends", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def document_hits(index: DataFrame, items: DataFrame, window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: its word count, the merged word ranges that lie
    in occurrences of test windows, and the items they come from (sorted)."""
    parts = []
    for block in _blocks(test_windows(items, window), block_windows):
        sent = Sent(index.sparkSession, block)

        def look(batches, sent=sent):
            windows = sent.value
            for row in _each(batches):
                shard = _Shard(row, windows)
                w, s = shard.phrases(windows)
                change = np.zeros(len(shard.postings) + 1, np.int64)
                np.add.at(change, s, 1)
                np.add.at(change, s + windows.length[w], -1)
                marks = np.cumsum(change)[:-1] > 0
                n = np.diff(windows.item_starts)[w]
                k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs = np.unique(np.stack([np.repeat(shard.documents(s), n),
                                            windows.items[np.repeat(windows.item_starts[w], n) + k]], 1), axis=0)
                cut = np.searchsorted(pairs[:, 0], np.arange(len(shard.doc_ids) + 1))
                rows = []
                for i, doc_id in enumerate(shard.doc_ids):
                    a, b = shard.doc_starts[i], shard.doc_starts[i + 1]
                    lo, hi = _runs(marks[a:b]) if cut[i + 1] > cut[i] else ((), ())
                    rows.append({"shard": row["shard"], "ordinal": i, "doc_id": doc_id, "digest": shard.digests[i],
                                 "n_words": int(b - a), "hit_starts": list(lo), "hit_ends": list(hi),
                                 "items": pairs[cut[i]:cut[i + 1], 1].tolist()})
                yield _arrow(rows, _HITS_ARROW)

        parts.append(index.mapInArrow(look, HITS_SCHEMA))
    if len(parts) == 1:
        return parts[0].drop("shard", "ordinal")

    def merged(key, pdf):
        marks = np.zeros(int(pdf.n_words.iloc[0]), bool)
        for lo, hi in zip(pdf.hit_starts, pdf.hit_ends):
            for a, b in zip(lo, hi):
                marks[a:b] = True
        lo, hi = _runs(marks)
        found = sorted({int(i) for x in pdf["items"] for i in x})
        return pdf.head(1).assign(hit_starts=[lo.tolist()], hit_ends=[hi.tolist()], items=[found])

    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("shard", "ordinal").applyInPandas(merged, HITS_SCHEMA).drop("shard", "ordinal")


def _judged(hits: DataFrame, share: int) -> DataFrame:
    """``hits`` with n_hit and the verdict."""
    n_hit = F.aggregate(F.zip_with("hit_ends", "hit_starts", lambda b, a: (b - a).cast("long")),
                        F.lit(0).cast("long"), lambda s, x: s + x)
    return hits.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr(f"n_hit > 0 and {int(share)} * n_hit >= n_words"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per document row: words, hit words, items and the verdict: contaminated
    if any word is hit and at least one in ``share`` is."""
    hits = _judged(document_hits(build_index(docs), items, window), share)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """``docs`` without the rows that ``contamination`` finds.  A row is known
    by its doc_id and its text's digest, so clean rows that share the id of a
    contaminated one, or have none, stay; equal texts have equal verdicts."""
    hits = _judged(document_hits(build_index(docs, digests=True), items, window), share)
    return without_rows(docs, hits.where("contaminated").select(F.col("doc_id").alias("gone"), "digest").distinct())
