"""Language identification by interpolated Kneser-Ney character models.

Texts are read as lower-cased letters, everything else as one space between
words.  For each language the n-grams of up to ``ORDER`` characters of every
learnable document are counted: the highest order by occurrence, lower ones by
the number of different characters before them.  Absolute discounting, the
discount from the counts of counts, interpolates each order with the next
lower one, and the lowest with equal shares.  A model is two pairs of sorted
64-bit hash arrays a language: n-gram to log-probability, context to the log
of the weight it leaves to the next lower order; a lookup is a binary search,
once for each different n-gram of a chunk of text.

The language of the lowest cross-entropy per character wins.  Its score is the
chance of being right, a logistic curve over the lead on the second language
and the text's length, fitted on learnable documents that the calibration's
own models have not seen; a score below ``REJECT`` rejects (column
``rejected``; the prediction stays).

Counting and estimation are Spark jobs over all learnable documents.  The
finished model is sent in blocks of about ``BLOCK_ENTRIES`` entries, dealt by
the last character of the context, so that a character is scored in one block;
a larger model takes more passes that add up.

Edge cases: a null text or one without a letter is ``und`` with score 0 and
rejected; without learnable documents every text is; equal cross-entropies go
to the smaller name; with one language there is no lead, and its score is the
curve's value at none; a null doc_id is learned from (it is in no held-out
part); repeated rows each get their own result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import Sent, id_and_text, stored, texts

ORDER = 4
#: Characters whose n-grams are made at once.
CHUNK = 1 << 19
BLOCK_ENTRIES = 1 << 20
#: Documents that the calibration is fitted on, about, drawn by a hash.
CALIBRATION_ROWS = 20_000
REJECT = 0.5
UNKNOWN = "und"
SPACE = 32


class Letters:
    """Which code points are letters; made once a process."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table[codes]


def read(text: bytes) -> np.ndarray:
    """Code points of the lower-cased letters, one space after each word."""
    line = text.decode("utf-8", "replace").lower() + " "
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    letter = Letters.of(codes)
    after = np.concatenate([[False], letter[:-1]])
    keep = letter | after
    return np.where(letter, codes, np.uint32(SPACE))[keep]


def chunks(rows: Iterator[tuple[object, np.ndarray]], size: int = CHUNK) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(keys, owner, windows): the ``ORDER`` characters up to each position of
    about ``size`` characters of text, and whose position (by place in
    ``keys``) it is.  Positions before a text's start are spaces.  A long text
    goes on in the next chunk under the same key."""
    keys, parts, n = [], [], 0
    edge = np.full(ORDER - 1, SPACE, np.uint32)

    def cut():
        owner = np.repeat(np.arange(len(parts)), [len(p) - ORDER + 1 for p in parts])
        windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(p, ORDER) for p in parts])
        return keys, owner, windows

    for key, codes in rows:
        codes = np.concatenate([edge, codes])
        for at in range(0, len(codes) - ORDER + 1, size):
            parts.append(codes[at:at + size + ORDER - 1])
            keys.append(key)
            n += len(parts[-1])
            if n >= size:
                yield cut()
                keys, parts, n = [], [], 0
    if parts:
        yield cut()


def hashed(windows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(windows), 0x9E3779B97F4A7C15 + windows.shape[1], np.uint64)
    for column in range(windows.shape[1]):
        h ^= windows[:, column].astype(np.uint64)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


# --- learning ---------------------------------------------------------------

def _part(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(-1))


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learned from: crc32 of the id as text, mod 5, is 0."""
    return _part(doc_id) == 0


def counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, c): how often each run of ``ORDER`` characters occurs in
    the texts of a language.  Tasks count before anything is shuffled."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for keys, owner, windows in chunks(zip(langs, map(read, texts(batch, "text")))):
                place = {lang: i for i, lang in enumerate(dict.fromkeys(keys))}
                lang = np.array([place[k] for k in keys], np.int64)[owner]
                key = hashed(np.column_stack([windows, lang.astype(np.uint32)]))
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                grams = windows[first].astype("<u4").tobytes().decode("utf-32-le", "replace")
                names = list(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in lang[first]], pa.string()),
                     pa.array([grams[k:k + ORDER] for k in range(0, len(grams), ORDER)], pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "gram", "c"])

    found = rows.select("lang", "text").mapInArrow(each, "lang string, gram string, c bigint")
    return stored(found.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "gram-counts")


def kneser_ney(top: DataFrame) -> DataFrame:
    """(lang, kind, gram, value): log-probabilities (kind ``p``) and the logs
    of the contexts' left-over weights (kind ``b``), from the counts of the
    highest order."""
    by_order = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        lower = by_order[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        by_order[k] = stored(lower, f"order-{k}")
    n_chars = by_order[1].select("gram").distinct().count() + 1  # and one that was never seen
    model = []
    below = None
    for k in range(1, ORDER + 1):
        grams = by_order[k].withColumn("context", F.substring("gram", 1, k - 1))
        once, twice = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        # Where counts of one or two are missing the discount is a half.
        discount = grams.groupBy("lang").agg(F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("d"))
        total = grams.groupBy("lang", "context").agg(F.sum("c").alias("t"), F.count("*").alias("kinds"))
        left = stored(total.join(F.broadcast(discount), "lang")
                      .withColumn("left", F.col("d") * F.col("kinds") / F.col("t")), f"contexts-{k}")
        own = grams.join(left, ["lang", "context"]).withColumn("own", (F.col("c") - F.col("d")) / F.col("t"))
        if below is None:
            p = own.select("lang", "gram", (F.col("own") + F.col("left") / n_chars).alias("p"))
            # A character that was never seen: kind "p" of the empty n-gram.
            model.append(left.select("lang", F.lit("p").alias("kind"), F.lit("").alias("gram"), F.log(F.col("left") / n_chars).alias("value")))
        else:
            lower = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
            p = (own.withColumn("suffix", F.substring("gram", 2, k - 1)).join(lower, ["lang", "suffix"])
                 .select("lang", "gram", (F.col("own") + F.col("left") * F.col("q")).alias("p")))
            model.append(left.select("lang", F.lit("b").alias("kind"), F.col("context").alias("gram"), F.log("left").alias("value")))
        below = stored(p, f"model-{k}")
        model.append(below.select("lang", F.lit("p").alias("kind"), "gram", F.log("p").alias("value")))
    out = model[0]
    for more in model[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Model:
    """One language's part of a block: (sorted hashes, values) by (kind, length)."""

    tables: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]

    def find(self, kind: str, windows: np.ndarray) -> np.ndarray:
        """Values of the rows' n-grams; nan where there is none."""
        keys, values = self.tables.get((kind, windows.shape[1]), (np.zeros(0, np.uint64), np.zeros(0)))
        out = np.full(len(windows), np.nan)
        if len(keys):
            want = hashed(windows)
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = keys[at] == want
            out[hit] = values[at[hit]]
        return out

    def logp(self, windows: np.ndarray) -> np.ndarray:
        """Log-probability of each row's last character after the others."""
        out, weight = np.zeros(len(windows)), np.zeros(len(windows))
        rest = np.arange(len(windows))
        for k in range(ORDER, -1, -1):
            found = self.find("p", windows[rest, ORDER - k:])
            hit = ~np.isnan(found)
            out[rest[hit]] = weight[rest[hit]] + found[hit]
            rest = rest[~hit]
            if k > 1 and len(rest):
                weight[rest] += np.nan_to_num(self.find("b", windows[rest, ORDER - k:ORDER - 1]))
        return out


def models(rows: DataFrame, langs: list[str]) -> list[Model]:
    """The block's rows (lang, kind, gram, value) as sorted hash arrays."""
    got = rows.select("lang", "kind", "gram", F.char_length("gram").alias("k"), "value").toArrow()
    found = {name: {} for name in langs}
    frame = got.to_pandas()
    for (lang, kind, k), part in frame.groupby(["lang", "kind", "k"]):
        codes = np.frombuffer("".join(part["gram"]).encode("utf-32-le"), np.uint32).reshape(len(part), k)
        keys = hashed(codes)
        order = np.argsort(keys, kind="stable")
        found[lang][kind, int(k)] = keys[order], part["value"].to_numpy()[order]
    return [Model(found[name]) for name in langs]


# --- scoring ----------------------------------------------------------------

def _sums(docs: DataFrame, sent: Sent, block: int, blocks: int) -> DataFrame:
    """``sums`` (one a language) and ``n`` of each document row, with what the
    block adds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = sent.value
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            sums = np.array(batch.column("sums").to_pylist(), float).reshape(batch.num_rows, len(langs))

            def rows():
                for i, text in enumerate(texts(batch, "text")):
                    codes = read(text)
                    size[i] = len(codes)
                    yield i, codes

            for keys, owner, windows in chunks(rows()):
                if blocks > 1:
                    mine = windows[:, ORDER - 2] % np.uint32(blocks) == block
                    owner, windows = owner[mine], windows[mine]
                _, first, place = np.unique(hashed(windows), return_index=True, return_inverse=True)
                whose = np.array(keys, np.int64)
                for j, model in enumerate(langs):
                    value = model.logp(windows[first])
                    np.add.at(sums[:, j], whose, np.bincount(owner, value[place], len(keys)))
            columns = [batch.column(c) for c in batch.schema.names if c not in ("n", "sums")]
            names = [c for c in batch.schema.names if c not in ("n", "sums")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(size), pa.array(sums.tolist(), pa.list_(pa.float64()))],
                                             names=[*names, "n", "sums"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("n", "sums"))
    return docs.select(*[f.name for f in docs.schema if f.name not in ("n", "sums")], "sums").mapInArrow(
        each, f"{kept}, n bigint, sums array<double>")


def cross_entropies(docs: DataFrame, model: DataFrame, langs: list[str], block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``docs`` (with a column ``text``) and ``n``, the characters read, and
    ``sums``, their log-probability by each language of ``langs``."""
    spark = docs.sparkSession
    model = stored(model, "model")
    blocks = max(1, -(-model.count() // block_entries))
    # The character before the predicted one; the lowest order has none and is in every block.
    last = F.when((F.col("kind") == "p"), F.substring("gram", -2, 1)).otherwise(F.substring("gram", -1, 1))
    everywhere = (F.col("kind") == "p") & (F.char_length("gram") < 2)
    dealt = model.withColumn("_code", F.ascii(last)).withColumn("_all", everywhere)
    out = docs.withColumn("sums", F.array_repeat(F.lit(0.0), len(langs)))
    for block in range(blocks):
        rows = dealt.where(F.col("_all") | (F.col("_code") % blocks == block)) if blocks > 1 else model
        out = _sums(out, Sent(spark, models(rows, langs)), block, blocks)
        if block + 1 < blocks:
            out = stored(out, "partial-sums")
    return out


def lead(n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language of the lowest cross-entropy per character, and the features
    of its chance of being right: 1, the lead, the lead times the root of the
    length."""
    cross = -sums / np.maximum(n, 1)[:, None]
    best = np.argmin(cross, axis=1)
    two = np.partition(cross, 1, axis=1)[:, :2] if cross.shape[1] > 1 else np.zeros((len(n), 2))
    gap = np.minimum(two.max(axis=1) - two.min(axis=1), 5.0)
    return best, np.stack([np.ones(len(n)), gap, gap * np.sqrt(np.minimum(n, 400))], axis=1)


def logistic(features: np.ndarray, right: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps with a small ridge."""
    w = np.zeros(features.shape[1])
    ridge = np.full(len(w), 1e-2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        slope = features.T @ (right - p) - ridge * w
        curve = (features * (p * (1 - p))[:, None]).T @ features + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Identifier:
    """What is learned: the stored model, its languages and the calibration."""

    model: DataFrame
    langs: list[str]
    weights: np.ndarray


def _languages(rows: DataFrame) -> list[str]:
    return sorted(r[0] for r in rows.select("lang").distinct().collect())


def learn(docs: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Identifier:
    """Models from every document that is not held out and has a language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    grams = counts(rows.withColumn("lang", F.concat(F.when(_part(F.col("doc_id")) == 1, "1").otherwise("0"), "lang")))
    every = grams.groupBy(F.substring("lang", 2, 1 << 30).alias("lang"), "gram").agg(F.sum("c").alias("c"))
    seen = grams.where("lang like '0%'").select(F.substring("lang", 2, 1 << 30).alias("lang"), "gram", "c")
    final = kneser_ney(stored(every, "counts"))
    # The calibration's documents are unknown to the models that it looks at.
    seen = stored(seen, "seen-counts")
    names = _languages(seen)
    apart = rows.where(_part(F.col("doc_id")) == 1)
    share = min(1.0, calibration_rows / max(1, apart.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 30))
    apart = apart.where(draw < int(share * (1 << 30)))
    weights = np.zeros(3)
    if names:
        scored = cross_entropies(stored(apart, "calibration"), kneser_ney(seen), names).where("n > 0").select("lang", "n", "sums").toArrow().to_pydict()
        if scored["n"]:
            best, features = lead(np.array(scored["n"]), np.array(scored["sums"], float))
            weights = logistic(features, np.array([names[b] == t for b, t in zip(best, scored["lang"])], float))
    return Identifier(final, _languages(every), weights)


def identify(docs: DataFrame, known: Identifier, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(doc_id, lang_pred, score, rejected, cross_entropy) per document row."""
    rows = id_and_text(docs)
    schema = "doc_id bigint, lang_pred string, score double, rejected boolean, cross_entropy double"
    if not known.langs:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"),
                           F.lit(None).cast("double").alias("cross_entropy"))
    langs, weights = np.array(known.langs, object), known.weights

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            sums = np.array(batch.column("sums").to_pylist(), float).reshape(len(n), len(langs))
            best, features = lead(n, sums)
            score = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
            score = np.where(n > 0, score, 0.0)
            cross = -sums[np.arange(len(n)), best] / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.where(n > 0, langs[best], UNKNOWN).tolist(), pa.string()), pa.array(score),
                 pa.array(score < REJECT), pa.array(cross, mask=n == 0)], names=["doc_id", "lang_pred", "score", "rejected", "cross_entropy"])

    summed = cross_entropies(rows, known.model, known.langs, block_entries)
    return summed.select("doc_id", "n", "sums").mapInArrow(each, schema)


def judged(docs: DataFrame) -> DataFrame:
    """Learned from ``docs`` itself: (doc_id, held_out, lang_pred, score,
    rejected, cross_entropy) of every row."""
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")
