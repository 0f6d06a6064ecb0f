"""Quality classifier: random Fourier features of document statistics.

Features approximate a Gaussian kernel; ridge weights solve normal equations
that every partition sums over its own rows; an isotonic step, fitted on rows
the weights never saw, turns scores into probabilities.  Only the labelled
sample (at most ``SAMPLE`` rows) is used to fit; statistics are computed over
whole texts and every document is scored.

Edge cases: a null text counts as empty and is scored; null labels are left
out; with no labels of both kinds every score is the share of label 1 (0.5
without labels); extra columns are ignored or, in ``keep_good``, kept.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import Sent, doc_rows, held_out, id_and_text, labelled_sample, stored, texts

SAMPLE = 20_000
FOURIER = 256
RIDGE = 1e-3
#: Width of the kernel, in standard deviations per square root of dimension.
WIDTH = 1.0
THRESHOLD = 0.7
SEED = 10


def _of_bytes(*spans: tuple[int, int]) -> np.ndarray:
    mask = np.zeros(256)
    for a, b in spans:
        mask[a:b + 1] = 1
    return mask


_CLASSES = np.stack([
    _of_bytes((0x41, 0x5A)), _of_bytes((0x61, 0x7A)), _of_bytes((0x30, 0x39)), _of_bytes((0x20, 0x20), (0x09, 0x0D)),
    _of_bytes((0x80, 0xBF)), _of_bytes((0xC0, 0xFF)), _of_bytes((0x2C, 0x2C), (0x2E, 0x2E)), _of_bytes((0x21, 0x21), (0x3F, 0x3F)),
    _of_bytes((0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
], axis=1)


def statistics(text: bytes) -> np.ndarray:
    """Scale-free measures of one whole text, all in about -3 to 3."""
    out = np.zeros(20)
    size = len(text)
    if not size:
        return out
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = histogram / size
    out[:9] = np.sqrt(share @ _CLASSES)
    words = text.split()
    n = len(words)
    out[9], out[10] = np.log1p(size) / 10, np.log1p(n) / 10
    seen = share[share > 0]
    out[11] = -(seen * np.log(seen)).sum() / 4
    out[12] = len(zlib.compress(text, 1)) / (size + 20)
    if n:
        lower = text.lower().split()
        counts = Counter(lower)
        pairs = len(set(zip(lower, lower[1:])))
        out[13] = np.log1p(size / n) / 3
        out[14] = len(counts) / n
        out[15] = (pairs + 1) / n
        out[16] = np.sqrt(max(counts.values()) / n)
        out[17] = np.sqrt(sum(a == b for a, b in zip(lower, lower[1:])) / n)
        lines = text.split(b"\n")
        out[18] = 1 - len(set(lines)) / len(lines)
        out[19] = np.log1p(n / len(lines)) / 5
    return out


DIM = len(statistics(b""))


@dataclass
class Model:
    """Everything a task needs to score: a few hundred kB, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.cos((x - self.mean) / self.scale @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _features(sample: DataFrame) -> DataFrame:
    """(fold, y, x): fold by a hash of the text, so copies never part."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["fold", "y", "x"])

    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(3)).cast("int")
    return sample.select(fold.alias("fold"), "y", "text").mapInArrow(each, "fold int, y int, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)


def _summed(rows: DataFrame, part) -> np.ndarray:
    """Sum over partitions of ``part(x, y)`` (a small matrix): each partition
    adds up its own rows, row vectors are then added by row number."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                m = part(_matrix(batch), batch.column("y").to_numpy(zero_copy_only=False).astype(float))
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                             names=["i", "v"])

    def add(key, pdf):
        return pdf.head(1).assign(v=[np.sum(np.stack(pdf.v.to_list()), axis=0)])

    got = rows.mapInArrow(local, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    return np.array([r.v for r in sorted(got, key=lambda r: r.i)])


def isotonic(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted scores; knots and levels of the
    pools' means, joined linearly."""
    pools: list[list[float]] = []
    for s, y, n in zip(scores.tolist(), labels.tolist(), counts.tolist()):
        pools.append([s * n, y, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out ones."""
    rows = stored(_features(labelled_sample(docs, labels, label, sample)), "quality-features")
    draw = np.random.default_rng(SEED)
    model = Model(np.zeros(DIM), np.ones(DIM), draw.normal(size=(DIM, FOURIER)) / (WIDTH * np.sqrt(DIM)),
                  draw.uniform(0, 2 * np.pi, FOURIER), np.zeros(FOURIER + 1), np.zeros(1), np.full(1, 0.5))
    kinds = {r.y: r["count"] for r in rows.where("y in (0, 1)").groupBy("y").count().collect()}
    if len(kinds) < 2:
        if kinds:
            model.levels = np.full(1, float(next(iter(kinds))))
        return model
    rows = rows.where("y in (0, 1)")
    fitted, rest = rows.where("fold < 2"), rows.where("fold = 2")
    if fitted.select("y").distinct().count() < 2 or rest.select("y").distinct().count() < 2:
        fitted = rest = rows
    moments = _summed(fitted, lambda x, y: np.stack([np.ones(DIM) * len(x), x.sum(0), (x * x).sum(0)]))
    n = moments[0, 0]
    model.mean = moments[1] / n
    model.scale = np.sqrt(np.maximum(moments[2] / n - model.mean ** 2, 0)) + 1e-6

    def normal(x, y, model=model):
        z = model.fourier(x)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    equations = _summed(fitted, normal)
    penalty = np.full(FOURIER + 1, RIDGE * n / FOURIER)
    penalty[-1] = 0
    model.weights = np.linalg.solve(equations[:, :-1] + np.diag(penalty + 1e-9), equations[:, -1])

    def scored(batches, model=model):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(model.raw(_matrix(batch)), 3)), batch.column("y")], names=["s", "y"])

    bins = (rest.mapInArrow(scored, "s double, y int").groupBy("s").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
            .orderBy("s").collect())
    # One row of each kind beyond the ends keeps every level off 0 and 1.
    s = np.array([bins[0].s] + [b.s for b in bins] + [bins[-1].s])
    y = np.array([1.0] + [float(b.y) for b in bins] + [0.0])
    model.knots, model.levels = isotonic(s, y, np.array([1.0] + [float(b.n) for b in bins] + [1.0]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document row."""
    sent = Sent(docs.sparkSession, model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for _, t in doc_rows([batch])]).reshape(-1, DIM)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.score(x))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(each, "doc_id bigint, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: held_out, score and the verdict at ``threshold``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    sent = Sent(docs.sparkSession, fit(docs, labels))

    def good(column: pa.Array) -> pa.Array:
        x = np.array([statistics(t) for t in texts(pa.record_batch([column], ["text"]), "text")]).reshape(-1, DIM)
        return pa.array(sent.value.score(x) >= threshold)

    # Only the text goes to Python; the rows stay where they are.
    return docs.where(F.arrow_udf(good, "boolean")(F.col("text").cast("string")))
