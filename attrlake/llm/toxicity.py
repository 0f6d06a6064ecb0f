"""Toxicity by a weighted finite-state pattern grammar.

Words map to symbols (insult, threat, target, negation, reported speech).
Five small transducers, one per pattern, each read the symbols of a clause
and emit a weight; ``compose`` turns them into one deterministic machine whose
state is the tuple of theirs, and a clause's score is the weight of its path.
Words alone are not scored: an insult aimed at a target weighs more, one that
is denied or only reported weighs less.

The insult lexicon starts from the fixed words below and gains word stems
from labelled rows: a stem (first 3 to 10 letters, or a whole word) is taken
when its documents, or those that hold it at least twice, are toxic far beyond
the base rate.  A logistic step on
the document's strongest clause and sum of clauses yields the score.

Only the labelled sample (at most ``SAMPLE`` rows, copies and near copies
reduced to one by their smallest shingle hash) is used to fit; every document
is scored over its whole text.

Edge cases: null texts count as empty and get the base score; null labels are
left out; without labels of both kinds the fixed words alone decide; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import Sent, doc_rows, held_out, id_and_text, labelled_sample, stored, texts

SAMPLE = 20_000
MAX_STEMS = 50_000
#: Least share of toxic documents among those that hold a stem: for stems that
#: are learned first, and for those learned where the first find nothing.
SHARES = (0.9, 0.6)
#: Tasks that read the sample.
TASKS = 32
#: Ends the name of a stem that counts only in documents that hold it twice.
TWICE = "+"
THRESHOLD = 0.3
STEM = range(3, 11)
#: Weight of a fixed insult or threat before any label is seen, and the most a
#: learned stem can weigh.
FIXED_WEIGHT, MOST_WEIGHT = 3.0, 6.0

# Fixed word lists of the grammar.
INSULTS = "idiot moron scum trash stupid worthless disgusting loser clown pathetic imbecile filthy dumb vermin".split()
THREATS = "kill hurt destroy murder stab shoot burn beat smash".split()
TARGETS = "you your yours u they them their he him his she her people everyone".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nicht kein pas jamais nunca".split()
REPORTS = "said says say wrote writes quoted quote reported claimed called tweeted sagte dit dijo".split()

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")

State = int
Step = tuple[State, float]


@dataclass(frozen=True)
class Transducer:
    """Deterministic and weighted: ``arcs[state, symbol]`` is the next state
    and what the arc weighs, per unit of the symbol's own weight and flat; an
    absent symbol leads to ``rest[state]``."""

    arcs: dict[tuple[State, str], tuple[State, float, float]]
    rest: dict[State, State]

    def step(self, state: State, symbol: str) -> tuple[State, float, float]:
        return self.arcs.get((state, symbol), (self.rest.get(state, 0), 0.0, 0.0))


def _reach(n: int) -> dict[State, State]:
    """States n..1 count down to 0."""
    return {k: k - 1 for k in range(1, n + 1)} | {0: 0}


def _on(n: int, openers: str, weighed: str, own: float, flat: float) -> Transducer:
    """After a symbol of ``openers``, for ``n`` words, ``weighed`` symbols get
    weight ``own`` x theirs + ``flat``."""
    arcs = {}
    for state in range(n + 1):
        for s in openers:
            arcs[state, s] = (n, 0.0, 0.0)
        for s in weighed:
            go = n if s in openers else max(state - 1, 0)
            arcs[state, s] = (go, own, flat) if state else (go, 0.0, 0.0)
    return Transducer(arcs, _reach(n))


#: I insult, W threat, T target, N negation, R reported speech, O other.
INSULT = Transducer({(0, "I"): (0, 1.0, 0.0)}, {0: 0})
THREAT = _on(4, "W", "T", 0.0, 2.0)
TARGET = _on(4, "T", "I", 0.25, 0.5)
NEGATION = _on(3, "N", "I", -0.6, 0.0)
REPORT = _on(8, "R", "IW", -0.5, 0.0)


def compose(*parts: Transducer, symbols: str = "IWTNRO") -> dict[tuple[tuple[State, ...], str], tuple[tuple[State, ...], float, float]]:
    """The product machine of all states reachable from the start."""
    start = (0,) * len(parts)
    table, todo = {}, [start]
    while todo:
        state = todo.pop()
        for symbol in symbols:
            steps = [p.step(s, symbol) for p, s in zip(parts, state)]
            after = tuple(s[0] for s in steps)
            if (state, symbol) not in table:
                table[state, symbol] = after, sum(s[1] for s in steps), sum(s[2] for s in steps)
                if not any((after, x) in table for x in symbols[:1]):
                    todo.append(after)
    return table


def _features(word: str) -> list[str]:
    return [word[:n] for n in STEM if len(word) >= n] + [word + "$"]


@dataclass
class Model:
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -2.2
    slopes: tuple[float, float] = (1.0, 0.5)

    def ready(self) -> Model:
        """Build the machine and the word table of one task."""
        self.machine = compose(INSULT, THREAT, TARGET, NEGATION, REPORT)
        self.fixed = ({w: ("I", FIXED_WEIGHT) for w in INSULTS} | {w: ("W", FIXED_WEIGHT) for w in THREATS}
                      | {w: ("T", 0.0) for w in TARGETS} | {w: ("N", 0.0) for w in NEGATIONS} | {w: ("R", 0.0) for w in REPORTS})
        self.known: dict[str, tuple[str, float, tuple[tuple[str, float], ...]]] = {}
        return self

    def symbol(self, word: str) -> tuple[str, float, tuple[tuple[str, float], ...]]:
        """Symbol and weight, and the stems that may add weight if the
        document holds them twice."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            kind, weight = self.fixed.get(word, ("O", 0.0))
            stem, twice = 0.0, ()
            if kind in "IO":
                features = _features(word)
                stem = max((self.stems.get(f, 0.0) for f in features), default=0.0)
                twice = tuple((f, w) for f in features if (w := self.stems.get(f + TWICE, 0.0)) > max(stem, weight))
            got = ("I", max(stem, weight), twice) if stem > 0 else (kind, weight, twice)
            self.known[word] = got
        return got

    def clause(self, words: list[str], twice: set[str]) -> float:
        state, total = (0,) * 5, 0.0
        for word in words:
            symbol, weight, more = self.symbol(word)
            if more and (found := max((w for f, w in more if f in twice), default=0.0)) > weight:
                symbol, weight = "I", found
            state, own, flat = self.machine[state, symbol]
            total += own * weight + flat
        return max(total, 0.0)

    def evidence(self, text: bytes) -> tuple[float, float]:
        """Strongest clause, and log of one plus the sum of all."""
        lower = text.decode("utf-8", "replace").lower()
        words = Counter(_WORD.findall(lower))
        held: Counter[str] = Counter()
        hit = False
        for word, n in words.items():
            kind, _, more = self.symbol(word)
            hit = hit or kind in "IW"
            for f, _ in more:
                held[f] += n
        twice = {f for f, n in held.items() if n > 1}
        if not hit and not twice:
            return 0.0, 0.0  # no arc with a weight can be taken
        scores = [self.clause(_WORD.findall(c), twice) for c in _CLAUSE.split(lower)]
        return max(scores), math.log1p(sum(scores))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + evidence @ np.array(self.slopes), -30, 30)))


def _signature(text: bytes) -> int:
    """Smallest hash of the text's five-word shingles: equal for copies and
    for most near copies."""
    words = text.split()
    return min((zlib.crc32(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0)


def _training(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_signature(t) for t in texts(batch, "text")], pa.int64()),
                                              batch.column("y"), batch.column("text")], names=["signature", "y", "text"])

    rows = labelled_sample(docs, labels, label, sample).where("y in (0, 1)").select("y", "text")
    rows = rows.mapInArrow(each, "signature bigint, y int, text string")
    return stored(rows.groupBy("signature", "y").agg(F.min("text").alias("text")).repartition(TASKS, "signature"), "toxicity-sample")


def _stem_counts(rows: DataFrame, wanted: Callable[[], set[str] | None], name: str) -> DataFrame:
    """Documents that hold each feature, summed per batch before the shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = wanted()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                counts: Counter[str] = Counter()
                for t in texts(batch.slice(k, 256), "text"):
                    held: Counter[str] = Counter()
                    for w, n in Counter(_WORD.findall(t.decode("utf-8", "replace").lower())).items():
                        for f in _features(w):
                            if only is None or f in only:
                                held[f] += n
                    counts.update(held.keys())
                    counts.update([f + TWICE for f, n in held.items() if n > 1])
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                                 names=["stem", "n"])

    return rows.select("text").mapInArrow(each, "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias(name))


def _unexplained(rows: DataFrame, model: Model) -> DataFrame:
    """The sample rows in which ``model`` finds nothing."""
    sent = Sent(rows.sparkSession, model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value.ready()
        for batch in batches:
            none = [ready.evidence(t)[0] == 0 for t in texts(batch, "text")]
            yield batch.filter(pa.array(none, pa.bool_()))

    return stored(rows.select("y", "text").mapInArrow(each, "y int, text string"), "unexplained")


def learn_stems(rows: DataFrame, least_share: float) -> dict[str, float]:
    """Stems whose share of toxic documents can't be chance, with their log
    odds.  The sample bounds every count and list here."""
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(n) < 2:
        return {}
    base = n[1] / (n[0] + n[1])
    often = stored(_stem_counts(rows.where("y = 1"), lambda: None, "pos").where("pos >= 3"), "stems")
    total = often.count()
    # Expected to be chance in fewer than one of a hundred fits.
    bound = math.log(max(total, 1)) + math.log(100)
    # What can't pass even without a clean document is not counted further.
    often = often.where(F.col("pos") * math.log(1 / base) >= bound)
    listed = {r.stem: r.pos for r in often.orderBy(F.desc("pos"), "stem").limit(4 * MAX_STEMS).collect()}
    sent = Sent(rows.sparkSession, frozenset(s.removesuffix(TWICE) for s in listed))
    clean = {r.stem: r.neg for r in _stem_counts(rows.where("y = 0"), lambda: sent.value, "neg").collect()}
    found = {}
    for stem, pos in listed.items():
        neg = clean.get(stem, 0)
        share = pos / (pos + neg)
        if share <= max(base, least_share):
            continue
        far = share * math.log(share / base) + ((1 - share) * math.log((1 - share) / (1 - base)) if neg else 0)
        if (pos + neg) * far >= bound:
            found[stem] = min(MOST_WEIGHT, math.log((pos + 0.5) / (n[1] + 1)) - math.log((neg + 0.5) / (n[0] + 1)))
    best = sorted(found, key=lambda s: (-found[s] * listed[s], s))[:MAX_STEMS]
    return {s: found[s] for s in best if found[s] > 0}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton steps with a small ridge, slopes held at or above 0."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-6] + [0.05] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        w[1:] = np.maximum(w[1:], 0.0)
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    rows = _training(docs, labels, label, sample)
    model = Model()
    rest = rows
    for share in SHARES:
        model.stems = learn_stems(rest, share) | model.stems
        rest = _unexplained(rest, model) if share != SHARES[-1] else rest
    sent = Sent(rows.sparkSession, model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value.ready()
        for batch in batches:
            e = np.array([ready.evidence(t) for t in texts(batch, "text")]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1]), batch.column("y")], names=["top", "total", "y"])

    got = rows.mapInArrow(each, "top double, total double, y int").collect()  # at most ``sample`` rows
    y = np.array([r.y for r in got], float)
    if 0 < y.sum() < len(y):
        w = _logistic(np.array([(r.top, r.total) for r in got]), y)
        model.bias, model.slopes = float(w[0]), (float(w[1]), float(w[2]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document row."""
    sent = Sent(docs.sparkSession, model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value.ready()
        for batch in batches:
            e = np.array([ready.evidence(t) for _, t in doc_rows([batch])]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ready.score(e))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(each, "doc_id bigint, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: held_out, score and the verdict at ``threshold``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
