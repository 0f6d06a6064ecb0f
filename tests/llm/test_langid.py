"""Language identification against plain Kneser-Ney sums, on rows that nothing
was learned from, and on awkward rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from attrlake.llm import langid
from attrlake.llm.common import table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = {"aa": "the of and ship house".split(), "bb": "der das und schiff Häuser".split(), "cc": "дом и корабль на море".split()}


def prose(lang, seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(["", ", ", "!", " 12"]) for _ in range(n))


def documents():
    rows = [(k, prose(lang, k, 3 + k % 20), lang, "s", 0) for k in range(240) for lang in [sorted(WORDS)[k % 3]]]
    rows += [(300, None, "aa", "s", 0), (301, "", "aa", "s", 0), (302, "12 -- 3", "bb", "s", 0), (303, prose("aa", 1, 9), None, "s", 0)]
    rows += [(None, prose("bb", 5, 9), "bb", None, 0), (305, "𝔘𝔫𝔦 ² İstanbul", "bb", "s", 0), (306, prose("cc", 6, 60_000), "cc", "s", 0)]
    return rows + [rows[4], rows[4]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def known(docs):
    return langid.learn(docs)


def part(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def letters(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return "".join(w + " " for w in words)


class Plain:
    """Interpolated Kneser-Ney by its definition, one n-gram at a time."""

    def __init__(self, texts, n_chars):
        lines = ["   " + t for t in texts]
        self.c = {4: Counter(t[k - 3:k + 1] for t in lines for k in range(3, len(t)))}
        for k in (3, 2, 1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.n_chars = n_chars
        self.total, self.kinds, self.d = defaultdict(Counter), defaultdict(Counter), {}
        for k, grams in self.c.items():
            for g, c in grams.items():
                self.total[k][g[:-1]] += c
                self.kinds[k][g[:-1]] += 1
            once, twice = (sum(c == x for c in grams.values()) for x in (1, 2))
            self.d[k] = once / (once + 2 * twice) if once and twice else 0.5

    def p(self, gram):
        k = len(gram)
        lower = self.p(gram[1:]) if k > 1 else 1 / self.n_chars
        total = self.total[k][gram[:-1]]
        if not total:
            return lower
        own = max(self.c[k][gram] - self.d[k], 0) if self.c[k][gram] else 0
        return (own + self.d[k] * self.kinds[k][gram[:-1]] * lower) / total


def plain_models():
    learnable = defaultdict(list)
    for doc_id, text, lang, *_ in documents():
        if lang is not None and part(doc_id) != 0:
            learnable[lang].append(letters(text))
    n_chars = len({c for texts in learnable.values() for t in texts for c in t}) + 1
    return {lang: Plain([t for t in texts if t], n_chars) for lang, texts in learnable.items()}


def test_cross_entropies_are_those_of_the_definition(docs, known):
    plain = plain_models()
    assert known.langs == sorted(plain)
    got = langid.cross_entropies(docs, known.model, known.langs).where("doc_id < 40 or doc_id > 299").collect()
    assert len(got) > 40
    for row in got:
        text = letters(row.text)
        if row.n > 5000:
            continue
        assert row.n == len(text)
        for lang, total in zip(known.langs, row.sums):
            line = "   " + text
            want = sum(math.log(plain[lang].p(line[k - 3:k + 1])) for k in range(3, len(line)))
            assert total == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_probabilities_add_up_to_one():
    plain = plain_models()["bb"]
    seen = sorted(plain.c[1])
    for context in ("   ", "der", "zzz", "r d"):
        assert sum(plain.p(context + c) for c in seen) + (plain.n_chars - len(seen)) * plain.p(context + "\0") == pytest.approx(1)


def test_blocks_of_the_model_add_up(docs, known):
    whole = {(r.doc_id, r.text): r for r in langid.cross_entropies(docs, known.model, known.langs).collect()}
    size = known.model.count()
    for r in langid.cross_entropies(docs, known.model, known.langs, block_entries=size // 3).collect():
        assert r.sums == pytest.approx(whole[r.doc_id, r.text].sums, rel=1e-9, abs=1e-9)


def test_awkward_rows(docs, known):
    out = langid.judged(docs)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(documents())
    by_id = {r.doc_id: r for r in got}
    for k in (300, 301, 302):
        assert (by_id[k].lang_pred, by_id[k].score, by_id[k].rejected, by_id[k].cross_entropy) == ("und", 0.0, True, None)
    assert all(r.lang_pred in WORDS and 0 <= r.score <= 1 for r in got if r.doc_id not in (300, 301, 302))
    assert all(r.held_out == (part(r.doc_id) == 0) for r in got)
    assert all(r.rejected == (r.score < 0.5) for r in got)
    truth = {r[0]: r[2] for r in documents() if r[0] is not None and r[0] < 240}
    assert all(by_id[k].lang_pred == lang for k, lang in truth.items())


def test_held_out_rows_and_inputs_do_not_matter(spark, docs, known):
    """Other languages, sources and held-out texts leave the model and the predictions as they are."""
    changed = [(i, "zzz qqq" if part(i) == 0 else t, "xx" if part(i) == 0 else lang, "other", 9) for i, t, lang, *_ in documents()]
    again = langid.learn(spark.createDataFrame(changed, DOCS))
    order = ["lang", "kind", "gram"]
    a, b = (sorted(map(tuple, m.model.select(*order, "value").collect())) for m in (known, again))
    assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b])
    assert np.allclose(known.weights, again.weights)


def test_nothing_to_learn_one_language_and_clashing_columns(spark, docs):
    none = spark.createDataFrame([], DOCS)
    assert langid.judged(none).collect() == []
    got = langid.judged(docs.withColumn("lang", __import__("pyspark").sql.functions.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)} and len(got) == len(documents())
    one = langid.judged(docs.where("lang = 'aa' and doc_id < 100").selectExpr("*", "1 as n", "2 as sums", "'x' as gram")).collect()
    assert {r.lang_pred for r in one} == {"aa"} and all(0 <= r.score <= 1 for r in one)


def test_held_out_accuracy_on_the_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.judged(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_a_long_text_goes_through_several_chunks():
    codes = langid.read(("der das " * 900).encode())
    whole = [w for _, _, w in langid.chunks(iter([(0, codes)]))]
    parts = list(langid.chunks(iter([(0, codes), (1, codes[:10])]), 1000))
    assert len(parts) > 5 and np.array_equal(np.concatenate([w for _, _, w in parts])[:len(codes)], whole[0])
    assert sum((np.array(keys)[owner] == 1).sum() for keys, owner, _ in parts) == 10
