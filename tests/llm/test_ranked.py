"""Ranked search against a plain scoring of every document, and its SQL twin."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from attrlake.llm import ranked

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COMMON = [f"w{k}" for k in range(60)] + ["Über", "the", "THE", "a1"]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(COMMON[min(int(draw.expovariate(0.1)), len(COMMON) - 1)] + draw.choice(["", ",", "\n", "_"]) for _ in range(n))


def documents():
    rows = [(k, prose(k, 1 + k % 90), "en", "s", 0) for k in range(400)]
    rows += [(1000 + k, prose(5, 40), "en", "s", 0) for k in range(80)]  # more copies than ranks
    rows += [(2000, None, "en", "s", 0), (2001, "", "en", "s", 0), (2002, "... !", None, None, None), (None, prose(5, 40), "en", "s", 0)]
    return rows + [(2003, prose(77, 30_000), "en", "s", 0), rows[3], rows[3]]


ITEMS = [(1, "the w1 w1 w2 ÜBER"), (2, prose(5, 40)), (3, None), (4, "unknown words"), (5, "W3 nothing"), (5, "w4"), (None, "w5 a1"), (6, "")]


def expected(docs, items, k=50):
    bags = [(r[0], Counter(terms(r[1]))) for r in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, words in asked.items():
        found = []
        for doc_id, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m))
                        for t in words if bag[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(4)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("shard_postings, block_pairs", [(1 << 17, 1 << 19), (300, 20)])
def test_best_documents_are_those_of_a_full_scoring(docs, items, shard_postings, block_pairs):
    index = ranked.build_index(docs, shard_postings)
    assert got(ranked.search(index, items, block_pairs=block_pairs)) == expected(documents(), ITEMS)


def test_fewer_ranks(docs, items):
    assert got(ranked.search(ranked.build_index(docs, 500), items, k=3)) == expected(documents(), ITEMS, 3)


def test_sql_twin(docs, items):
    d, b = docs.toPandas(), items.toPandas()  # noqa: F841 - read by DuckDB
    con = duckdb.connect()
    con.execute("create view documents as select cast(doc_id as bigint) as doc_id, text from d")
    con.execute("create view benchmark as select cast(item_id as bigint) as item_id, text from b")
    assert sorted((tuple(r) for r in con.execute(ranked.ORACLE).fetchall()), key=str) == expected(documents(), ITEMS)


def test_the_index_holds_every_row_by_stratum_and_tf(docs):
    index = ranked.build_index(docs, 700)
    rows = index.shards.collect()
    bags = [Counter(terms(r[1])) for r in documents() if terms(r[1])]
    assert sum(len(r.doc_ids) for r in rows) == len(bags) == index.n_docs
    df = Counter()
    for r in rows:
        df.update(dict(zip(bytes(r.terms).split(b" "), r.dfs)))
        assert r.strata == sorted(set(r.strata))
        start, stratum, tf = (ranked.unpacked_ints(bytes(c)) for c in (r.cell_starts, r.cell_strata, r.cell_tfs))
        for a, b in zip(start, start[1:]):
            cells = list(zip(stratum[a:b], tf[a:b]))
            assert cells == sorted(set(cells))
    assert df == Counter(t.encode() for b in bags for t in b)


def test_strata_below_the_bound_are_not_visited(monkeypatch):
    """Ten short documents fill the ranks; long ones of the same tf can't beat them."""
    shard = ranked._Shard()
    for k in range(400):
        shard.add(k, 50 + k, b"t", ranked.packed_ints(np.array([1])))
    import pyarrow as pa
    row = pa.RecordBatch.from_pylist([shard.row()], schema=ranked._INDEX_ARROW)
    asked = ranked.Items([(1, b"t", 1000)])
    held = ranked._Postings(row, asked)
    seen = []
    add_at = np.add.at
    monkeypatch.setattr(np, "add", type("Add", (), {"at": staticmethod(lambda a, i, v: (seen.append(len(i)), add_at(a, i, v)))}))
    none = np.zeros(0, np.int64)
    best = ranked.visit(ranked.Best(none, none, none.astype(bool)), asked.asked[0], held, np.arange(400), np.zeros(400, bool), 10)
    assert best.doc_id.tolist() == list(range(10))
    assert sum(seen[1:]) < 100


def test_no_documents_no_items_and_clashing_columns(spark, docs, items):
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id bigint, text string")
    assert got(ranked.search(ranked.build_index(none), items)) == []
    assert got(ranked.search(ranked.build_index(docs), no_items)) == []
    more = docs.selectExpr("*", "1 as m", "'x' as terms", "2 as n", "3 as row", "4 as score")
    assert got(ranked.search(ranked.build_index(more), items.selectExpr("*", "1 as term", "2 as doc_id"))) == expected(documents(), ITEMS)
