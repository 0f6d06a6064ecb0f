"""The Merkle manifest against a tree built in plain Python, and its SQL twin."""

import zlib
from hashlib import sha256

import duckdb
import pytest

from attrlake.llm import merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def proof(levels, k):
    """(siblings before, siblings after) of each level."""
    out = []
    for level in levels[:-1]:
        run = k - k % 16
        out.append((level[run:k], level[k + 1:run + 16]))
        k //= 16
    return out


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    ranked = {s: sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in order}
    built = {s: climb([leaf(r, r[1]) for r in ranked[s]]) for s in order}
    top = climb([built[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for k, r in enumerate(ranked[s]):
            way = proof(built[s], k) + proof(top, i)
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            node = leaf(r, text)
            for before, after in way:
                node = h(*before, node, *after)
            root = top[-1][0]
            out.append((r[0], leaf(r, r[1]), built[s][-1][0], root, h(*[x for b, a in way for x in (*b, *a)]), node, node == root))
    return sorted(out, key=str)


def rows():
    """One source of 300 leaves, a lone one, one of 17, many tiny ones, nulls, ties, repeats, a long text."""
    out = [(k, f"Text {k} ÄB", "en", "hot", k) for k in range(300)]
    out += [(1000, None, None, "lone", None)] + [(2000 + k, "a" * k, "de", "b", k) for k in range(17)]
    out += [(3000 + k, "Ünï" + str(k), "fr", f"s{k:03d}" + "é" * (k % 3), -k) for k in range(280)]
    out += [(None, "No Id", "en", None, 1), (None, "No Id", "en", None, 1), (5, "SAME id", "en", "hot", 2), (5, "", "", "", 0)]
    return out + [(9000, "LONG Text " * 50_000, "en", "hot", 7), (9001, "x", "en", "hot", 2)] + [(9002, "Copy", "en", "c", 1)] * 20


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(5)


def test_manifest_is_the_plain_tree(docs):
    assert got(merkle.manifest(docs)) == expected(rows())


@pytest.mark.parametrize("step", [1, 3])
def test_any_spacing_of_the_stored_levels_gives_the_same_proofs(docs, step):
    assert got(merkle.manifest(docs, step)) == expected(rows())


def test_sql_twin(docs):
    frame = docs.toPandas()  # noqa: F841 - read by DuckDB
    con = duckdb.connect()
    con.execute("create view documents as select cast(doc_id as bigint) as doc_id, text, lang, source, cast(n_chars as bigint) as n_chars from frame")
    assert sorted((tuple(r) for r in con.execute(merkle.oracle()).fetchall()), key=str) == expected(rows())


def test_tampering_shows(docs):
    found = {r["doc_id"]: r for r in merkle.manifest(docs).collect()}
    hit = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert hit and all(not found[k]["verified"] for k in hit if k != 5)
    assert all(found[k]["verified"] for k in range(300) if k not in hit)


def test_no_rows_one_row_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).collect() == []
    one = spark.createDataFrame([(7, "A", "en", "s", 1, "t", 5, b"x", 3)], DOCS + ", tree string, pos bigint, node binary, n int")
    assert got(merkle.manifest(one)) == expected([(7, "A", "en", "s", 1)])
    assert expected([(7, "A", "en", "s", 1)])[0][4] == sha256(b"").hexdigest()


def test_fold_and_regenerate_agree():
    nodes = [bytes([k]) * 32 for k in range(40)]
    levels = merkle.regenerate(nodes, 40, step=9)
    for k in range(40):
        assert merkle.fold(nodes[k], merkle.siblings(levels, k), k, 40) == (levels[-1][0], b"")
