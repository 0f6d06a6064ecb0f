"""The corpus pipeline, stage by stage, against brute force."""

import bisect
import collections

from attrlake.llm import common, mixing, quality
from test_operators import DOCS, counted, expected_contamination, expected_fingerprint, labelled, prose

import corpus_pipeline


def tables(spark, folder):
    """Good, bad, copied, nearly copied and contaminated documents."""
    rows, labels = labelled(spark, "quality")
    bench = [(k, prose(900 + k, 20)) for k in range(6)] + [(None, prose(990, 20)), (8, None)]
    more = [(1000 + k, prose(k, 60), "en", "copies", 0) for k in (1, 2, 3, 1, 1)]
    more = [(1000 + i, t, *r) for i, (_, t, *r) in enumerate(more)]
    more += [(1100 + k, prose(1100 + k, 30) + " " + bench[k][1], "en", None, 0) for k in range(6)]
    more += [(1200, None, "en", "s", 0), (None, prose(1200, 70), "en", "s", 0), (None, prose(1201, 70), None, "s", None), (1, prose(1, 60), "en", "s", 0)]
    rows.unionByName(spark.createDataFrame(more, DOCS)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return bench


def by_id(rows):
    return collections.Counter((r[0], r[1]) for r in rows)


def one_of_each_group(rows):
    """Brute force: (group's id, number of groups) by the closure of links."""
    fps = [expected_fingerprint(r.text) for r in rows]
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 4 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {}
    for r, f in zip(rows, fps):
        ids = least.setdefault(label[f], set())
        ids.add(r.doc_id)
    return collections.Counter(min((i for i in ids if i is not None), default=None) for ids in least.values())


def test_every_stage_is_brute_force(spark, tmp_path):
    folder = f"file://{tmp_path}"
    bench = tables(spark, folder)
    docs, seen = common.table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, folder), "stage")
        seen[name] = docs.collect(), out.collect()
        if name != "sharding":
            assert out.columns == docs.columns
            docs = out

    before, after = seen["quality classifier"]
    judged = quality.judged(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))
    good = collections.Counter(r.doc_id for r in judged.where("score >= 0.7").collect())
    assert good == collections.Counter(r.doc_id for r in after) and 400 < len(after) < len(before)

    before, after = seen["SimHash near-dedup"]
    assert collections.Counter(r.doc_id for r in after) == one_of_each_group(before)
    assert not by_id(after) - by_id(before) and {1, None} <= {r.doc_id for r in after}
    assert not {r.doc_id for r in after} & set(range(1000, 1005))

    before, after = seen["benchmark decontamination"]
    bad = {d for d, *_, verdict in expected_contamination(before, bench) if verdict}
    assert {r.doc_id for r in before} & set(range(1100, 1106)) <= bad and bad
    assert by_id(after) == by_id(r for r in before if r.doc_id not in bad)

    before, after = seen["mixing sources to target weights"]
    sizes = collections.Counter(r.source for r in before)
    share = {s: n ** 0.7 for s, n in sizes.items()}
    rate = {s: share[s] * len(before) / sum(share.values()) / n for s, n in sizes.items()}
    table = spark.createDataFrame([tuple(r) for r in before], DOCS)
    draws = table.select("doc_id", "text", "source", mixing.uniform(
        mixing.SEED, mixing.F.col("doc_id").cast("string"), mixing.F.xxhash64("text")).alias("u")).collect()
    want = collections.Counter()
    for r in draws:
        want[r.doc_id, r.text] += bisect.bisect_right(mixing.poisson_steps(rate[r.source]), r.u)
    assert by_id(after) == +want

    before, after = seen["sharding"]
    assert by_id(before) == by_id(after)
    slots = collections.defaultdict(list)
    for r in after:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1

    whole = corpus_pipeline.run(spark, folder)
    assert counted(whole.select("doc_id", "text")) == counted(spark.createDataFrame([tuple(r)[:5] for r in after], DOCS).select("doc_id", "text"))


def test_empty_tables_give_no_rows(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
