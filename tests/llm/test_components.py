"""Star contraction: results by brute force, and how much work Spark's driver keeps track of."""

import random

import pytest

from attrlake.llm.components import connected_components


def closure(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def found(spark, edges):
    table = spark.createDataFrame(edges, "a bigint, b bigint").repartition(3)
    return sorted(tuple(r) for r in connected_components(table).collect())


def odd_edges():
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(150)]
    tree = [(1000 + i, 1000 + draw.randrange(i + 1)) for i in range(300)]
    hubs = [(-9, 2000 + i) for i in range(300)] + [(2299, 3000 + i) for i in range(300)]
    return chain + tree + tree[:40] + [(b, a) for a, b in tree[:40]] + hubs + [(None, 3), (4, None), (None, None), (7000, 7000)]


@pytest.mark.parametrize("edges", [[], [(5, 5), (None, 1)], [(2, 1), (1, 2)], odd_edges()], ids=["none", "loops", "one", "odd"])
def test_components_are_those_of_a_brute_force_closure(spark, edges):
    assert found(spark, edges) == closure(edges)


def test_the_number_of_tasks_stays_small(spark):
    """The driver keeps the metrics of every task: a group of near copies over
    many shuffle partitions took more than its memory."""
    edges = [(0, i) for i in range(1, 200)] + [(500 + i, 500 + i // 2) for i in range(1, 200)]
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    context = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        context.setJobGroup("components-tasks", "components")
        assert found(spark, edges) == closure(edges)
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("components-tasks") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks < 2500
