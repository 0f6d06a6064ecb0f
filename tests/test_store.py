"""Table writes off the happy path: null partitions, very many partitions,
emptied days, staging, the MERGE statement and the shared folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from attrlake import session
from attrlake.store import LakeTable


def rows(spark, n, every):
    """``n`` ids over ``n`` days; every ``every``-th day is null."""
    return spark.range(n).select(F.when(F.col("id") % every != 0, F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))).alias("day"),
                                 F.col("id"), F.lit("a").alias("v"))


@pytest.mark.parametrize("n", [30, 4100])
def test_null_and_many_partitions_behave_alike(spark, tmp_path, n):
    table = LakeTable(spark, f"{tmp_path}/t", ["day"])
    batch = rows(spark, n, 10)
    table.append(batch.coalesce(1))
    table.insert_new(batch, ["day", "id"])
    assert table.read().count() == n
    assert table.touched(batch).where("day is null").count() == n // 10


def test_upsert_keeps_null_partition_and_cleans_its_staging(spark, tmp_path):
    table = LakeTable(spark, f"{tmp_path}/t", ["day"])
    table.append(rows(spark, 40, 4))
    staging = f"{session.shared_dir(spark).removeprefix('file:')}/staging"
    before = set(os.listdir(staging)) if os.path.isdir(staging) else set()
    table.upsert(rows(spark, 44, 4).where("id % 8 = 0 or id >= 40").withColumn("v", F.lit("b")), ["id"])
    got = {r.id: r.v for r in table.read().collect()}
    assert got == {k: "b" if k % 8 == 0 or k >= 40 else "a" for k in range(44)}
    assert (set(os.listdir(staging)) if os.path.isdir(staging) else set()) == before


def test_a_requested_day_without_rows_is_emptied(spark, tmp_path):
    table = LakeTable(spark, f"{tmp_path}/t", ["day"])
    table.append(rows(spark, 6, 100))
    day = dt.date(2000, 1, 4)
    left = spark.createDataFrame(table.read().where("id in (1, 2)").collect(), table.read().schema)
    table.replace_partitions(left, [(day,), (dt.date(2000, 1, 2),), (dt.date(2000, 1, 3),)])
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 4, 5]


def test_merge_statement_parses(spark):
    table = LakeTable(spark, "lake.gold.dim_app", fmt="iceberg")
    parser = spark._jsparkSession.sessionState().sqlParser()
    for only in (False, True):
        plan = parser.parsePlan(table.merge_statement("src", ["app_token", "day"], only))
        assert plan.nodeName() == "MergeIntoTable"


def test_a_cluster_needs_a_shared_folder():
    assert os.path.isdir(session._own_folder("local[4]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session._own_folder(master)
