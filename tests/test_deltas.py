"""Delta tables: a batch adds files and rewrites none; folds and compaction."""

import pytest
from pyspark.sql import functions as F

from attrlake.batch import compact_keyed, rebuild_dimensions
from attrlake.operators import dims as D
from attrlake.operators import silver as S
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.streaming import deltas as K
from attrlake.streaming import pipeline as P
from attrlake.streaming.runner import Lake

from conftest import SF_SMALL


def state(table):
    return sorted(map(tuple, table.read().select("id", "op", "value", "lsn").collect()), key=str)


def files(table, spark):
    """Name, length and time of every data file below the table."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table.location)
    it = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = set()
    while it.hasNext():
        f = it.next()
        if f.getPath().getName().endswith(".parquet"):
            found.add((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return found


@pytest.fixture(scope="module")
def changes(spark):
    return Qy.unwrapped_changes(spark, SF_SMALL).persist()


def test_sixty_changed_ids_add_files_and_rewrite_none(spark, changes):
    table = K.current_state_table(spark, run_dir(spark, "t-delta"), compact_every=None)
    table.append(changes)
    table.compact()
    before, rows = files(table, spark), state(table)
    some = changes.where("op = 'c'").select("id").distinct().orderBy("id").limit(60)
    update = (changes.join(some, "id", "left_semi").where("op = 'c'").dropDuplicates(["id"])
              .withColumn("lsn", F.col("lsn") + 1_000_000_000).withColumn("value", F.lit(-1.0)))
    table.append(update, 1)
    after = files(table, spark)
    assert before < after  # nothing removed, nothing touched, something added
    assert state(table) != rows and sum(r[2] == -1.0 for r in state(table)) == 60
    rows = state(table)
    assert table.compact() == 2 and table.deltas() == []
    assert state(table) == rows


def test_any_split_and_replay_is_the_batch_form(spark, changes):
    want = sorted(map(tuple, S.latest_changes(changes).select("id", "op", "value", "lsn").collect()), key=str)
    table = K.current_state_table(spark, run_dir(spark, "t-delta-split"), compact_every=2)
    parts = [changes.where(F.pmod(F.xxhash64("id", "op"), F.lit(3)) == k) for k in (2, 0, 1)]
    for k, part in enumerate([*parts, parts[0]]):  # out of order, one replayed
        table.append(part, k)
        table.append(part.limit(0), k)
    assert state(table) == want
    assert table.generation() >= 2


def test_a_compaction_or_batch_that_died_changes_nothing(spark, changes):
    table = K.current_state_table(spark, run_dir(spark, "t-delta-died"), compact_every=None)
    table.append(changes.where("op <> 'd'"))
    table.compact()
    table.append(changes.where("op = 'd'"), 1)
    rows = state(table)
    # What a run leaves that stops before its marker: files of the next base and of a batch.
    no_marker = changes.withColumn("value", F.lit(0.0)).withColumn("lsn", F.lit(1 << 40))
    before = spark.conf.get("mapreduce.fileoutputcommitter.marksuccessfuljobs", None)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        no_marker.write.parquet(f"{table.location}/base/generation=2")
        no_marker.write.parquet(f"{table.location}/delta/000000000002-dead")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs") if before is None else None
    assert table.generation() == 1 and len(table.deltas()) == 1
    assert state(table) == rows
    assert table.compact() == 2 and state(table) == rows


def test_a_reader_that_began_before_a_compaction_still_finds_its_files(spark, changes):
    table = K.current_state_table(spark, run_dir(spark, "t-delta-reader"), compact_every=None)
    table.append(changes)
    table.compact()
    table.append(changes.where("id % 3 = 0").withColumn("lsn", F.col("lsn") + 10 ** 9), 1)
    began = table.read()
    n = table.read().count()
    table.compact()
    assert began.count() == n


def test_base_rows_without_a_change_are_not_shuffled(spark, changes):
    table = K.current_state_table(spark, run_dir(spark, "t-delta-plan"), compact_every=None)
    table.append(changes)
    table.compact()
    table.append(changes.limit(5).withColumn("lsn", F.col("lsn") + 10 ** 9), 1)
    read = table.read()
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.find("Initial Plan")] if "Initial Plan" in plan else plan
    anti = next(line for line in plan.splitlines() if "LeftAnti" in line)
    assert "BroadcastHashJoin" in anti


def test_dimension_deltas_equal_the_batch_form_and_can_be_rebuilt(spark):
    lake = Lake(spark, run_dir(spark, "t-delta-dim"), keyed="deltas", compact_every=None)
    silver = Qy.silver_rows(spark, SF_SMALL)
    lake.silver.append(silver)
    for name, (key, attributes) in D.DIMENSIONS.items():
        want = sorted(map(tuple, D.latest_attributes(silver, key, attributes).collect()))
        for k, part in enumerate((silver.where("id % 2 = 1"), silver.where("id % 2 = 0"), silver.where("id % 2 = 1"))):
            P.upsert_dimension(part, lake.dim(name), name, k)
        assert sorted(map(tuple, lake.dim(name).read().collect())) == want
    compact_keyed(lake)
    assert lake.dim("dim_app").generation() == 1 and lake.dim("dim_app").deltas() == []
    rebuild_dimensions(lake)
    assert sorted(map(tuple, lake.dim(name).read().collect())) == want


def test_null_keys_and_an_empty_table(spark):
    table = K.current_state_table(spark, run_dir(spark, "t-delta-null"), compact_every=None)
    schema = "id bigint, op string, value double, lsn bigint"
    frame = spark.createDataFrame([], schema)
    assert table.read(frame.schema).count() == 0 and not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(spark.createDataFrame([(None, "c", 1.0, 1), (1, "c", 1.0, 1)], schema))
    table.compact()
    table.append(spark.createDataFrame([(None, "u", 2.0, 2)], schema), 1)
    assert state(table) == sorted([(None, "u", 2.0, 2), (1, "c", 1.0, 1)], key=str)
    with pytest.raises(ValueError):
        Lake(spark, "x", keyed="piles").dim("dim_app")


def test_a_table_keeps_the_form_it_has(spark):
    root = run_dir(spark, "t-form")
    silver = Qy.silver_rows(spark, SF_SMALL)
    for form in ("buckets", "deltas"):
        P.upsert_dimension(silver, Lake(spark, f"{root}/{form}", keyed=form).dim("dim_app"), "dim_app")
        for other in ("buckets", "deltas"):
            table = Lake(spark, f"{root}/{form}", keyed=other).dim("dim_app")
            assert isinstance(table, K.DeltaTable) == (form == "deltas") and table.read().count() == 3
