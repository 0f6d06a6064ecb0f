"""Larger tables: slices written by many tasks, batches as wide, nothing lost."""

import pytest
from pyspark.sql import functions as F

from attrlake.plans import queries as Qy
from attrlake.sources import fixtures as X
from conftest import SF_SMALL


def _files(spark, path):
    return spark.read.parquet(path).select(F.input_file_name()).distinct().count()


def _rows(df):
    return sorted(df.collect(), key=repr)


@pytest.fixture
def larger(monkeypatch):
    """The small table counts as a larger one: three pieces per slice."""
    monkeypatch.setattr(X, "ROWS_PER_PIECE", 100)


def test_slice_is_written_in_pieces_and_read_in_as_many_files(spark, tmp_path, larger):
    path, n = Qy._numbered_topic(spark, SF_SMALL, str(tmp_path), False)
    assert n == 3 and _files(spark, path) == Qy.SLICES * n
    assert _rows(spark.read.parquet(path)) == _rows(X.numbered_messages(spark, SF_SMALL))
    assert Qy._files(Qy.TOPIC_FILES, n, Qy.MOST_TOPIC_FILES) == Qy.TOPIC_FILES * n
    assert Qy._files(Qy.TOPIC_FILES, 1000, Qy.MOST_TOPIC_FILES) == Qy.MOST_TOPIC_FILES


def test_day_of_a_slice_is_one_file_however_many_tasks(spark, tmp_path):
    rows = Qy.silver_rows(spark, SF_SMALL).repartition(8)
    X.write_in_slices(rows, str(tmp_path / "s"), F.col("id"), 2, partition_by=["event_date"])
    days = rows.select("event_date").distinct().count()
    assert _files(spark, str(tmp_path / "s")) <= days + 2


@pytest.mark.parametrize("name,same_as", [
    ("stream_quarantine", "quarantine_split"), ("stream_silver_current_delta", "silver_current"),
    ("stream_silver_watermark", "silver_dedupe")])
def test_pieces_lose_and_repeat_nothing(spark, larger, name, same_as):
    got, want = Qy.all_queries()[name](spark, SF_SMALL), Qy.all_queries()[same_as](spark, SF_SMALL)
    if name == "stream_quarantine":
        want = want.where("reason <> 'tombstone'")
    assert _rows(got) == _rows(want.select(got.columns))
