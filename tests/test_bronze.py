"""Framing, decoding and quarantine on the malformed inputs of a topic."""

from pyspark.sql import functions as F

from attrlake.functions import framing
from attrlake.operators import bronze as B
from attrlake.schemas import bronze_schema
from attrlake.operators.silver import conform


def _msgs(spark, values):
    rows = [(str(i), v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value binary, topic string, partition int, offset bigint")


def _frame(payload: bytes, magic: bytes = b"\x00", schema_id: int = 258) -> bytes:
    return magic + schema_id.to_bytes(4, "big") + payload


GOOD = b'{"id": 7, "activity_kind": "install", "created_at": 1704067199999999}'


def test_header_fields(spark):
    df = B.frame_header(_msgs(spark, [_frame(GOOD), b"", None]))
    rows = df.orderBy("key").collect()
    assert (rows[0].magic_byte, rows[0].schema_id, rows[0].payload_bytes) == (0, 258, len(GOOD))
    assert rows[1].magic_byte is None and rows[1].schema_id is None


def test_route_reasons(spark):
    values = [
        _frame(GOOD),                                   # good
        None,                                           # tombstone
        b"",                                            # empty
        b"\x00\x01",                                    # 2 bytes
        _frame(GOOD, magic=b"\x01"),                    # wrong magic byte
        _frame(b""),                                    # header only
        _frame(GOOD[:15]),                              # truncated payload
        _frame(b"{}"),                                  # no fields
        _frame(b'{"id": "seven", "created_at": 1}'),    # wrongly typed field
        _frame(b'{"activity_kind": "install", "created_at": 1}'),  # null id
        _frame(b'{"id": 9}'),                           # null created_at
        _frame(b'{"id": 10, "created_at": -1}'),        # negative micros: kept
    ]
    routed = B.route_messages(_msgs(spark, values)).orderBy(F.col("offset")).collect()
    assert [r.reason for r in routed] == [
        None, "tombstone", "short_value", "short_value", "bad_magic", "short_value",
        "undecodable", "null_id", "undecodable", "null_id", "null_created_at", None,
    ]
    assert str(routed[0].event_date) == "2023-12-31"
    assert str(routed[-1].event_date) == "1969-12-31"
    good = B.good_records(B.route_messages(_msgs(spark, values)))
    assert sorted(r.id for r in good.collect()) == [7, 10]


def test_json_frame_round_trip_keeps_every_column(spark):
    src = spark.createDataFrame([(1, "ad_revenue", 1704067199999999)], "id bigint, activity_kind string, created_at bigint")
    full = conform(src).drop("event_date")  # all 55 columns, silver types
    wire = src.select(*[F.col(c) for c in src.columns])
    value = framing.encode_json_frame(F.struct(*wire.columns), F.lit(1))
    msgs = wire.select(F.lit("k").alias("key"), value.alias("value"))
    back = B.decode_messages(msgs).first()
    assert (back.id, back.activity_kind, back.created_at) == (1, "ad_revenue", 1704067199999999)
    assert len(full.columns) == len(bronze_schema().fields)


def test_unwrap_handles_delete_and_empty_envelopes(spark):
    from attrlake.plans.queries import CHANGE_ROW

    payloads = [
        b'{"after": {"id": 1, "value": 2.0}, "op": "c", "source": {"lsn": 10}}',
        b'{"before": {"id": 1, "value": 2.0}, "after": {"id": 1, "value": 3.0}, "op": "u", "source": {"lsn": 11}}',
        b'{"before": {"id": 1, "value": 3.0}, "op": "d", "source": {"lsn": 12}}',
        b'{"op": "u", "source": {"lsn": 13}}',
    ]
    msgs = _msgs(spark, [_frame(p) for p in payloads] + [None])
    rows = B.unwrap_changes(msgs, CHANGE_ROW).orderBy("lsn").collect()
    assert [(r.op, r.id, r.value, r.lsn) for r in rows] == [
        ("c", 1, 2.0, 10), ("u", 1, 3.0, 11), ("d", 1, None, 12)]


def test_failfast_decode_rejects_a_bad_record(spark):
    import pytest

    from attrlake.functions import codec as C

    msgs = _msgs(spark, [_frame(b'{"id": "seven"}')])
    df = msgs.select(C.decode(framing.payload(F.col("value")), bronze_schema(), mode="FAILFAST").alias("d"))
    with pytest.raises(Exception):
        df.select("d.id").collect()


def test_first_arrival_wins_when_copies_differ(spark):
    from attrlake.operators.silver import dedupe_first

    rows = [  # id 5 arrived at offset 3 first, then a changed copy at offset 10
        (5, "install", 10, 0), (5, "ad_revenue", 3, 0), (6, "install", 4, 1), (6, "install", 4, 1),
    ]
    df = spark.createDataFrame(rows, "id bigint, activity_kind string, source_offset bigint, source_partition int")
    got = {r.id: (r.activity_kind, r.source_offset) for r in dedupe_first(df).collect()}
    assert got == {5: ("ad_revenue", 3), 6: ("install", 4)}


def test_registry_lookup_reads_the_latest_schema(tmp_path):
    import json

    from attrlake.functions.codec import registry_schema_string

    latest = tmp_path / "subjects" / "events-value" / "versions"
    latest.mkdir(parents=True)
    (latest / "latest").write_text(json.dumps({"subject": "events-value", "version": 3,
                                               "schema": '{"type": "record", "name": "E", "fields": []}'}))
    schema = registry_schema_string(tmp_path.as_uri(), "events-value")
    assert json.loads(schema)["name"] == "E"


def _avro_schema(columns):
    """An Avro record schema with the given columns, each nullable."""
    import json

    from attrlake.functions.codec import AVRO_PRIMITIVES

    names = {type(t): n for n, t in AVRO_PRIMITIVES.items()}
    return json.dumps({"type": "record", "name": "Event", "fields": [
        {"name": f.name, "type": ["null", names[type(f.dataType)]], "default": None} for f in columns.fields]})


def test_avro_schema_gives_the_event_columns():
    import pytest

    from attrlake.functions.codec import avro_columns
    from attrlake.schemas import registry_schema

    got = avro_columns(_avro_schema(registry_schema()))
    assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in registry_schema().fields]
    assert len(got) == 55
    with pytest.raises(ValueError, match="no flat column type"):
        avro_columns('{"fields": [{"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}}]}')


def test_avro_topic_without_the_package_says_so(spark):
    import pytest

    from attrlake.operators import bronze as B
    from attrlake.schemas import registry_schema

    messages = spark.createDataFrame([], "key string, value binary, topic string, partition int, offset bigint")
    with pytest.raises(Exception, match="AVRO_NOT_LOADED|[Aa]vro"):
        B.route_messages(messages, _avro_schema(registry_schema()), codec="avro").collect()
    with pytest.raises(TypeError, match="Avro schema string"):
        B.route_messages(messages, codec="avro")


def test_a_row_of_nulls_counts_as_undecodable(spark):
    from pyspark.sql import functions as F

    from attrlake.functions.codec import is_corrupt

    rows = spark.sql("select * from values (named_struct('a', 1, 'b', null)), (named_struct('a', null, 'b', null)), (null) as t(d)")
    assert [r[0] for r in rows.select(is_corrupt(F.col("d"), "avro", ["a", "b"])).collect()] == [False, True, True]
