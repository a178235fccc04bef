"""Telemetry records from good, odd and broken text."""

import datetime as dt

import pytest

from pulsegrid.operators import parse
from pulsegrid.schemas import ENVELOPE

UTC = dt.timezone.utc
AT = dt.datetime(2024, 1, 2, 3, 4, tzinfo=UTC)


def _one(spark, value, profile, **options):
    topic = spark.createDataFrame([("k", value, "t", 0, 7, AT)], ENVELOPE)
    read = parse.parse_status if profile == "status" else parse.parse_stream
    return read(topic, **options).selectExpr("*", "unix_micros(timestamp) AS micros").first()


@pytest.mark.parametrize("profile", ["status", "stream"])
@pytest.mark.parametrize("value", [
    None, "", "   ", "null", "[]", '[{"equipmentId":"E"}]', '"text"', "7", '{"equipmentId":"E"',
    '{"temperature":"hot"}', '{"temperature":true}', '{"temperature":{}}', '{"errorCodes":{"a":1}}',
    '{"errorCodes":"W001"}', '{"errorCodes":[["W001"]]}', '{"errorCodes":[{"a":"b"}]}', '{"equipmentId":{"a":1}}',
    '{"equipmentId":["a"]}', '{"timestamp":"yesterday"}', '{"timestamp":"2024-01-02"}',
    '{"timestamp":"2024-01-02T03:04:00"}', '{"timestamp":"2024-13-02T03:04:00Z"}', '{"timestamp":true}',
    '{"timestamp":99999999999999999999}', "{'equipmentId':'E'}", '{"temperature":NaN}',
])
def test_unusable(spark, profile, value):
    assert not _one(spark, value, profile).parsed


@pytest.mark.parametrize("profile", ["status", "stream"])
@pytest.mark.parametrize("value, column, expected", [
    ('{"temperature":"95.5"}', "temperature", 95.5), ('{"temperature":95}', "temperature", 95.0),
    ('{"temperature":""}', "temperature", None), ('{"temperature":null}', "temperature", None),
    ('{"equipmentId":42}', "equipmentId", "42"), ('{"equipmentId":"{odd"}', "equipmentId", "{odd"),
    ('{"equipmentId":"[odd"}', "equipmentId", "[odd"), ('{"equipmentId":"E"} tail', "equipmentId", "E"),
    ('{"errorCodes":["[W001]",7,null]}', "errorCodes", ["[W001]", "7", None]),
    ('{"timestamp":"2024-01-02T03:04:00.123456Z"}', "micros", 1704164640123456),
    ('{"timestamp":"2024-01-02T05:04:00+02:00"}', "micros", 1704164640000000),
    ('{"timestamp":1704164640123}', "micros", 1704164640123000),
    ('{"timestamp":"1704164640123"}', "micros", 1704164640123000),
    ("{}", "equipmentId", None),
])
def test_usable(spark, profile, value, column, expected):
    row = _one(spark, value, profile)
    assert row.parsed and row[column] == expected


def test_numeric_time_in_seconds(spark):
    assert _one(spark, '{"timestamp":1704164640.5}', "stream", numeric_time="seconds").micros == 1704164640500000


def test_unknown_fields(spark):
    value = '{"equipmentId":"E","site":"F1"}'
    assert not _one(spark, value, "status").parsed
    assert _one(spark, value, "status", strict=False).parsed
    assert _one(spark, value, "stream").parsed


@pytest.mark.parametrize("version, usable, expected", [
    ("1", True, 1), ('"2"', True, 2), ("null", True, 1), ('""', True, 1), ("3.7", True, 3), ('"1.0.0"', False, None),
    ('"1.0"', False, None), ("true", False, None), ("{}", False, None), ("99999999999", False, None),
])
def test_stream_schema_version(spark, version, usable, expected):
    row = _one(spark, f'{{"schemaVersion":{version}}}', "stream")
    assert row.parsed == usable
    if usable:
        assert row.schemaVersion == expected


def test_metadata_must_be_an_object(spark):
    assert _one(spark, '{"metadata":{"a":[1,{"b":null}]}}', "status").parsed
    assert _one(spark, '{"metadata":null}', "status").parsed
    assert not _one(spark, '{"metadata":"text"}', "status").parsed


def test_stream_defaults(spark):
    row = _one(spark, "{}", "stream")
    assert row.micros == 1704164640000000 and row.errorCodes == [] and row.schemaVersion == 1
    assert len(row.eventId) == 64 and row.eventId == _one(spark, "{}", "stream").eventId
