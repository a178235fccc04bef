"""Validation, enrichment and dead letters on single documents."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.operators import enrich, replay, validate as v
from pulsegrid.operators.validate import latest_contract, validate
from pulsegrid.plans.ingest import current_contract
from pulsegrid.schemas import ENVELOPE, RAW_CONTRACT, Contract

VALID = {
    "equipmentId": "EQ-0007", "timestamp": 1704153600250, "payload": {"temperature": "71.25", "k": "18"},
    "correlationId": "corr-31", "schemaVersion": "1.0.0", "sourceSystem": "edge-click",
    "metricName": None, "unit": None,
}


def _bodies(spark, *values):
    return spark.createDataFrame([("k", value, "ingest", 0, i, None) for i, value in enumerate(values)], ENVELOPE)


def _document(**changes):
    return json.dumps({k: x for k, x in {**VALID, **changes}.items() if x is not ...})


def _results(spark, *values, config=IngestConfig(), contract=RAW_CONTRACT):
    return validate(_bodies(spark, *values), config, contract).orderBy("offset").collect()


def test_valid_document(spark):
    row = _results(spark, _document())[0]
    assert row.valid and row.errors == []
    assert row.record.equipmentId == "EQ-0007"
    assert row.record.payload == {"temperature": "71.25", "k": "18"}
    assert (row.schemaName, row.reportedVersion) == ("RawTelemetryEvent", "1.0.0")


def test_documents_with_several_faults(spark):
    short = dict(sourceSystem=..., metricName=..., unit=...)
    rows = _results(
        spark, _document(correlationId=..., **short), _document(timestamp="02.01.2024", **short))
    assert [r.valid for r in rows] == [False, False]
    assert all(r.errors for r in rows)


@pytest.mark.parametrize("body, message", [
    (None, v.EMPTY_BODY), ("", v.EMPTY_BODY), (" \t\n", v.EMPTY_BODY), (" 　", v.EMPTY_BODY),
    (" ", v.INVALID_JSON), ("{", v.INVALID_JSON), ("{'a':1}", v.INVALID_JSON), ('{"a":NaN}', v.INVALID_JSON),
    ("[]", v.NOT_AN_OBJECT), ("[" + _document() + "]", v.NOT_AN_OBJECT), ("null", v.NOT_AN_OBJECT),
    ('"text"', v.NOT_AN_OBJECT), ("12", v.NOT_AN_OBJECT),
    ("{}", "SchemaMismatch: field 'equipmentId' is missing"),
    (_document(timestamp=1.5), "SchemaMismatch: field 'timestamp' must be of type long"),
    (_document(timestamp=True), "SchemaMismatch: field 'timestamp' must be of type long"),
    (_document(payload={"a": "x", "b": None}), "SchemaMismatch: field 'payload' must be of type map<string>"),
    (_document(payload={"a": {"b": "c"}}), "SchemaMismatch: field 'payload' must be of type map<string>"),
    (_document(payload=[]), "SchemaMismatch: field 'payload' must be of type map<string>"),
    (_document(metricName={"string": 1}), "SchemaMismatch: field 'metricName' must be of type optional string"),
    (_document(unit={"string": "C", "x": "y"}), "SchemaMismatch: field 'unit' must be of type optional string"),
])
def test_rejections(spark, body, message):
    row = _results(spark, body)[0]
    assert not row.valid and row.errors == [message] and row.record is None


@pytest.mark.parametrize("body", [
    _document() + " trailing", _document(extra={"deep": [1]}), _document(payload={}),
    # Keys that look like types do not make a value of that type.
    _document(payload={"x: BIGINT": "1", "y, z: OBJECT<": "2"}),
    _document(metricName={"string": "temperature"}, unit={"string": "C"}),
    _document(timestamp=-1), _document(timestamp=9223372036854775807),
])
def test_acceptances(spark, body):
    row = _results(spark, body)[0]
    assert row.valid, row.errors
    assert json.loads(body.removesuffix(" trailing"))["payload"] == row.record.payload


def test_all_blank_fields_are_listed(spark):
    row = _results(spark, _document(equipmentId=" ", correlationId="", schemaVersion="\t"))[0]
    assert row.errors == [
        f"Field '{n}' is required and must be non-blank" for n in ("equipmentId", "correlationId", "schemaVersion")]


def test_plain_text_for_optional_fields_is_a_choice(spark):
    body = _document(metricName="temperature")
    assert not _results(spark, body)[0].valid
    row = _results(spark, body, config=IngestConfig(strict_union=False))[0]
    assert row.valid and row.record.metricName == "temperature"


@pytest.mark.parametrize("body, expected", [
    (None, "UNKNOWN"), ("no marker", "UNKNOWN"), ('{"correlationId": "abc", "x', "abc"),
    ('{"correlationId": null, "schemaVersion": "1"}', "schemaVersion"), ('{"correlationId": ""}', ""),
    ('{"correlationId" "abc"}', "correlationId"), ('{"correlationId": "abc', "UNKNOWN"),
    ('{"a": "b", "correlationId" "abc"', "a"),
])
def test_correlation_id_of_broken_text(spark, body, expected):
    df = spark.createDataFrame([(body,)], "value string").selectExpr(f"{v.claimed_correlation_id()} AS c")
    assert df.first().c == expected


def test_dead_letter_and_key(spark):
    body = '{"equipmentId": 7, "correlationId": "", "schemaVersion": 2'
    row = enrich.dead_letters(validate(_bodies(spark, body, body + "}", None))).orderBy("offset").collect()
    assert [r.equipmentId for r in row] == ["UNKNOWN", "7", "UNKNOWN"]
    assert [r.correlationId for r in row] == ["UNKNOWN"] * 3
    assert [r.payload.originalSchemaVersion for r in row] == ["1.0.0", "2", "1.0.0"]
    assert [r.payload.originalPayload for r in row] == [body, body + "}", ""]


def test_ids_and_times_do_not_change_between_runs(spark):
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    run = lambda: enrich.enrich(validate(_bodies(spark, _document())), as_of=at).collect()
    assert run() == run()
    assert run()[0].ingestionMetadata.ingestedAt == "2026-01-01T00:00:00.000000Z"


def test_replay_counts_attempts(spark):
    letters = enrich.dead_letters(validate(_bodies(spark, _document(metricName="m"), "{")))
    again = replay.replay(letters, IngestConfig(strict_union=False))
    assert [(r.offset, r.attemptCount) for r in again.filter("valid").collect()] == [(0, 2)]
    third = replay.replay(again.filter("NOT valid").select("key", "topic", "partition", "offset", "recordTimestamp", "letter.*"))
    assert [(r.offset, r.letter.payload.attemptCount) for r in third.collect()] == [(1, 3)]


def test_registry_fallbacks(spark, tmp_path):
    entry = lambda text: spark.createDataFrame([("raw", 3, text)], "subject string, version int, schema string")
    for registry in (lambda: entry("no json"), lambda: entry('{"name":"X"}'), lambda: entry('{"type":"record","name":"X","fields":[{"name":"a","type":"number"}]}'),
                     lambda: entry(None), lambda: spark.read.parquet(f"{tmp_path}/none"), lambda: entry("{}").filter("false")):
        assert current_contract(registry, "raw").contract == RAW_CONTRACT
    known = current_contract(lambda: entry('{"type":"record","name":"X","fields":[{"name":"a","type":"long"}]}'), "raw")
    assert known.contract == Contract("X", (("a", "long"),)) and known.problem is None
    broken = current_contract(lambda: entry('{"type":"record","name":"X","fields":[{"name":"a","type":"number"}]}'), "raw")
    assert (broken.version, broken.problem) == (3, "unknown type number")


def test_contract_from_registry(spark):
    avro = lambda name, fields: json.dumps({
        "type": "record", "name": name, "fields": [{"name": n, "type": t} for n, t in fields]})
    newer = avro("RawV2", [("equipmentId", "string"), ("timestamp", {"type": "long", "logicalType": "timestamp-millis"}),
                           ("payload", {"type": "map", "values": "string"}), ("correlationId", "string"),
                           ("schemaVersion", "string"), ("site", ["null", "string"])])
    registry = spark.createDataFrame(
        [("raw", 1, avro("RawV1", [("equipmentId", "string")])), ("raw", 10, newer), ("raw", 9, "{}")],
        "subject string, version int, schema string")
    contract = latest_contract(registry, "raw")
    assert contract == Contract("RawV2", (
        ("equipmentId", "string"), ("timestamp", "long"), ("payload", "map<string>"), ("correlationId", "string"),
        ("schemaVersion", "string"), ("site", "optional string")))
    assert latest_contract(registry, "other") == RAW_CONTRACT
    rows = _results(spark, _document(), _document(site=None), contract=contract)
    assert [r.valid for r in rows] == [False, True]
    assert rows[1].schemaName == "RawV2" and rows[1].record.sourceSystem is None
