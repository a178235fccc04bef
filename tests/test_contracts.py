"""Contract trees: reading them, checks of every kind of type, typed values, against a plain checker."""

import json
import random

import pytest

from pulsegrid import contracts
from pulsegrid.config import IngestConfig
from pulsegrid.operators import conform
from pulsegrid.operators.validate import registry_report, validate
from pulsegrid.schemas import ENVELOPE, RAW_CONTRACT, Contract

TREE = {"type": "record", "name": "R", "namespace": "n.s", "fields": [
    {"name": "a", "type": {"type": "array", "items": ["null", "int", {"type": "enum", "name": "E", "symbols": ["X", "Y"]}]}},
    {"name": "m", "type": {"type": "map", "values": "double"}},
    {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}},
    {"name": "e", "type": ["null", "E"]},
    {"name": "odd name's", "type": "boolean"},
    {"name": "r", "type": {"type": "record", "name": "Inner", "fields": [
        {"name": "l", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "g", "type": "float"},
        {"name": "b", "type": ["bytes", "null"]}, {"name": "z", "type": "null"},
        {"name": "deep", "type": {"type": "array", "items": {"type": "map", "values": {"type": "array", "items": "string"}}}}]}},
]}
VALID = {"a": [None, {"int": 3}, {"n.s.E": "X"}], "m": {"k": 1, "l": -2.5}, "f": "ab", "e": {"n.s.E": "Y"}, "odd name's": True,
         "r": {"l": 9007199254740993, "g": 1e30, "b": {"bytes": "ÿ\u0000"}, "z": None, "deep": [{"x": ["t"], "y": []}, {}]}}


def plain_fault(node, value, path):
    """The first fault of a value, read from the rules of the JSON of contracts."""
    wrong = f"SchemaMismatch: field '{path}' must be of type {node.text}"
    whole = isinstance(value, int) and not isinstance(value, bool)
    if node.kind == "record":
        if not isinstance(value, dict):
            return wrong
        for name, child in node.fields:
            at = f"{path}.{name}" if path else name
            fault = f"SchemaMismatch: field '{at}' is missing" if name not in value else plain_fault(child, value[name], at)
            if fault:
                return fault
        return None
    if node.kind == "array":
        if not isinstance(value, list):
            return wrong
        return next((f for i, x in enumerate(value) if (f := plain_fault(node.parts[0], x, f"{path}[{i}]"))), None)
    if node.kind == "map":
        if not isinstance(value, dict):
            return wrong
        return next((f for k, x in sorted(value.items()) if (f := plain_fault(node.parts[0], x, f"{path}[{k}]"))), None)
    if node.kind == "union":
        if value is None:
            return None if any(p.kind == "null" for p in node.parts) else wrong
        for part in node.parts:
            if part.kind != "null" and isinstance(value, dict) and list(value) == [part.label]:
                return plain_fault(part, value[part.label], path)
        return wrong
    if node.kind == "enum":
        return wrong if not isinstance(value, str) else None if value in node.symbols else f"SchemaMismatch: field '{path}' must be one of {', '.join(node.symbols)}"
    good = {"null": value is None, "boolean": isinstance(value, bool), "string": isinstance(value, str),
            "int": whole and -2**31 <= value < 2**31, "long": whole and -2**63 <= value < 2**63,
            "float": whole or isinstance(value, float), "double": whole or isinstance(value, float),
            "bytes": isinstance(value, str) and all(ord(c) < 256 for c in value),
            "fixed": isinstance(value, str) and len(value) == node.size and all(ord(c) < 256 for c in value)}[node.kind]
    return None if good else wrong


def bodies(spark, texts):
    return spark.createDataFrame([("k", t, "ingest", 0, i, None) for i, t in enumerate(texts)], ENVELOPE)


def damaged(rng, value):
    """A copy with a random place replaced, removed or added."""
    value = json.loads(json.dumps(value))
    other = lambda: rng.choice([None, 1, 2**31, 2**63, 1.5, "s", "Z", "Ā", True, [], {}, [1], {"x": 1}, {"int": 1}, {"n.s.E": "Q"}, {"string": "s"}])
    if not isinstance(value, (dict, list)) or not value or rng.random() < 0.15:
        return other()
    at = rng.choice(list(value)) if isinstance(value, dict) else rng.randrange(len(value))
    if rng.random() < 0.2:
        del value[at]
    elif isinstance(value, list) and rng.random() < 0.2:
        value.append(other())
    else:
        value[at] = damaged(rng, value[at])
    return value


def test_against_a_plain_checker(spark):
    tree, rng = contracts.read_contract(json.dumps(TREE)), random.Random(3)
    values = [VALID] + [v for v in (damaged(rng, VALID) for _ in range(500)) if isinstance(v, dict)]
    got = conform.conformance(bodies(spark, [json.dumps(v) for v in values]), tree).orderBy("offset").collect()
    want = [plain_fault(tree, v, "") for v in values]
    assert [r.error for r in got] == want and [r.valid for r in got] == [w is None for w in want]
    assert 20 < len(set(want)) and all((r.record is None) == (not r.valid) for r in got)


def test_typed_values(spark):
    tree = contracts.read_contract(json.dumps(TREE))
    frame = conform.conformance(bodies(spark, [json.dumps(VALID)]), tree)
    assert frame.schema["record"].dataType.simpleString().replace("`", "") == (
        "struct<a:array<struct<int:int,n.s.E:string>>,m:map<string,double>,f:binary,e:string,odd name's:boolean,"
        "r:struct<l:bigint,g:float,b:binary,z:void,deep:array<map<string,array<string>>>>>")
    r = frame.first().record.asDict(True)
    assert r["a"] == [None, {"int": 3, "n.s.E": None}, {"int": None, "n.s.E": "X"}] and r["m"] == {"k": 1.0, "l": -2.5}
    assert (bytes(r["f"]), r["e"], r["odd name's"]) == (b"ab", "Y", True)
    assert r["r"]["l"] == 9007199254740993 and bytes(r["r"]["b"]) == b"\xff\x00" and r["r"]["deep"] == [{"x": ["t"], "y": []}, {}]


def test_bodies_that_are_no_objects(spark):
    tree = contracts.read_contract(json.dumps(TREE))
    got = conform.conformance(bodies(spark, [None, "", " ", "{", "[]", "null", "7", json.dumps(VALID) + " x"]), tree).orderBy("offset").collect()
    assert [r.error for r in got] == [conform.EMPTY_BODY] * 3 + [conform.INVALID_JSON] + [conform.NOT_AN_OBJECT] * 3 + [None]


def test_plain_branches_if_not_strict(spark):
    tree = contracts.read_contract(json.dumps({"type": "record", "name": "U", "fields": [{"name": "u", "type": ["null", "string", "long"]}]}))
    texts = ['{"u":"x"}', '{"u":5}', '{"u":{"long":5}}', '{"u":null}', '{"u":true}']
    valid = lambda strict: [r.valid for r in conform.conformance(bodies(spark, texts), tree, IngestConfig(strict_union=strict)).orderBy("offset").collect()]
    assert valid(True) == [False, False, True, True, False] and valid(False) == [True, True, True, True, False]


def test_bundled_contracts_compile():
    read = {name: contracts.read_contract(text) for name, text in contracts.BUNDLED.items()}
    assert len(read) == 5 and Contract.from_avro_json(contracts.BUNDLED["raw-telemetry"]) == RAW_CONTRACT
    status = dict(dict(read["equipment-status"].fields)["payload"].fields)
    assert status["previousStatus"].parts[1] == status["status"]


@pytest.mark.parametrize("text, problem", [
    ("", "no contract"), ("[]", "a union needs"), ('"string"', "must be a record"), ('{"type":"record","name":"R"}', "no contract"),
    ('{"type":"record","name":"R","fields":[{"name":"a","type":"what"}]}', "unknown type what"),
    ('{"type":"record","name":"R","fields":[{"name":"a","type":["null","R"]}]}', "type R holds itself"),
    ('{"type":"record","name":"R","fields":[{"name":"a","type":["string","string"]}]}', "different types"),
    ('{"type":"record","name":"R","fields":[{"name":"a","type":"int"},{"name":"a","type":"int"}]}', "twice"),
    ("[" * 100_000, "no contract"),
])
def test_unreadable_contracts(text, problem):
    with pytest.raises(contracts.UnreadableContract, match=problem):
        contracts.read_contract(text)


def test_validation_under_a_nested_contract(spark):
    fields = [{"name": n, "type": {"string": "string", "long": "long"}.get(k, "string")} for n, k in RAW_CONTRACT.fields if n not in ("payload", "metricName", "unit")]
    text = json.dumps({"type": "record", "name": "Nested", "fields": [*fields, {"name": "payload", "type": {"type": "map", "values": ["double", "string"]}},
                                                                    {"name": "unit", "type": ["null", {"type": "enum", "name": "Unit", "symbols": ["C", "F"]}]}]})
    contract = Contract.from_avro_json(text)
    body = {"equipmentId": "EQ-1", "timestamp": 1, "correlationId": "c", "schemaVersion": "1", "sourceSystem": "s", "payload": {"t": {"double": 1.5}}, "unit": {"Unit": "C"}}
    faulty = [body | {"unit": {"Unit": "K"}}, body | {"payload": {"t": 1.5}}, body | {"equipmentId": " "}]
    got = validate(bodies(spark, [json.dumps(b) for b in [body, *faulty]]), contract=contract).orderBy("offset").collect()
    assert [r.valid for r in got] == [True, False, False, False] and got[0].record.unit == "C" and got[0].schemaName == "Nested"
    assert [r.errors[0] for r in got[1:]] == [
        "SchemaMismatch: field 'unit' must be one of C, F", "SchemaMismatch: field 'payload[t]' must be of type union<double, string>",
        "Field 'equipmentId' is required and must be non-blank"]


def test_registry_report(spark):
    rows = [("a", 1, contracts.BUNDLED["audit"]), ("a", 2, None), ("b", 1, "{"), ("c", 7, '{"type":"record","name":"R","fields":[{"name":"a","type":"what"}]}')]
    got = {(r.subject, r.version): r.problem for r in registry_report(spark.createDataFrame(rows, "subject string, version int, schema string")).collect()}
    assert got == {("a", 1): None, ("a", 2): "no contract", ("b", 1): "no contract", ("c", 7): "unknown type what"}
