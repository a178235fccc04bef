"""Record contracts as trees: Avro record schemas read from their JSON, and the bundled ones."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")
NAMED = ("record", "enum", "fixed")


@dataclass(frozen=True)
class Node:
    """A type of a contract. ``name`` is the full name of a record, an enum or a fixed type."""

    kind: str
    name: str = ""
    fields: tuple[tuple[str, Node], ...] = ()
    symbols: tuple[str, ...] = ()
    parts: tuple[Node, ...] = ()
    size: int = 0

    @property
    def label(self) -> str:
        """What a value of this type is called in the JSON of a union."""
        return self.name or self.kind

    @property
    def text(self) -> str:
        """The type in messages."""
        if self.kind == "union":
            others = [p for p in self.parts if p.kind != "null"]
            if len(others) == 1 and len(self.parts) == 2:
                return f"optional {others[0].text}"
            return f"union<{', '.join(p.text for p in self.parts)}>"
        if self.kind in ("array", "map"):
            return f"{self.kind}<{self.parts[0].text}>"
        return f"{self.kind} {self.name.rsplit('.', 1)[-1]}" if self.name else self.kind


class UnreadableContract(ValueError):
    """The text is no contract, or one with a type that cannot be checked."""


def read_contract(text: str) -> Node:
    """The tree of an Avro record schema.

    Names defined once may be used again; logical types count as the type below
    them. A type that holds itself is refused, as checks are compiled to one expression.
    """
    try:
        node = _read(json.loads(text), {}, "")
    except (ValueError, KeyError, TypeError, AttributeError, RecursionError) as error:
        if isinstance(error, UnreadableContract):
            raise
        raise UnreadableContract(f"no contract: {error}") from error
    if node.kind != "record":
        raise UnreadableContract("a contract must be a record")
    return node


def _read(told, names: dict[str, Node | None], space: str) -> Node:
    if isinstance(told, str):
        if told in PRIMITIVES:
            return Node(told)
        for name in (told, f"{space}.{told}"):
            if name in names:
                if names[name] is None:
                    raise UnreadableContract(f"type {told} holds itself")
                return names[name]
        raise UnreadableContract(f"unknown type {told}")
    if isinstance(told, list):
        parts = tuple(_read(t, names, space) for t in told)
        if not parts or any(p.kind == "union" for p in parts) or len({p.label for p in parts}) < len(parts):
            raise UnreadableContract("a union needs branches of different types")
        return Node("union", parts=parts)
    kind = told["type"]
    if not isinstance(kind, str):
        return _read(kind, names, space)
    if kind == "array":
        return Node(kind, parts=(_read(told["items"], names, space),))
    if kind == "map":
        return Node(kind, parts=(_read(told["values"], names, space),))
    if kind not in NAMED:
        return _read(kind, names, space)
    name = told["name"]
    if "." not in name and told.get("namespace", space):
        name = f"{told.get('namespace', space)}.{name}"
    inner = name.rpartition(".")[0]
    names[name] = None
    node = Node(kind, name)
    if kind == "enum":
        node = replace(node, symbols=tuple(map(str, told["symbols"])))
    elif kind == "fixed":
        node = replace(node, size=int(told["size"]))
    else:
        fields = tuple((str(f["name"]), _read(f["type"], names, inner)) for f in told["fields"])
        if len({n for n, _ in fields}) < len(fields):
            raise UnreadableContract(f"record {name} has a field twice")
        node = replace(node, fields=fields)
    names[name] = node
    return node


# -- the bundled contracts -------------------------------------------------------------------------
# Names, order, types and domains of the fields.

_SPACE = "com.fabops.telemetry.events"
_TIME = {"type": "long", "logicalType": "timestamp-millis"}
_TEXTS = {"type": "map", "values": "string"}
_OPTIONAL = ["null", "string"]


def _record(name: str, space: str | None = None, **fields) -> dict:
    return {"type": "record", "name": name, **({"namespace": space} if space else {}),
            "fields": [{"name": n, "type": t} for n, t in fields.items()]}


def _enum(name: str, symbols: str) -> dict:
    return {"type": "enum", "name": name, "symbols": symbols.split()}


BUNDLED: dict[str, str] = {name: json.dumps(tree) for name, tree in {
    "raw-telemetry": _record(
        "RawTelemetryEvent", _SPACE, equipmentId="string", timestamp=_TIME, payload=_TEXTS, correlationId="string",
        schemaVersion="string", sourceSystem="string", metricName=_OPTIONAL, unit=_OPTIONAL),
    "equipment-status": _record(
        "EquipmentStatusEvent", _SPACE, equipmentId="string", timestamp=_TIME,
        payload=_record("EquipmentStatusPayload", status=_enum("EquipmentStatus", "IDLE RUNNING SETUP MAINTENANCE DOWN UNKNOWN"),
                        previousStatus=["null", "EquipmentStatus"], reasonCode=_OPTIONAL, details=_TEXTS),
        correlationId="string", schemaVersion="string", sourceEventId=_OPTIONAL),
    "critical-alert": _record(
        "CriticalAlertEvent", _SPACE, equipmentId="string", timestamp=_TIME,
        payload=_record("CriticalAlertPayload", alertId="string", severity=_enum("AlertSeverity", "CRITICAL HIGH MEDIUM LOW"), title="string",
                        description="string", threshold=_OPTIONAL, observedValue=_OPTIONAL, attributes=_TEXTS),
        correlationId="string", schemaVersion="string", acknowledged="boolean"),
    "dead-letter": _record(
        "DeadLetterEvent", _SPACE, equipmentId="string", timestamp=_TIME,
        payload=_record("DeadLetterPayload", originalTopic="string", originalSchema=_OPTIONAL, originalSchemaVersion=_OPTIONAL,
                        failureReason="string",
                        failureCode=_enum("DeadLetterFailureCode", "SCHEMA_VALIDATION DESERIALIZATION PROCESSING_ERROR TIMEOUT UNKNOWN"),
                        originalPayload="string", attemptCount="int"),
        correlationId="string", schemaVersion="string"),
    "audit": _record(
        "AuditEvent", _SPACE, equipmentId="string", timestamp=_TIME,
        payload=_record("AuditPayload", action=_enum(
            "AuditAction", "INGEST VALIDATE TRANSFORM EMIT_STATUS EMIT_ALERT DEAD_LETTER REPLAY SCHEMA_REGISTER ACKNOWLEDGE"),
            actor="string", outcome=_enum("AuditOutcome", "SUCCESS FAILURE SKIPPED"), resource="string", details=_TEXTS),
        correlationId="string", schemaVersion="string"),
}.items()}
