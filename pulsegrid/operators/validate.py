"""Validation of raw ingestion bodies against a versioned contract.

A body is decoded once into one variant per contract field. Variants keep the
JSON type of every value, so ``"1"`` and ``1`` stay apart, and a missing field
(null) stays apart from a JSON null (a variant null).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.contracts import Node, UnreadableContract, read_contract
from pulsegrid.functions.scalar import is_blank, pinned, quoted, texts
from pulsegrid.operators.conform import EMPTY_BODY, INVALID_JSON, NOT_AN_OBJECT, Compiler
from pulsegrid.schemas import ORIGIN, RAW_CONTRACT, RAW_EVENT, Contract

# The texts of the required fields.
REQUIRED_TEXT = ("equipmentId", "correlationId", "schemaVersion")
REQUIRED = ("timestamp", "payload")

# The other types a value decoded from JSON can have.
NOT_STRING = ("VOID", "BOOLEAN", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "OBJECT", "ARRAY", "VARIANT")

# What the ingestion side treats as JSON: the strict grammar, not Spark's lenient default.
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": "_corrupt",
}


def validate(
    bodies: DataFrame, config: IngestConfig = IngestConfig(), contract: Contract = RAW_CONTRACT,
) -> DataFrame:
    """Envelope rows to validation results, one row per body.

    Adds ``valid``, ``errors``, ``schemaName``, ``reportedVersion``, the decoded
    ``record`` (null unless valid), and what a dead letter needs of a rejected
    body: ``claimedCorrelationId`` and ``claimedEquipmentId`` (null if valid).
    """
    # `schemaVersion` and `equipmentId` are reported even if the contract does not list them.
    names = list(dict.fromkeys((*contract.names, "equipmentId", "schemaVersion")))
    layout = ", ".join(f"`{name}` variant" for name in names) + ", _corrupt string"
    decoded = F.from_json("value", layout, STRICT_JSON)
    origin = ["key", "topic", "partition", "offset", F.col("timestamp").alias("recordTimestamp"), "value"]
    # inline() keeps the decode in one place: a later filter on a decoded field
    # would otherwise be pushed below a projection and decode the text again.
    rows = bodies.select(*origin, F.inline(F.array(decoded)))
    rows = rows.selectExpr(
        "*",
        f"{is_blank('value')} AS _blank",
        # Text that is not an object is told apart from broken text only when needed.
        "CASE WHEN _corrupt IS NOT NULL THEN try_parse_json(value) IS NULL ELSE false END AS _malformed",
        *[f"schema_of_variant(`{name}`) AS {_kind(name)}" for name in names],
    ).selectExpr("*", f"{_errors(config, contract)} AS errors")
    name, version = quoted(config.default_schema), quoted(config.default_schema_version)
    results = rows.selectExpr(
        *ORIGIN, "value", "errors",
        f"CASE WHEN _blank OR _malformed THEN {name} ELSE {quoted(contract.name)} END AS schemaName",
        f"CASE WHEN _blank OR _malformed THEN {version}"
        f" ELSE coalesce({_as_text('schemaVersion')}, {version}) END AS reportedVersion",
        f"CASE WHEN size(errors) = 0 THEN {_record(contract)} END AS record",
        f"CASE WHEN size(errors) > 0 THEN {claimed_correlation_id()} END AS claimedCorrelationId",
        "CASE WHEN size(errors) = 0 THEN NULL WHEN _blank OR _malformed THEN 'UNKNOWN'"
        f" ELSE coalesce({_as_text('equipmentId')}, 'UNKNOWN') END AS claimedEquipmentId",
    )
    return results.select("*", pinned("size(errors) = 0").alias("valid"))


def _kind(name: str) -> str:
    return f"`_kind_{name}`"


def _errors(config: IngestConfig, contract: Contract) -> str:
    # The first field, in contract order, that is missing or of the wrong kind.
    mismatch = "coalesce(" + ", ".join(_mismatch(name, kind, config) for name, kind in contract.fields) + ")"
    return f"""CASE WHEN _blank THEN array({quoted(EMPTY_BODY)})
        WHEN _malformed THEN array({quoted(INVALID_JSON)})
        WHEN _corrupt IS NOT NULL THEN array({quoted(NOT_AN_OBJECT)})
        WHEN {mismatch} IS NOT NULL THEN array({mismatch})
        ELSE {_semantic_errors(contract)} END"""


def _mismatch(name: str, kind: str | Node, config: IngestConfig) -> str:
    found = _kind(name)
    missing = quoted(f"SchemaMismatch: field '{name}' is missing")
    if isinstance(kind, Node):
        return f"CASE WHEN {found} IS NULL THEN {missing} ELSE {Compiler(config.strict_union).fault(kind, f'`{name}`', quoted(name))} END"
    if kind == "string":
        wrong = f"{found} != 'STRING'"
    elif kind == "long":
        wrong = f"{found} != 'BIGINT'"
    elif kind == "map<string>":
        wrong = f"NOT {_map_of_strings(name, found)}"
    else:
        plain = "" if config.strict_union else ", 'STRING'"
        wrong = f"{found} NOT IN ('VOID', 'OBJECT<string: STRING>'{plain})"
    mistyped = quoted(f"SchemaMismatch: field '{name}' must be of type {kind}")
    return f"CASE WHEN {found} IS NULL THEN {missing} WHEN {wrong} THEN {mistyped} END"


def _map_of_strings(name: str, found: str) -> str:
    # The type text of an object names every member's type. If no other type occurs in it,
    # all members are strings; if one does (maybe only in a key), each value is looked at.
    other = " OR ".join(f"contains({found}, ': {kind}')" for kind in NOT_STRING)
    return f"""(CASE WHEN NOT startswith({found}, 'OBJECT<') THEN false
        WHEN {other} THEN forall(
          map_values(try_variant_get(`{name}`, '$', 'map<string,variant>')), v -> schema_of_variant(v) = 'STRING')
        ELSE true END)"""


def _semantic_errors(contract: Contract) -> str:
    """Every message that applies, in a fixed order."""
    checks = []
    for name in REQUIRED_TEXT:
        blank = is_blank(_text(name)) if name in contract.names else "true"
        checks.append((blank, f"Field '{name}' is required and must be non-blank"))
    for name in REQUIRED:
        absent = f"`{name}` IS NULL" if name in contract.names else "true"
        checks.append((absent, f"Field '{name}' is required"))
    none = texts([])
    return "concat(" + ", ".join(
        f"CASE WHEN {wrong} THEN array({quoted(message)}) ELSE {none} END" for wrong, message in checks
    ) + ")"


def _text(name: str) -> str:
    return f"try_variant_get(`{name}`, '$', 'string')"


def _as_text(name: str) -> str:
    """A scalar as text, containers as empty text, a missing or null field as null."""
    return f"CASE WHEN {_kind(name)} RLIKE '^(OBJECT|ARRAY)' THEN '' ELSE {_text(name)} END"


def _record(contract: Contract) -> str:
    """The decoded event in the raw layout; fields the contract lacks are null."""
    kinds = dict(contract.fields)
    fields = []
    for field in RAW_EVENT.fields:
        name, sql_type = field.name, field.dataType.simpleString()
        if name not in kinds:
            value = f"CAST(NULL AS {sql_type})"
        elif kinds[name] == "optional string":
            value = f"""CASE {_kind(name)} WHEN 'VOID' THEN NULL WHEN 'STRING' THEN {_text(name)}
                ELSE try_variant_get(`{name}`, '$.string', 'string') END"""
        else:
            value = f"try_variant_get(`{name}`, '$', '{sql_type}')"
            if isinstance(kinds[name], Node) and kinds[name].kind == "union":
                # The branch that is there, under its name.
                branches = [f"try_variant_get(`{name}`, '$[\"{p.label}\"]', '{sql_type}')" for p in kinds[name].parts if p.kind != "null"]
                value = f"coalesce({', '.join([*branches, value])})"
        fields.append(f"'{name}', {value}")
    return f"named_struct({', '.join(fields)})"


def claimed_correlation_id(body: str = "value") -> str:
    """The correlation id scanned out of text that may be broken.

    After the first ``"correlationId"`` comes the next colon, then the next
    quoted text, whatever it belongs to; without a colon the first quoted text
    of the body counts. UNKNOWN when there is none.
    """
    colon = f"""locate(':', {body}, locate('"correlationId"', {body}))"""
    start = f"""locate('"', {body}, {colon} + 1)"""
    end = f"""locate('"', {body}, {start} + 1)"""
    return f"""CASE WHEN contains({body}, '"correlationId"') AND {start} > 0 AND {end} > 0
        THEN substring({body}, {start} + 1, {end} - {start} - 1) ELSE 'UNKNOWN' END"""


def latest_contract(registry: DataFrame, subject: str, default: Contract = RAW_CONTRACT) -> Contract:
    """The newest registered contract of a subject, or the bundled one.

    ``registry`` holds one row per (subject, version) with the contract as Avro
    JSON in ``schema``. One row of it reaches the driver.
    """
    newest = latest_versions(registry.filter(F.col("subject") == subject)).first()
    return Contract.from_avro_json(newest["schema"]) if newest else default


def registry_report(registry: DataFrame) -> DataFrame:
    """``subject, version, readable, problem`` for every entry of a registry (``problem`` is null for those that can be read)."""
    @F.pandas_udf("string")
    def problem(schemas: pd.Series) -> pd.Series:
        return schemas.map(_problem)
    told = registry.select("subject", "version", problem("schema").alias("problem"))
    return told.select("subject", "version", F.col("problem").isNull().alias("readable"), "problem")


def _problem(schema: str | None) -> str | None:
    try:
        read_contract(schema or "")
    except UnreadableContract as error:
        # What the parser of JSON says about a text is cut: the place tells nothing across versions of it.
        return "no contract" if str(error).startswith("no contract") else str(error)
    return None


def latest_versions(registry: DataFrame) -> DataFrame:
    """The highest version of every subject, combined on the map side."""
    return registry.groupBy("subject").agg(
        F.max("version").alias("version"), F.max_by("schema", "version").alias("schema"),
    )
