"""Conformance of JSON bodies to any contract tree, compiled to one Spark SQL expression over a variant.

The text is parsed once; every type of the tree becomes a check of the value at its
place that gives null or the first fault with its path, such as ``payload.status`` or
``readings[3].unit``. Values are bound by one-element ``transform`` calls, so the
expression grows with the tree and not with its depth.

JSON of contracts: a union's value is null or an object with one member, called
like its branch; bytes and fixed are texts of characters up to U+00FF; every field
must be there and others are accepted, and what follows a complete document is not read. Whole numbers must fit into their type; float and double take any number.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.contracts import Node
from pulsegrid.functions.scalar import is_blank, quoted
from pulsegrid.schemas import ORIGIN

# The first text.
EMPTY_BODY = "Request body must not be empty"
INVALID_JSON = "Invalid JSON: the body is not one well-formed document"
NOT_AN_OBJECT = "SchemaMismatch: expected a JSON object"

SCALARS = {"boolean": "BOOLEAN", "string": "STRING", "bytes": "STRING", "fixed": "STRING", "enum": "STRING", "int": "BIGINT", "long": "BIGINT"}
SQL_TYPES = {"null": "void", "boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double", "string": "string",
             "enum": "string", "bytes": "binary", "fixed": "binary"}


class Compiler:
    """Checks and decodes of a tree as SQL text; ``strict_union`` refuses values without their branch's name."""

    def __init__(self, strict_union: bool = True):
        self.strict_union = strict_union
        self.names = (f"x{i}" for i in count())

    def fault(self, node: Node, value: str, path: str) -> str:
        """SQL of the first fault of the value, null if there is none; ``value`` and ``path`` are SQL, and the value is there."""
        v = next(self.names)
        kind = f"schema_of_variant({v})"
        wrong = _message(path, f"must be of type {node.text}")
        if node.kind == "null":
            body = f"CASE WHEN {kind} <> 'VOID' THEN {wrong} END"
        elif node.kind in ("float", "double"):
            body = f"CASE WHEN NOT ({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL')) THEN {wrong} END"
        elif node.kind in SCALARS:
            body = f"CASE WHEN {kind} <> '{SCALARS[node.kind]}' THEN {wrong} {self._narrower(node, v, path, wrong)} END"
        elif node.kind == "array":
            x, i, e = next(self.names), next(self.names), next(self.names)
            inner = self.fault(node.parts[0], x, f"concat({path}, '[', {i}, ']')")
            found = f"get(filter(transform(try_variant_get({v}, '$', 'array<variant>'), ({x}, {i}) -> {inner}), {e} -> {e} IS NOT NULL), 0)"
            body = f"CASE WHEN NOT startswith({kind}, 'ARRAY') THEN {wrong} ELSE {found} END"
        elif node.kind == "map":
            x, e = next(self.names), next(self.names)
            inner = self.fault(node.parts[0], f"{x}.value", f"concat({path}, '[', {x}.key, ']')")
            entries = f"array_sort(map_entries(try_variant_get({v}, '$', 'map<string,variant>')), (a, b) -> CASE WHEN a.key < b.key THEN -1 WHEN a.key > b.key THEN 1 ELSE 0 END)"
            body = f"CASE WHEN NOT startswith({kind}, 'OBJECT') THEN {wrong} ELSE get(filter(transform({entries}, {x} -> {inner}), {e} -> {e} IS NOT NULL), 0) END"
        elif node.kind == "record":
            body = f"CASE WHEN NOT startswith({kind}, 'OBJECT') THEN {wrong} ELSE {self.members(node, v, path)} END"
        else:
            body = self._union(node, v, path, kind, wrong)
        return _let(v, value, body)

    def members(self, record: Node, value: str, path: str | None = None) -> str:
        """SQL of the first fault of a record's fields, in their order."""
        found = []
        for name, node in record.fields:
            at = quoted(name) if path is None else f"concat({path}, {quoted('.' + name)})"
            child, m = _member(value, name), next(self.names)
            found.append(_let(m, child, f"CASE WHEN {m} IS NULL THEN {_message(at, 'is missing')} ELSE {self.fault(node, m, at)} END"))
        return f"coalesce({', '.join(found)}, CAST(NULL AS STRING))" if found else "CAST(NULL AS STRING)"

    def _narrower(self, node: Node, v: str, path: str, wrong: str) -> str:
        text = f"try_variant_get({v}, '$', 'string')"
        if node.kind == "int":
            return f"WHEN try_variant_get({v}, '$', 'bigint') NOT BETWEEN -2147483648 AND 2147483647 THEN {wrong}"
        if node.kind == "enum":
            return f"WHEN {text} NOT IN ({', '.join(map(quoted, node.symbols))}) THEN {_message(path, 'must be one of ' + ', '.join(node.symbols))}" \
                if node.symbols else f"ELSE {wrong}"
        if node.kind in ("bytes", "fixed"):
            size = f" OR length({text}) <> {node.size}" if node.kind == "fixed" else ""
            return rf"WHEN {text} RLIKE '[^\\x00-\\xff]'{size} THEN {wrong}"
        return ""

    def _union(self, node: Node, v: str, path: str, kind: str, wrong: str) -> str:
        whens = [f"WHEN {kind} = 'VOID' THEN " + ("CAST(NULL AS STRING)" if any(p.kind == "null" for p in node.parts) else wrong)]
        keys = f"map_keys(try_variant_get({v}, '$', 'map<string,variant>'))"
        others = [p for p in node.parts if p.kind != "null"]
        for part in others:
            named = f"startswith({kind}, 'OBJECT') AND {keys} = array({quoted(part.label)})"
            whens.append(f"WHEN {named} THEN {self.fault(part, _member(v, part.label), path)}")
        if not self.strict_union:
            whens += [f"WHEN {self.fault(part, v, path)} IS NULL THEN CAST(NULL AS STRING)" for part in others]
        return f"CASE {' '.join(whens)} ELSE {wrong} END"

    def type_of(self, node: Node) -> str:
        """The Spark type a value is decoded to."""
        if node.kind == "array":
            return f"array<{self.type_of(node.parts[0])}>"
        if node.kind == "map":
            return f"map<string,{self.type_of(node.parts[0])}>"
        if node.kind == "record":
            return "struct<" + ",".join(f"`{n}`:{self.type_of(t)}" for n, t in node.fields) + ">"
        if node.kind == "union":
            others = [p for p in node.parts if p.kind != "null"]
            if len(others) == 1:
                return self.type_of(others[0])
            return "struct<" + ",".join(f"`{p.label}`:{self.type_of(p)}" for p in others) + ">"
        return SQL_TYPES[node.kind]

    def decoded(self, node: Node, value: str) -> str:
        """SQL of a conforming value in its Spark type. A union of several types is a struct with a member for each."""
        v = next(self.names)
        if node.kind == "array":
            x = next(self.names)
            body = f"transform(try_variant_get({v}, '$', 'array<variant>'), {x} -> {self.decoded(node.parts[0], x)})"
        elif node.kind == "map":
            k, x = next(self.names), next(self.names)
            body = f"transform_values(try_variant_get({v}, '$', 'map<string,variant>'), ({k}, {x}) -> {self.decoded(node.parts[0], x)})"
        elif node.kind == "record":
            body = "named_struct(" + ", ".join(f"{quoted(n)}, {self.decoded(t, _member(v, n))}" for n, t in node.fields) + ")"
            body = f"CASE WHEN startswith(schema_of_variant({v}), 'OBJECT') THEN {body} END"
        elif node.kind == "union":
            others = [p for p in node.parts if p.kind != "null"]
            found = {p.label: self._branch(p, v) for p in others}
            body = found[others[0].label] if len(others) == 1 else "named_struct(" + ", ".join(f"{quoted(n)}, {x}" for n, x in found.items()) + ")"
            body = f"CASE WHEN schema_of_variant({v}) <> 'VOID' THEN {body} END"
        elif node.kind in ("bytes", "fixed"):
            body = f"encode(try_variant_get({v}, '$', 'string'), 'ISO-8859-1')"
        else:
            body = f"try_variant_get({v}, '$', '{SQL_TYPES[node.kind]}')" if node.kind != "null" else "NULL"
        return _let(v, value, f"CAST({body} AS {self.type_of(node)})")

    def _branch(self, part: Node, v: str) -> str:
        named = self.decoded(part, _member(v, part.label))
        if self.strict_union:
            return named
        return f"CASE WHEN {self.fault(part, v, quoted(''))} IS NULL THEN {self.decoded(part, v)} ELSE {named} END"


def _message(path: str, what: str) -> str:
    return f"concat('SchemaMismatch: field ''', {path}, {quoted(chr(39) + ' ' + what)})"


def _member(value: str, name: str) -> str:
    path = f'$["{name}"]'
    return f"try_variant_get({value}, {quoted(path)}, 'variant')"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def conformance(bodies: DataFrame, contract: Node, config: IngestConfig = IngestConfig()) -> DataFrame:
    """Envelope rows with ``valid``, ``error`` (the first fault, null if there is none) and ``record``, the typed value of a valid body."""
    compiler = Compiler(config.strict_union)
    origin = ["key", "topic", "partition", "offset", F.col("timestamp").alias("recordTimestamp"), "value"]
    # inline() keeps the parse in one place.
    rows = bodies.select(*origin, F.inline(F.array(F.struct(F.expr("try_parse_json(value)").alias("_body")))))
    rows = rows.withColumn("error", F.expr(f"""CASE WHEN {is_blank('value')} THEN {quoted(EMPTY_BODY)}
        WHEN _body IS NULL THEN {quoted(INVALID_JSON)}
        WHEN NOT startswith(schema_of_variant(_body), 'OBJECT') THEN {quoted(NOT_AN_OBJECT)}
        ELSE {compiler.members(contract, '_body')} END"""))
    return rows.select(*ORIGIN, "value", F.col("error").isNull().alias("valid"), "error",
                       F.expr(f"CASE WHEN error IS NULL THEN {compiler.decoded(contract, '_body')} END").alias("record"))
