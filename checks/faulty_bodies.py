"""JSON bodies of a contract tree with one fault each."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pulsegrid.contracts import Node

MILLIS = 1_704_153_600_250
#: A value of another type for each kind of type.
WRONG: dict[str, Any] = {"string": 7, "long": "7", "int": 2**31, "boolean": "yes", "enum": "NOPE", "union": 7, "record": "text", "map": {"k": 1}}


def sample(node: Node) -> Any:
    """A value that conforms; texts hold the mark of the equipment."""
    if node.kind == "record":
        return {name: sample(child) for name, child in node.fields}
    return {"string": "@ID", "long": MILLIS, "int": 1, "boolean": False, "enum": (node.symbols or ("",))[-1],
            "union": None, "map": {"k": "v"}}[node.kind]


def places(node: Node, before: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Node]]:
    for name, child in node.fields:
        yield (*before, name), child
        yield from places(child, (*before, name))


def bodies(tree: Node) -> list[str]:
    """For every node three bodies: without it, with a wrong value in its place, and a good one."""
    out = []
    for place, node in places(tree):
        for fault in range(3):
            body = sample(tree)
            inner = body
            for name in place[:-1]:
                inner = inner[name]
            if fault == 0:
                del inner[place[-1]]
            elif fault == 1:
                inner[place[-1]] = WRONG[node.kind]
            out.append(json.dumps(body))
    return out
