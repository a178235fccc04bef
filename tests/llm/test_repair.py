"""Conversation repair next to a plain search, small cases next to every sequence of edits."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pulsegrid.llm import repair as r
from pulsegrid.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, pos string, id int, code double"
LEGAL = {"su", "ua", "au"}
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def plain_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        drawn = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = told[2:]
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


def faults_of(turns):
    seen, out = set(), []
    for _, role, text in turns:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def chances(role, fault):
    """Edits of a row: cost, initial, role it leaves with."""
    yield 3, "D", None
    if fault not in ("blank", "duplicate"):
        more = fault == "truncated"
        yield more, "K", role
        yield 2 + more, "R", "user"
        yield 2 + more, "R", "assistant"


def plain_repair(turns, faults):
    """Cost, audit and turns of the cheapest repair: the least (cost, audit) from each row and state on."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ()), "a": (0, "", ())}

    def with_inserts(best):
        for _ in range(3):
            for state in ("", "s", "u", "a"):
                for role in ("user", "assistant"):
                    to = best.get(step.get((state, role[0])))
                    if to:
                        new = (to[0] + 2, "I" + to[1], ((role, ""), *to[2]))
                        best[state] = min(best.get(state, new), new, key=lambda b: b[:2])
        return best
    best = with_inserts(dict(best))
    for (_, role, text), fault in zip(reversed(turns), reversed(faults)):
        new = {}
        for state in ("", "s", "u", "a"):
            for cost, letter, to in chances(role, fault):
                on = best.get(state if to is None else step.get((state, to[:1])) if to[:1] else None)
                if on:
                    one = (cost + on[0], letter + on[1], on[2] if to is None else ((to, text), *on[2]))
                    new[state] = min(new.get(state, one), one, key=lambda b: b[:2])
        best = with_inserts(new)
    return best[""]


def plain(original, damaged):
    by = defaultdict(list)
    for conv, turn, role, text in damaged:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in {row[0] for row in original}:
        turns = sorted(by[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        faults = faults_of(turns)
        known = [t[0] for t in turns if t[0] is not None]
        cost, audit, said = plain_repair(turns, faults)
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest()
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(turns, turns[1:])), cost, audit, sha)
    return out


def every_repair(turns, faults):
    """The least (cost, audit) over all sequences of edits with up to two inserts at each place, tried one by one."""
    inserts = [()] + [c for n in (1, 2) for c in itertools.product("ua", repeat=n)]
    least = None
    for edits in itertools.product(*[list(chances(role, fault)) for (_, role, _), fault in zip(turns, faults)]):
        for places in itertools.product(inserts, repeat=len(turns) + 1):
            roles, audit, cost = "", "", 2 * sum(map(len, places))
            for at, place in enumerate(places):
                roles, audit = roles + "".join(place), audit + "I" * len(place)
                if at < len(edits):
                    c, letter, to = edits[at]
                    if to == "":
                        roles += "?"
                    cost, audit, roles = cost + c, audit + letter, roles + (to[:1] if to else "")
            if GRAMMAR.match(roles):
                least = min(least or (cost, audit), (cost, audit))
    return least


def conversation(rng, n, turns=None):
    roles, texts = ["user", "assistant", "system", "tool", "", "u", "sys"], ["Fine.", "So?", "cut off", "", " \n", "Yes!\t", "x"]
    return [(int(t), roles[rng.choice(7, p=[.35, .3, .1, .1, .05, .05, .05])], texts[rng.integers(7)] if rng.random() < .4 else f"Turn {t}{'.' * int(rng.random() < .8)}")
            for t in np.sort(rng.integers(0, turns or 2 * n + 1, n))]


def test_plain_version_is_least_of_all(rng):
    for _ in range(60):
        turns = conversation(rng, int(rng.integers(0, 4)))
        faults = faults_of(turns)
        assert plain_repair(turns, faults)[:2] == every_repair(turns, faults)


def codes_of(turns, faults):
    kinds = {"s": r.SYSTEM, "u": r.USER, "a": r.ASSISTANT}
    return np.array([4 * kinds.get(role[:1], 0) + ["", "blank", "duplicate", "truncated"].index(f) for (_, role, _), f in zip(turns, faults)], np.int64)


def test_graph_finds_the_least_audit(rng):
    some = [conversation(rng, int(n)) for n in [*range(1, 40), 300, 1, 2, 64]]
    faults = [faults_of(t) for t in some]
    codes = [codes_of(*x) for x in zip(some, faults)]
    costs = (r.matrices(codes)[:, r.START] + r.ENDING).min(1)
    for part in r.portions(codes, 400):
        graph = r.Graph([codes[i] for i in part], np.tile(r.ENDING, (len(part), 1)))
        audits, left = graph.paths(np.arange(len(part)), np.zeros(len(part), int))
        for i, audit, state in zip(part, audits, left):
            want = plain_repair(some[i], faults[i])
            assert (costs[i], audit + r.ENDS[state]) == want[:2]
            assert len(r.edits(audit, r.START, codes[i])) == len(codes[i])
    assert sorted(i for part in r.portions(codes, 400) for i in part) == list(range(len(codes)))


def test_ranks_order_the_audits(rng):
    codes = [codes_of(t, faults_of(t)) for t in (conversation(rng, 50) for _ in range(5))]
    graph = r.Graph(codes, np.tile(r.ENDING, (5, 1)))
    blocks, states = np.repeat(np.arange(5), 4), np.tile(np.arange(4), 5)
    audits, _ = graph.paths(blocks, states)
    ranks = graph.rank[4 * graph.first[blocks] + states]
    assert all((a < b) == (x < y) for a, x in zip(audits, ranks) for b, y in zip(audits, ranks))


@pytest.mark.parametrize("block", [4, r.BLOCK])
def test_against_plain_version(spark, rng, block):
    rows = [(conv, *t) for conv in range(40) for t in conversation(rng, int(rng.integers(1, 30)))]
    # One conversation holds a third of all rows, and one says the same over and over.
    rows += [(77, *t) for t in conversation(rng, 400)] + [(78, i, "user", "Same.") for i in range(60)]
    rows += [(79, None, "user", "First."), (79, 3, "assistant", None), (79, None, None, "x."), (79, 3, "assistant", "a."), (79, 3, "assistant", "a.")]
    rows += [(80, None, None, None), (None, 1, "assistant", "Of no conversation."), (None, 2, "system", "x" * 300_000), (81, 5, "system", "Only.")]
    frame = spark.createDataFrame([(*x, "p", 1, 0.5) for x in rows], SCHEMA).repartition(5)
    got = r.repair(frame, block=block)
    found = {x.id: tuple(x)[1:] for x in r.digests(got).collect()}
    assert found == plain(rows, rows)
    turns = got.turns.filter("id = 81").orderBy("place", "nth").collect()
    assert [(x.role, x.text) for x in turns] == [("system", "Only."), ("user", ""), ("assistant", "")] or found[81][6] == "D"


def test_empty_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert r.digests(r.repair(frame)).count() == 0 and r.query(spark, frame).count() == 0


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(5, turn, "user", "Gone.", "p", 1, 0.5), (5, turn, "user", "Gone.", "p", 1, 0.5)], SCHEMA)
    assert [tuple(x) for x in r.query(spark, frame).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_repair"](spark, sf)
    assert {x.conv_id: tuple(x)[1:] for x in got.collect()} == plain(rows, plain_damaged(rows))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
