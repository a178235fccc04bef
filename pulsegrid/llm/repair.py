"""Repair of conversation structure at least cost, the least audit among equals by prefix doubling.

Rows of a conversation have faults (blank, duplicate, truncated) and roles in any order; edits
turn them into an optional system turn and then pairs of user and assistant: ``Keep`` costs
0, ``Rerole`` to user or assistant 2, ``Delete`` 3 (the only edit of blank and duplicate rows), ``Insert`` of
an empty turn 2, and a truncated row that stays 1. The audit of a repair is the initials of its
edits; of the cheapest repairs the one with the ASCII-least audit is taken.

Nodes are (row, state of the grammar); an edit is an arc, and an initial leads from a node to one
other node. Conversations are cut into blocks of at most ``BLOCK`` rows, so a long one is not the work of
one task:

1. each block gets the matrix of its least costs between states, all blocks side by side;
2. matrices of a conversation are gone through backwards (one small row for each block), which gives the
   cost from the end of each block to the end of the conversation;
3. in each block arcs on cheapest repairs are kept. Nodes are ranked by the audits of length one from
   them, then of 2, 4, 8, ...: the pair of a node's rank and of the rank of the node its pointer leads to is
   ranked anew, and pointers doubled. Ranks choose among the arcs of a node, and doubled pointers read off the least
   path from each state the block may be entered in;
4. blocks are gone through forwards, which chooses the entry states, and edits go back to their rows.

Defined results: a null role or text is one space; rows are ordered by turn, nulls first, then by role and text, and rows
that repeat stay (as duplicates); a null conversation id is a conversation of its own; a role of another initial
than s, u or a can only be reroled or deleted; a conversation of which nothing is left has no turns, an empty audit and
the digest of the empty string; other columns are ignored; an empty table gives none. Rows of one
conversation that share the turn and the first 64 characters of role and text are sorted in one task.
The audit of a conversation is one value and must fit into a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_arrow, map_rows, stored

#: Rows of a block; a power of two, as blocks are cut by the rows' numbers.
BLOCK = 4_096
#: Rows whose nodes a task holds at once.
AT_ONCE = 32_768
#: White space that does not count (fixed values).
SPACES = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 0  # kinds of rows: OTHER, SYSTEM, USER, ASSISTANT
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Where an inserted or reroled turn leads: to an assistant after a user, else to a user.
NEXT = np.array([USER, USER, ASSISTANT, USER])
LETTERS = b"\0DIKR"
DELETE, INSERT, KEEP, REROLE = range(1, 5)
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
FAR = 1 << 40
#: Cost of ending in each state: a system turn alone lacks a pair, a user turn its answer.
ENDING = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
ENDS = ["", "II", "I", ""]


def kept_to(kind: int, state: int) -> int | None:
    """The state after a row of ``kind`` is kept in ``state``, if it may be."""
    if kind == SYSTEM:
        return SYSTEM if state == START else None
    return kind if kind != OTHER and kind == NEXT[state] else None


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Costs of one row by its code (kind * 4 + fault): with inserts before it, as matrices; and of Keep alone, by state."""
    insert = np.full((4, 4), FAR)
    insert[range(4), range(4)] = 0
    for state in range(4):
        one = NEXT[state]
        insert[state, one] = min(insert[state, one], INSERT_COST)
        insert[state, NEXT[one]] = min(insert[state, NEXT[one]], 2 * INSERT_COST)
    rows, keeps = np.full((16, 4, 4), FAR), np.full((16, 4), FAR)
    for code in range(16):
        kind, fault = divmod(code, 4)
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for state in range(4):
            rows[code, state, state] = DELETE_COST
            if fault not in (BLANK, DUPLICATE):
                to, kept = NEXT[state], kept_to(kind, state)
                rows[code, state, to] = min(rows[code, state, to], REROLE_COST + more)
                if kept is not None:
                    rows[code, state, kept] = min(rows[code, state, kept], KEEP_COST + more)
                    keeps[code, state] = KEEP_COST + more
    both = (insert[None, :, :, None] + rows[:, None]).min(2)
    return both, keeps


STEP, KEEPS = _steps()


def matrices(codes: list[np.ndarray]) -> np.ndarray:
    """Least costs between the states at both ends of each block, side by side over all blocks."""
    order, flat, starts, sizes = _side_by_side(codes)
    out = np.full((len(codes), 4, 4), FAR)
    out[:, range(4), range(4)] = 0
    for at in range(sizes[0] if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -at, "left"))
        out[:n] = np.minimum(FAR, (out[:n, :, :, None] + STEP[flat[starts[:n] + at]][:, None]).min(2))
    back = np.empty_like(out)
    back[order] = out
    return back


def _side_by_side(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks by falling size: their order, and all codes with the start and size of each block."""
    sizes = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([codes[i] for i in order]) if len(codes) else np.zeros(0, np.int64)
    sizes = sizes[order]
    return order, flat, np.cumsum(sizes) - sizes, sizes


def illegal(codes: np.ndarray) -> int:
    """Neighbours whose roles may not follow each other."""
    kinds = codes >> 2
    return int((~_follows(kinds[:-1], kinds[1:])).sum())


def _follows(a, b):
    return ((a == SYSTEM) & (b == USER)) | ((a == USER) & (b == ASSISTANT)) | ((a == ASSISTANT) & (b == USER))


class Graph:
    """The arcs of cheapest repairs in blocks of rows; ``ends`` are the costs to go from each block's end."""

    def __init__(self, codes: list[np.ndarray], ends: np.ndarray):
        order, flat, starts, sizes = _side_by_side(codes)
        self.first = np.empty(len(codes), np.int64)
        # A node for each state before every row and after the last one of each block.
        first = starts + np.arange(len(codes))
        self.first[order] = first
        togo = np.empty((len(flat) + len(codes), 4), np.int64)
        togo[first + sizes] = ends[order]
        for back in range(sizes[0] if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -back, "left"))
            row = starts[:n] + sizes[:n] - 1 - back
            at = first[:n] + sizes[:n] - 1 - back
            togo[at] = np.minimum(FAR, (STEP[flat[row]] + togo[at + 1][:, None]).min(2))
        self.togo = togo
        node = np.repeat(first, sizes) + np.arange(len(flat)) - np.repeat(starts, sizes)
        self._arcs(flat, node)

    def _arcs(self, flat: np.ndarray, node: np.ndarray) -> None:
        """The pointer and rank of each node for audits of length one; the ends of blocks stay where they are, with rank 0."""
        here, there = self.togo[node], self.togo[node + 1]
        states = np.arange(4)
        fault, kind = flat & 3, flat >> 2
        stays = (fault != BLANK) & (fault != DUPLICATE)
        rerole = REROLE_COST + np.where(fault == TRUNCATED, TRUNCATED_COST, 0)
        kept = np.where(kind[:, None] == SYSTEM, SYSTEM, NEXT[states])
        # Arcs by rising initial: the first one that lies on a cheapest repair is the least.
        chances = [
            (DELETE, here == DELETE_COST + there, 4 * (node + 1)[:, None] + states),
            (INSERT, here == INSERT_COST + here[:, NEXT], 4 * node[:, None] + NEXT[states]),
            (KEEP, here == KEEPS[flat] + np.take_along_axis(there, kept, 1), 4 * (node + 1)[:, None] + kept),
            (REROLE, stays[:, None] & (here == rerole[:, None] + there[:, NEXT]), 4 * (node + 1)[:, None] + NEXT[states]),
        ]
        rank = np.zeros(self.togo.shape, np.int64)
        pointer = np.arange(self.togo.size).reshape(self.togo.shape)
        for letter, holds, to in reversed(chances):
            rank[node] = np.where(holds, letter, rank[node])
            pointer[node] = np.where(holds, to, pointer[node])
        self.letter, self.rank, self.pointer = rank.ravel(), rank.ravel(), pointer.ravel()

    def doubled(self) -> list[np.ndarray]:
        """Pointers over 1, 2, 4, ... edits, until ranks of such lengths tell nothing new: all paths have ended."""
        out, rank, pointer = [self.pointer], self.rank, self.pointer
        while rank[pointer].any():
            # Pairs of ranks, ranked anew, order the audits of twice the length; nodes of equal rank have equal ones.
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            pointer = pointer[pointer]
            out.append(pointer)
        self.rank = rank
        return out

    def paths(self, blocks: np.ndarray, states: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The least audit of each block entered in a state, and the state it is left in."""
        if not len(blocks):
            return [], np.zeros(0, np.int64)
        entry = 4 * self.first[blocks] + states
        seen = entry[:, None]
        for pointer in self.doubled():
            seen = np.concatenate([seen, pointer[seen]], 1)
        # Edits of a path are the letters of its nodes, up to the end of the block, which has none.
        letters = np.frombuffer(LETTERS, np.uint8)[self.letter[seen]]
        return [row.tobytes().rstrip(b"\0").decode() for row in letters], seen[:, -1] & 3


def portions(codes: list[np.ndarray], most: int = AT_ONCE) -> Iterator[list[int]]:
    """Places of blocks of like size (within a factor of two), with at most ``most`` rows, or one block, at a time."""
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    some: list[int] = []
    for i in order:
        if some and ((len(some) + 1) * (len(codes[i]) + 1) > most or len(codes[i]) > 2 * len(codes[some[0]]) + 8):
            yield some
            some = []
        some.append(i)
    if some:
        yield some


def edits(audit: str, state: int, codes: np.ndarray) -> list[str]:
    """For each row the letters of the turns inserted before it, and what is done with it: K, D, or U and A for the role it gets."""
    out, before, at = [], "", 0
    for letter in audit:
        if letter == "I":
            before += "a" if state == USER else "u"
            state = int(NEXT[state])
            continue
        if letter == "R":
            out.append(before + ("A" if state == USER else "U"))
            state = int(NEXT[state])
        else:
            out.append(before + letter)
            if letter == "K":
                state = int(codes[at]) >> 2
        before, at = "", at + 1
    return out


# -- the Spark job ---------------------------------------------------------------------------------


@dataclass
class Repaired:
    """``found``: ``id, gaps, blank, duplicate, truncated, illegal, cost, audit``; ``turns``: ``id, place, nth, role, text`` in order."""

    found: DataFrame
    turns: DataFrame


def numbered(rows: DataFrame, *, id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order, numbered by ``pos``, with what each shows by itself; a long conversation lies in several partitions."""
    said = rows.select(F.col(id).alias("id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    # Whole texts are too long for the bounds of ranges; their beginnings are in the same order.
    cut = said.repartitionByRange("id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64))
    cut = cut.sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text").withColumn("pos", F.monotonically_increasing_id())
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.substring("role", 1, 1)
    return stored(cut.select(
        "*", F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).alias("kind"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest")), "turns")


def judged(table: DataFrame) -> DataFrame:
    """``id, pos, turn, code`` of numbered rows; a row is a duplicate if another one says the same before it.

    The first row of each saying is found by a combining aggregation and joined by its number, which is
    unique: a saying repeated in a third of all rows is no hot key.
    """
    firsts = table.filter(~F.col("blank")).groupBy("id", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    rows = table.select("id", "pos", "turn", "kind", "blank", "truncated").join(firsts, "pos", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(FINE)
    return stored(rows.select("id", "pos", "turn", (F.col("kind") * 4 + fault).alias("code")), "faults")


def _codes(batch) -> list[np.ndarray]:
    return [np.asarray(c, np.int64) for c in batch["codes"].to_numpy(zero_copy_only=False)]


def blocks_of(rows: DataFrame, id_type: str, block: int) -> DataFrame:
    """A row per conversation and block: the codes of its rows, matrix, and neighbours that may not follow each other."""
    cut = rows.groupBy("id", F.expr(f"pos div {block}").alias("block")).agg(
        F.min("pos").alias("pos"), F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    cut = cut.select("id", "block", "pos", F.transform("rows", lambda r: r["code"]).alias("codes"))

    def make():
        def work(batch):
            codes = _codes(batch)
            costs = np.empty((len(codes), 16), np.int64)
            for some in portions(codes):
                costs[some] = matrices([codes[i] for i in some]).reshape(-1, 16)
            return {k: batch[k] for k in ("id", "block", "pos", "codes")} | {"costs": list(costs), "illegal": [illegal(c) for c in codes]}
        return work
    return map_rows(cut, f"id {id_type}, block long, pos long, codes array<int>, costs array<long>, illegal long", make)


def _streamed(rows: DataFrame, schema: str, order: Column, step) -> DataFrame:
    """Rows of each conversation in order through ``step(row, carried)``, which gives output rows and what to carry on.

    ``carried`` is None at the first row of a conversation. Rows come one by one, so a long conversation costs
    time but no memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, carried = object(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["id"] != known:
                    known, carried = row["id"], None
                made, carried = step(row, carried)
                out += made
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
    return by_arrow(rows.repartition("id").sortWithinPartitions("id", order), run, schema)


def _backwards(row, togo):
    last = togo is None
    togo = ENDING if last else togo
    before = np.minimum(FAR, (np.array(row["costs"]).reshape(4, 4) + togo).min(1))
    return [{"id": row["id"], "block": row["block"], "pos": row["pos"], "codes": row["codes"], "illegal": row["illegal"],
             "ends": togo.tolist(), "cost": int(before[START]), "last": last}], before


def _read(batch) -> dict:
    """The least audit of each block for every state it may be entered in."""
    codes, ends = _codes(batch), np.stack(batch["ends"].to_numpy(zero_copy_only=False))
    audits, exits = [[""] * 4 for _ in codes], [[0] * 4 for _ in codes]
    for some in portions(codes):
        graph = Graph([codes[i] for i in some], ends[some])
        found, left = graph.paths(np.repeat(np.arange(len(some)), 4), np.tile(np.arange(4), len(some)))
        for k, i in enumerate(some):
            audits[i], exits[i] = found[4 * k:4 * k + 4], left[4 * k:4 * k + 4].tolist()
    return {"audits": audits, "exits": exits}


def _forwards(row, carried):
    state, kind, nth = (START, None, 0) if carried is None else carried
    codes = np.array(row["codes"])
    audit = row["audits"][state]
    left = row["exits"][state]
    bad = row["illegal"] + int(kind is not None and not _follows(kind, int(codes[0]) >> 2))
    end = ENDS[left] if row["last"] else ""
    return [{"id": row["id"], "nth": nth, "pos": row["pos"], "audit": audit + end, "edits": edits(audit, state, codes), "illegal": bad,
             "cost": row["cost"] if carried is None else None,
             "tail": {"I": "a", "II": "ua"}.get(end), "rows": len(codes)}], (left, int(codes[-1]) >> 2, nth + 1)


def repair(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> Repaired:
    id_type = rows.schema[id].dataType.simpleString()
    table = numbered(rows, id=id, turn=turn, role=role, text=text)
    faults = judged(table)
    back = stored(_streamed(
        blocks_of(faults, id_type, block),
        f"id {id_type}, block long, pos long, codes array<int>, illegal long, ends array<long>, cost long, last boolean",
        F.desc("block"), _backwards), "blocks")

    def make():
        return lambda batch: {f: batch[f] for f in ("id", "block", "pos", "codes", "illegal", "cost", "last")} | _read(batch)
    ranked = map_rows(back, f"id {id_type}, block long, pos long, codes array<int>, illegal long, cost long, last boolean, "
                            "audits array<string>, exits array<int>", make)
    done = stored(_streamed(
        ranked, f"id {id_type}, nth long, pos long, audit string, edits array<string>, illegal long, cost long, tail string, rows long",
        F.asc("block"), _forwards), "edits")

    by_id = done.groupBy("id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "audit"))), lambda a: a["audit"]), "").alias("audit"),
        F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"))
    fault = F.col("code") % 4
    counts = faults.groupBy(F.col("id").alias("_id")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(fault == k).alias(n) for k, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))])
    found = by_id.join(counts, F.col("id").eqNullSafe(F.col("_id"))).select(
        "id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    per_row = done.select(F.posexplode("edits").alias("n", "edit"), "pos").select((F.col("pos") + F.col("n")).alias("pos"), "edit").filter("edit <> 'D'")
    what = F.right("edit", F.lit(1))
    placed = table.select("id", "pos", "role", "text").join(per_row, "pos").select(
        "id", "pos", F.concat(_inserted(F.expr("left(edit, length(edit) - 1)")), F.when(what == "D", F.array()).otherwise(F.array(F.struct(
            F.when(what == "U", "user").when(what == "A", "assistant").otherwise(F.col("role")).alias("role"), "text")))).alias("said"))
    tails = done.filter(F.col("tail").isNotNull()).select("id", (F.col("pos") + F.col("rows")).alias("pos"), _inserted(F.col("tail")).alias("said"))
    # What is inserted at the end comes after the last row, whose number is one less, and before any other conversation's.
    turns = placed.select("id", F.col("pos").alias("place"), F.lit(0).alias("end"), "said").unionByName(
        tails.select("id", (F.col("pos") - 1).alias("place"), F.lit(1).alias("end"), "said"))
    turns = turns.select("id", "place", "end", F.posexplode("said").alias("n", "t")).select(
        "id", "place", (F.col("end") * 1_000 + F.col("n")).alias("nth"), "t.role", "t.text")
    return Repaired(found, turns)


def _inserted(letters: Column) -> Column:
    """Empty turns for letters u and a."""
    return F.transform(F.filter(F.split(letters, ""), lambda c: c != ""), lambda c: F.struct(
        F.when(c == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))


def digests(repaired: Repaired) -> DataFrame:
    """``found`` with ``repaired_sha256``, the digest of ``role:text`` of its turns, joined by line feeds."""
    id_type = repaired.turns.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Texts run through the digest one after the other, so no conversation is held.
        schema = pa.schema([pa.field("_id", schemas["id"]), pa.field("repaired_sha256", pa.string())])
        known, sha = None, None
        for batch in batches:
            out = []
            for id, line in zip(batch["id"].to_pylist(), batch["line"].to_pylist()):
                if sha is None or id != known:
                    if sha is not None:
                        out.append({"_id": known, "repaired_sha256": sha.hexdigest()})
                    known, sha = id, hashlib.sha256(line)
                else:
                    sha.update(b"\n")
                    sha.update(line)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"_id": known, "repaired_sha256": sha.hexdigest()}], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    schemas = {"id": to_arrow_type(repaired.turns.schema["id"].dataType)}
    lines = repaired.turns.select("id", "place", "nth", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    sums = by_arrow(lines.repartition("id").sortWithinPartitions("id", "place", "nth").select("id", "line"), run,
                    f"_id {id_type}, repaired_sha256 string")
    empty = hashlib.sha256().hexdigest()
    return repaired.found.join(sums, F.col("id").eqNullSafe(F.col("_id")), "left").drop("_id").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))


def damaged(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with a fault for a quarter of all rows, drawn by a checksum of id and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(space(id), F.lit(":"), space(turn)).cast("binary")) % 20
    said = F.when(drawn == 1, "").when(drawn == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    return rows.select(F.col(id).alias("conv_id"), F.col(turn).alias("turn"), F.when(drawn == 4, "user").otherwise(space(role)).alias("role"),
                       said.alias("text"), drawn.alias("drawn")).filter("drawn <> 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations, with a row for every conversation there was."""
    got = digests(repair(damaged(conversations))).withColumnRenamed("id", "_known")
    all_ = conversations.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_.join(got, F.col("conv_id").eqNullSafe(F.col("_known")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
