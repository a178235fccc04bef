"""Language identification by cross-parsing entropy.

A suffix automaton is built of labelled text per language. A document is cut,
from left to right, into the longest phrases that occur in a language's text;
phrases times log2 of that text's length, divided by the document's length, is
the bits a byte costs in that language. The language with the fewest wins.

The labelled text is a sample with a documented bound (``SAMPLE_BYTES`` for each
language and ``MODEL_BYTES`` for all, drawn by a hash of the id over all labelled rows, of the
``LANGUAGES`` labels with the most text); every document is parsed whole. Parsing works on bytes of lower-cased UTF-8, with everything of
ASCII but letters as one blank, and in pieces of ``PIECE`` bytes, each begun anew.

Defined results: null texts and texts without a letter are ``und`` with score 0;
ties go to the language that sorts first; null or repeated ids are kept; with no
labelled row every document is ``und``; other columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import kept, map_rows, unused

#: Bytes of labelled text for each language, and of all languages together: with many, each gets an equal share of that.
SAMPLE_BYTES, MODEL_BYTES = 60_000, 240_000
#: Languages that are learned: those with the most labelled text.
LANGUAGES = 64
#: Rows of a language that are drawn on average at least, however long they are.
ROWS = 32
#: Characters that one labelled row gives to the sample at most.
ROW_CHARS = 100_000
#: Rows are drawn so that about this many times the sample comes to the driver.
SURPLUS = 4
PIECE = 512
UNDETERMINED = "und"
#: What is found of a document.
FOUND = ("lang_pred", "score", "bits")
LETTER = regex.compile(r"\p{L}")
BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def held_out(id: str = "doc_id") -> Column:
    """If a document is kept from learning: crc32 of its id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(BLANKED).split())


def learn(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES,
) -> dict[str, bytes]:
    """The labelled text of each language, from the rows that are not held out.

    One aggregation finds how much text each language has, hence the share of
    its rows to draw; the drawn rows, a bounded number, come to the driver.
    """
    rows = docs.select(F.col(id).alias("_id"), F.substring(text, 1, ROW_CHARS).alias("_text"), F.col(lang).alias("_lang")).filter(
        F.col("_lang").isNotNull() & (F.length("_text") > 0) & ~held_out("_id"))
    order, steps = F.pmod(F.xxhash64("_id", "_text"), F.lit(1 << 30)), 1 << 30
    # The smallest of all hashes of a language is in the sample in any case.
    sizes = rows.groupBy("_lang").agg(F.sum(F.octet_length("_text")).alias("n"), F.count(F.lit(1)).alias("rows"), F.min(order).alias("least"))
    sizes = sizes.orderBy(F.desc("n"), "_lang").limit(LANGUAGES).collect()
    if not sizes:
        return {}
    sample_bytes = min(sample_bytes, MODEL_BYTES // len(sizes))
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["_lang"], min(steps, max(
        math.ceil(steps * SURPLUS * sample_bytes / r["n"]), math.ceil(steps * ROWS / r["rows"]), r["least"] + 1)))])
    drawn = rows.filter(order < shares[F.col("_lang")])
    pool: dict[str, list[tuple[int, bytes]]] = {}
    for label, value in drawn.select("_lang", "_text").collect():
        raw = normal(value)
        for k in range(0, len(raw), PIECE):
            piece = raw[k:k + PIECE]
            pool.setdefault(label, []).append((xxhash.xxh64_intdigest(piece), piece))
    model = {}
    for label, some in sorted(pool.items()):
        joined = b" ".join(piece for _, piece in sorted(set(some)))[:sample_bytes]
        if joined.strip():
            model[label] = joined
    return model


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Moves of the automaton that reads exactly the substrings of a text; symbols run from 1 to ``width - 1``.

    A row for each state, a column for each symbol; state 1 is the start, 0 stands for no move. All
    moves lie in one flat array, as states would be far larger as objects.
    """
    most = 2 * len(symbols) + 2
    moves, link, length = array("i", bytes(4 * most * width)), array("i", bytes(4 * most)), array("i", bytes(4 * most))
    last = states = 1
    for c in symbols:
        states += 1
        new = states
        length[new] = length[last] + 1
        p = last
        while p and not moves[p * width + c]:
            moves[p * width + c] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = moves[p * width + c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                states += 1
                copy = states
                moves[copy * width:(copy + 1) * width] = moves[q * width:(q + 1) * width]
                link[copy], length[copy] = link[q], length[p] + 1
                while p and moves[p * width + c] == q:
                    moves[p * width + c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return np.frombuffer(moves, np.int32)[:(states + 1) * width].reshape(-1, width).copy()


class Parser:
    """Counts the phrases of many pieces of text at once against one language's text."""

    def __init__(self, text: bytes):
        self.cost = math.log2(max(2, len(text)))
        seen = sorted(set(text))
        self.symbol = np.zeros(256, dtype=np.int32)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        moves = suffix_automaton(self.symbol[np.frombuffer(text, np.uint8)].tolist(), width)
        # Row 0 knows no symbol. Where a phrase ends, the move goes on from the start and is negative.
        self.table = np.where(moves > 0, moves * width, -moves[1] * width - 1).astype(np.int32).ravel()

    def phrases(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece; pieces are sorted by falling length."""
        symbols = self.symbol[data]
        row = np.zeros(len(starts), dtype=np.int32)
        count = np.zeros(len(starts), dtype=np.int32)
        for step, n in enumerate(len(starts) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), "right")):
            to = self.table[row[:n] + symbols[starts[:n] + step]]
            ended = to < 0
            count[:n] += ended
            row[:n] = np.where(ended, -(to + 1), to)
        return count


def parsers(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, Parser]]:
    return kept(("language", model), lambda: [(label, Parser(text)) for label, text in model])


def bits(texts: list[bytes], model: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Bits a byte of each normalised text costs in each language; the text's phrases over all its pieces."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + nth * PIECE
    lengths = np.minimum(PIECE, sizes[owner] - nth * PIECE)
    order = np.argsort(-lengths, kind="stable")
    out = []
    for _, parser in parsers(model):
        found = parser.phrases(data, starts[order], lengths[order])
        out.append(np.bincount(owner[order], found, len(texts)) * parser.cost / np.maximum(sizes, 1))
    return np.array(out).T.reshape(len(texts), len(model))


def predict(
    docs: DataFrame, model: dict[str, bytes], *, id: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score`` (lead over the next language, 0 to 1) and ``bits``.

    ``keep`` names expressions over ``docs`` to pass through.
    """
    named = {"doc_id": F.col(id).cast("long"), **(keep or {}), "_text": F.col(text).cast("string")}
    return _annotated(docs.select(*[c.alias(n) for n, c in named.items()]), model, "_text", drop=True)


def judged(docs: DataFrame, model: dict[str, bytes], *, text: str = "text") -> DataFrame:
    """``docs`` with all their columns, plus ``lang_pred``, ``score`` and ``bits`` (which replace columns of these names)."""
    return _annotated(docs.drop(*FOUND), model, text)


def accepted(docs: DataFrame, model: dict[str, bytes], *, text: str = "text") -> DataFrame:
    """``docs`` in one of the learnt languages, all columns as they were: null texts and texts without a letter go.

    Where nothing was learnt no document is in a learnt language, but no language was refused either: those with a letter stay.
    """
    if not model:
        return docs.filter(F.col(text).cast("string").rlike(r"\p{L}"))
    names = unused(docs.columns, *FOUND)
    return _annotated(docs, model, text, names=names).filter(F.col(names[0]) != UNDETERMINED).select(*[F.col(f"`{c}`") for c in docs.columns])


def _annotated(rows: DataFrame, model: dict[str, bytes], text: str, drop: bool = False, names: Sequence[str] = FOUND) -> DataFrame:
    others = [f for f in rows.schema if not (drop and f.name == text)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "{} string, {} double, {} double".format(*names)])
    return map_rows(rows, schema, _predictor(model, [f.name for f in others], text, names))


def _predictor(model: dict[str, bytes], others: list[str], text: str, names: Sequence[str]):
    fixed = tuple(sorted(model.items()))
    labels = [label for label, _ in fixed]

    def make():
        def work(batch):
            texts = ["" if x is None else x.decode("utf-8", "replace") for x in batch[text].cast(pa.binary()).to_pylist()]
            lettered = [bool(LETTER.search(t)) for t in texts]
            cost = bits([normal(t) if ok else b"" for t, ok in zip(texts, lettered)], fixed)
            langs, scores, best = [], [], []
            for ok, row in zip(lettered, cost):
                if not ok or not labels:
                    langs.append(UNDETERMINED), scores.append(0.0), best.append(None)
                    continue
                at = int(row.argmin())
                rest = min((float(x) for k, x in enumerate(row) if k != at), default=None)
                langs.append(labels[at]), best.append(float(row[at]))
                scores.append(1.0 if rest is None else 1.0 - float(row[at]) / rest if rest > 0 else 0.0)
            return {name: batch[name] for name in others} | dict(zip(names, (langs, scores, best)))
        return work
    return make
