"""Token counts of whole texts, by batch encoding that returns lengths only.

Arrow functions hand texts to the vocabulary's own library. The texts of an Arrow
batch are cut into parts of about ``PART_CHARS`` characters at safe boundaries, and these
at every safe boundary into words. Words that come again are encoded once: a worker keeps
the counts of up to ``WORDS`` short ones, and those it does not know yet are dealt out to batches of about
``BATCH_BYTES`` bytes. Where most words are new, parts are encoded as they are, dealt out largest first,
each to the lightest batch; so one very long text neither makes a batch of its own size nor holds its
tokens in memory at once. Counts of words and of parts add up to the count of the text.

A boundary is safe where no token can reach over it:

* ``tokenizers`` files whose pre-tokeniser is plain byte-level splitting without a
  normaliser: before a blank, tab or line end that follows something else than
  white space, as pre-tokens hold white space at their beginning only. Added
  tokens with white space inside, or that strip it, make the file unsafe.
* ``sentencepiece`` files that put a blank before the text and whose pieces hold
  the blank's sign at their beginning only: at one blank between two letters
  or digits of ASCII. The blank itself is left out, since the next part brings its own.

Texts of other files, and stretches without such a place, are encoded whole. No
begin, end or added special tokens; special strings inside a text are read as the
library does by default.

Defined results: a null text is an empty one with no tokens; ids of null or repeated
documents are kept as they are; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import ChainMap
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import kept, map_rows, utf8

PART_CHARS = 32_768
BATCH_BYTES = 1 << 18
#: Characters that are cut into words at once.
RUN_CHARS = 1 << 20
#: Words whose counts a worker keeps, begun anew beyond that; longer words than ``WORD_CHARS`` are not kept.
WORDS, WORD_CHARS = 1 << 19, 64
BLANK = "▁"


class _Library:
    """Counts for one vocabulary file: ``count`` takes texts, ``cut`` finds the next safe place (a match: what lies in it is left out)."""

    cut: re.Pattern | None = None

    def __init__(self, path: str):
        self.known: dict[str, int] = {}
        self.load(path)
        if self.cut is not None and not self.adds_up():
            self.cut = None

    def adds_up(self) -> bool:
        """A look at a short text before parts are trusted."""
        whole = "Two words, 3 more;\nand a line's end  here x"
        parts = list(self.parts(whole, 4))
        return sum(self.count(parts)) == self.count([whole])[0]

    def parts(self, text: str, size: int = PART_CHARS):
        at = 0
        while self.cut is not None and len(text) - at > size:
            found = self.cut.search(text, at + size)
            if found is None:
                break
            yield text[at:found.start()]
            at = found.end()
        yield text[at:]


class _Tokenizers(_Library):
    def load(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.no_truncation()
        self.coder.no_padding()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        added = told.get("added_tokens") or []
        strict = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added)
        if strict and told.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) \
                and not split.get("add_prefix_space"):
            self.cut = re.compile(r"(?<=\S)(?=[ \t\r\n])")

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.coder.encode_batch_fast(texts, add_special_tokens=False)]


class _SentencePiece(_Library):
    def load(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.coder = SentencePieceProcessor(model_file=path)
        pieces = (self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size()))
        if not any(BLANK in p.lstrip(BLANK) for p in pieces):
            self.cut = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.coder.encode(texts, num_threads=1, add_bos=False, add_eos=False)]


def library(path: str) -> _Library:
    return _SentencePiece(path) if path.endswith(".model") else _Tokenizers(path)


def balanced(sizes: list[int], batch_bytes: int = BATCH_BYTES) -> list[list[int]]:
    """The places of ``sizes`` in batches of about ``batch_bytes``: the largest first, each into the lightest batch."""
    bins = [(0, k) for k in range(max(1, -(-sum(sizes) // batch_bytes)))]
    out: list[list[int]] = [[] for _ in bins]
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, k = heapq.heappop(bins)
        out[k].append(at)
        heapq.heappush(bins, (load + sizes[at], k))
    return [b for b in out if b]


def lengths(coder: _Library, texts: list[str], part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each text."""
    owner, parts = [], []
    for i, text in enumerate(texts):
        for part in coder.parts(text, part_chars):
            owner.append(i)
            parts.append(part)
    out = [0] * len(texts)
    for at in runs([len(p) for p in parts], RUN_CHARS):
        for i, n in zip(owner[at], by_words(coder, parts[at], batch_bytes)):
            out[i] += n
    return out


def runs(sizes: list[int], most: int) -> Iterator[slice]:
    """Neighbours of about ``most`` together."""
    at = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(at, k)
            at, total = k, 0
        total += size
    yield slice(at, len(sizes))


def by_words(coder: _Library, parts: list[str], batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each part, from the counts of its words unless most of them are new."""
    if coder.cut is None:
        return encoded(coder, parts, batch_bytes)
    known, split = coder.known, [coder.cut.split(p) for p in parts]
    distinct = set().union(*split)
    new = distinct - known.keys()
    if 2 * len(new) > sum(map(len, split)):
        return encoded(coder, parts, batch_bytes)
    if len(known) + len(new) > WORDS:
        known.clear()
        new = distinct
    short = [w for w in new if len(w) <= WORD_CHARS]
    long = [w for w in new if len(w) > WORD_CHARS]
    step = max(1, -(-sum(map(len, short)) // batch_bytes))
    for k in range(step):
        batch = short[k::step]
        known.update(zip(batch, coder.count(batch)))
    counts = ChainMap(dict(zip(long, encoded(coder, long, batch_bytes))), known) if long else known
    return [sum(map(counts.__getitem__, words)) for words in split]


def encoded(coder: _Library, parts: list[str], batch_bytes: int) -> list[int]:
    """Tokens of each part, encoded as it is."""
    out = [0] * len(parts)
    for batch in balanced([len(p.encode()) for p in parts], batch_bytes):
        for at, n in zip(batch, coder.count([parts[k] for k in batch])):
            out[at] = n
    return out


def count(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", limit: int | None = None,
          part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens`` and, with a ``limit``, if there are more tokens than that (``over_limit``)."""
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = kept(("lengths", path), lambda: library(path))

        def work(batch):
            raw = batch["_text"]
            texts = [x.decode("utf-8", "replace") for x in raw.to_pylist()]
            found = lengths(coder, texts, part_chars, batch_bytes)
            return {"doc_id": batch["_id"], "n_bytes": pc.binary_length(raw).cast(pa.int64()), "n_tokens": found}
        return work
    found = map_rows(docs.select(F.col(id).cast("long").alias("_id"), utf8(text).alias("_text")), "doc_id long, n_bytes long, n_tokens long", make)
    return found if limit is None else found.withColumn("over_limit", F.col("n_tokens") > limit)
