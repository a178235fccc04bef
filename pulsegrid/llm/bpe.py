"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can
never be merged, nor lie inside a merge, so a cut between the two is certain.
Texts are cut into pre-tokens, pre-tokens at forced boundaries into fragments;
every fragment is encoded by the merges on its own, and the ids are concatenated.

Defined results: a null text is an empty one and has no ids; ids of null or
repeated documents are kept as they are; other columns are ignored. Invalid
UTF-8 is read with replacement characters, as the column's text would be shown.
"""

from __future__ import annotations

import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import Cache, kept, map_rows, utf8

#: Bytes of the cache of encoded pre-tokens in one worker; it starts anew beyond that.
CACHE_BYTES = 24 << 20
#: Longer pre-tokens are not kept in the cache.
CACHE_LENGTH = 64
#: White space as the vocabulary's pre-tokeniser understands it (fixed value).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokeniser's pattern (fixed value).
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Up to here all versions of Unicode give letters and digits the same class.
SETTLED = regex.compile(r"[^\x00-\u024f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable bytes as they are, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class ForcedBoundaryBpe:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library (byte-level BPE, no normaliser)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes_of: list[bytes] = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        #: For each pair of bytes, at 256 * first + second, if some token holds it.
        self.joined = bytearray(1 << 16)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            if token in self.special:
                self.bytes_of[i] = token.encode()
                continue
            raw = bytes(byte_of[c] for c in token)
            self.bytes_of[i] = raw
            for a, b in zip(raw, raw[1:]):
                self.joined[a << 8 | b] = 1
        # The letter of a byte is one code point, so text in these letters has one character per byte.
        self.table = {b: c for b, c in enumerate(self.letters)}
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = Cache(self._word, CACHE_BYTES, CACHE_LENGTH)

    def cuts(self, raw: bytes) -> list[int]:
        """Positions in ``raw`` before which a boundary is forced."""
        joined = self.joined
        return [i for i, (a, b) in enumerate(zip(raw, raw[1:]), 1) if not joined[a << 8 | b]]

    def _merge(self, fragment: bytes) -> bytes:
        ids = [t.id for t in self.library.model.tokenize(fragment.decode("latin-1").translate(self.table))]
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        cuts = self.cuts(raw)
        if not cuts:
            return self._merge(raw)
        edges = [0, *cuts, len(raw)]
        return b"".join(self._merge(raw[a:b]) for a, b in zip(edges, edges[1:]))

    def _plain(self, text: str) -> bytes:
        if SETTLED.search(text):
            spans = [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]
            words = [text[a:b] for a, b in spans]
        else:
            words = PRE_TOKEN.findall(text)
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.splitter is None or not self.splitter.search(text):
            return self._plain(text) if text else b""
        out, at = [], 0
        for match in self.splitter.finditer(text):
            if match.start() > at:
                out.append(self._plain(text[at:match.start()]))
            out.append(np.array([self.special[match[0]]], dtype="<u4").tobytes())
            at = match.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def coder(path: str) -> ForcedBoundaryBpe:
    return kept(("bpe", path), lambda: ForcedBoundaryBpe(path))


def encode(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and ``ids``, little-endian unsigned 32-bit integers."""
    def make():
        bpe = coder(path)

        def work(batch):
            texts = (x.decode("utf-8", "replace") for x in batch["_text"].to_pylist())
            return {"doc_id": batch["_id"], "ids": [bpe.encode(t) for t in texts]}
        return work
    return map_rows(docs.select(F.col(id).cast("long").alias("_id"), utf8(text).alias("_text")),
                    "doc_id long, ids binary", make)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the decoded ``text`` for the rows of ``encode``; null ids are none."""
    def make():
        bpe = coder(path)

        def work(batch):
            return {"doc_id": batch["doc_id"], "ids": batch["ids"],
                    "text": [bpe.decode(x or b"") for x in batch["ids"].to_pylist()]}
        return work
    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, ids binary, text string", make)


def digests(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``ids`` as ``encode`` has them, their count and digest, and the digest of the text they decode to, in one pass."""
    def make():
        bpe = coder(path)

        def work(batch):
            out = {"doc_id": batch["_id"], "ids": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for raw in batch["_text"]:
                ids = bpe.encode(raw.as_py().decode("utf-8", "replace"))
                out["ids"].append(ids)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            return out
        return work
    return map_rows(docs.select(F.col(id).cast("long").alias("_id"), utf8(text).alias("_text")),
                    "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
