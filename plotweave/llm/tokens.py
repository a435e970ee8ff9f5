"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

The vocabulary (a tokenizers JSON or a rank file, whose path is a parameter) is
serialised straight into a sentencepiece BPE model: every token becomes a piece
written in the byte-to-letter alphabet of byte-level BPE, scored by its negative
rank, with identity normalisation and no added marks. Text is cut into
pre-tokens by the vocabulary's pattern; each pre-token is mapped to that
alphabet and encoded by the sentencepiece library; decoding inverts the map.

A line break after a visible character always starts a new pre-token, so texts
are cut there first and repeated lines and pre-tokens are looked up in bounded
memo tables instead of being encoded again; the new pre-tokens of a batch go to
the library in one call.

Defined results: NULL and empty texts give an empty list; strings that look like
special tokens are ordinary text; lone surrogates can't occur in Parquet text.
"""

from __future__ import annotations

import base64
import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZERS = os.environ.get("PLOTWEAVE_TOKENIZERS", "/opt/tokenizers")

#: White space of the vocabularies' pattern (fixed value).
_SPACE = "\t-\r\x85 \xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: The pattern that splits text before the merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_any = regex.compile(PATTERN).findall
_ascii = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+""").findall


def split(line: str) -> list[str]:
    """Pre-tokens; pure ASCII goes through the standard library's engine."""
    return _ascii(line) if line.isascii() else _any(line)


_CUT = re.compile(rf"(?<=[^{_SPACE}])(?=\n)")


def byte_letters() -> list[str]:
    """The letter of each byte: printable Latin-1 stands for itself, the rest
    follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def load_ranks(path: str) -> tuple[dict[str, int], dict[str, int]]:
    """(token in letters -> id, special token -> id) of a JSON or rank file."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        return {k: v for k, v in data["model"]["vocab"].items() if k not in special}, special
    letters = byte_letters()
    with open(path, "rb") as f:
        return {"".join(letters[b] for b in base64.b64decode(t)): int(r) for t, r in map(bytes.split, f)}, {}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def sentencepiece_model(ranks: dict[str, int]) -> bytes:
    """ModelProto bytes. Ids are ranks; free ids and one id behind the last hold
    pieces that no text can reach (sentencepiece wants an unknown piece)."""
    at = {i: t for t, i in ranks.items()}
    size = max(at, default=-1) + 2
    out = bytearray()
    for i in range(size):
        if i in at:
            piece = _field(1, at[i].encode()) + _field(2, float(-i)) + _field(3, 1)
        elif i == size - 1:
            piece = _field(1, "␀unk".encode()) + _field(2, 0.0) + _field(3, 2)
        else:
            piece = _field(1, f"␀{i}".encode()) + _field(2, 0.0) + _field(3, 3)
        out += _field(1, piece)
    trainer = _field(3, 2) + _field(4, size) + _field(40, size - 1) + b"".join(_field(n, -1) for n in (41, 42, 43)) + _field(35, 0)
    plain = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out) + _field(2, trainer) + _field(3, plain)


class Codec:
    """Encoder and decoder of one vocabulary; ``memo`` bounds each memo table."""

    def __init__(self, path: str, memo: int = 200_000):
        import sentencepiece

        self.ranks, self.special = load_ranks(path)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        letters = byte_letters()
        self.letters = {b: ch for b, ch in enumerate(letters)}
        self.bytes = {ch: b for b, ch in enumerate(letters)}
        self.memo, self.tokens, self.lines = memo, {}, {}
        self.back = {i: bytes(self.bytes[ch] for ch in t) for t, i in self.ranks.items()}
        self.back |= {i: t.encode() for t, i in self.special.items()}

    def _lines(self, lines: list[str]) -> dict[str, list[int]]:
        cut = [(line, split(line)) for line in lines]
        if len(self.tokens) > self.memo:
            self.tokens.clear()
        tokens = self.tokens
        new = [w for w in dict.fromkeys(chain.from_iterable(w for _, w in cut)) if w not in tokens]
        if new:
            mapped = [w.encode().decode("latin-1").translate(self.letters) for w in new]
            tokens.update(zip(new, self.sp.encode(mapped, num_threads=1)))
        return {line: list(chain.from_iterable(map(tokens.__getitem__, w))) for line, w in cut}

    def encode_batch(self, texts: list[str | None], lines_at_once: int = 5_000) -> list[list[int]]:
        cut = [_CUT.split(t) if t else [] for t in texts]
        if len(self.lines) > self.memo:
            self.lines.clear()
        known = self.lines
        new = [x for x in dict.fromkeys(chain.from_iterable(cut)) if x not in known]
        for k in range(0, len(new), lines_at_once):
            known.update(self._lines(new[k : k + lines_at_once]))
        out = [list(chain.from_iterable(map(known.__getitem__, lines))) for lines in cut]
        for line in new:
            if len(line) > 400:  # long lines hardly return
                del known[line]
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.back[i] for i in ids).decode()


def encode_corpus(documents: DataFrame, path: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """p7_ids: doc_id and ids of every document, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                ids = codec.encode_batch(part["text"].to_pylist())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
                yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")
