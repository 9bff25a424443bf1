"""Byte-level BPE: exact merges by backtracking over longest matches.

The vocabulary is a rank file: each token's bytes and its rank, which is also
its id and the order of merges. Bytes are mapped to Latin-1 characters, so that
an Aho-Corasick automaton over the tokens finds the longest token at every
place of a piece in one pass. Encoding walks from place to place with the
longest token; where two neighbours could not stand side by side in a true
encoding it falls back to the next shorter token, and where none is left it
gives up the place for good and goes back one token. Whether two tokens may be
neighbours is decided once, from the merges that made them, and remembered. Each
place is given up at most once, so a piece takes linear time.

Defined cases: a null text is an empty one; an empty text has no ids and
decodes to nothing; a repeated row gives a repeated result; columns other than
id and text play no part. Memory: the tables of remembered pieces and pairs
are emptied when full or when the worker begins a task of another operator, and long
pieces are not remembered.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lineagrid.llm.common import begin, pieces, remembers, texts

MAX_PIECES, MAX_PAIRS, LONG_PIECE = 500_000, 1_000_000, 64
NEVER = math.inf


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file."""
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in data.splitlines() if line)
    }


class BytePairEncoder:
    """Encodes and decodes by one rank file."""

    def __init__(self, data: bytes, pattern: str):
        self.ranks = read_ranks(data)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        # white space as the property, which leaves out the separators U+001C to U+001F
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(
            r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.automaton = ahocorasick.Automaton()
        self.prefixes: dict[int, int | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.known: dict[str, list[int]] = {}
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for a single byte. A
        token that merges do not make has itself as halves and is never used."""
        if token not in self.made_of:
            whole = self.bytes_of[token]
            parts, found = [self.ranks[whole[i : i + 1]] for i in range(len(whole))], None
            while len(parts) > 1:
                joined = [self.join(a, b) for a, b in zip(parts, parts[1:])]
                best = min(joined)
                if best == NEVER:
                    break
                i = joined.index(best)
                found = tuple(parts[i : i + 2])
                parts[i : i + 2] = [int(best)]
            self.made_of[token] = found if parts == [token] else (token, token)
        return self.made_of[token]

    def join(self, left: int, right: int) -> float:
        return self.ranks.get(self.bytes_of[left] + self.bytes_of[right], NEVER)

    def compatible(self, left: int | None, right: int) -> bool:
        """Whether the merges of both tokens' bytes would end in just these two.

        Undoes the merges of both sides from the latest to the earliest and
        looks at what then meets at the border: a merge across it that comes
        before the one just undone would have been done instead.
        """
        found = self.pairs.get((left, right))
        if found is None:
            found = self.halves(right) != (right, right) and (
                left is None or self._undisturbed(left, right)
            )
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def _undisturbed(self, left: int, right: int) -> bool:
        before = NEVER
        while True:
            if self.join(left, right) < before:
                return False
            of_left, of_right = self.halves(left), self.halves(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or of_left is not None and left > right:
                before, left = left, of_left[1]
            else:  # of equal merges the left one comes first, so one across the border too
                before, right = right + 1, of_right[0]

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.prefixes:
            whole = self.bytes_of[token]
            found = (self.ranks.get(whole[:end]) for end in range(len(whole) - 1, 0, -1))
            self.prefixes[token] = next((t for t in found if t is not None), None)
        return self.prefixes[token]

    def backtrack(self, data: bytes) -> list[int]:
        longest: list[int | None] = [None] * len(data)
        size = [0] * len(data)
        for end, (token, n) in self.automaton.iter(data.decode("latin-1")):
            start = end - n + 1
            if n > size[start]:
                longest[start], size[start] = token, n
        open_places = bytearray(b"\x01") * (len(data) + 1)
        ids: list[int] = []
        place, token = 0, longest[0]
        while place < len(data):
            while token is not None:
                end = place + len(self.bytes_of[token])
                if open_places[end] and self.compatible(ids[-1] if ids else None, token):
                    break
                token = self.shorter(token)
            if token is not None:
                ids.append(token)
                place = end
                token = longest[place] if place < len(data) else None
            else:
                open_places[place] = 0
                token = ids.pop()
                place -= len(self.bytes_of[token])
                token = self.shorter(token)
        return ids

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.backtrack(data)

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        for piece in self.pieces.findall(text):
            found = known.get(piece)
            if found is None:
                found = self.encode_piece(piece)
                if len(piece) <= LONG_PIECE:
                    if len(known) >= MAX_PIECES:
                        known.clear()
                    known[piece] = found
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str) -> BytePairEncoder:
    """Built once in each Python worker."""
    return BytePairEncoder(data, pattern)


remembers("byte_pairs", _encoder.cache_clear)


def _vocabulary(docs: DataFrame, path: str, pattern: str):
    """Rank files hold a fixed vocabulary (under 1 MB), whatever the corpus."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast((file.read(), pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""
    rows = texts(docs)
    source = _vocabulary(docs, path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("byte_pairs")
        encoder = _encoder(*source.value)
        for batch in pieces(batches):
            found = [np.array(encoder.encode(t), np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and data (binary) of every row of ids."""
    source = _vocabulary(encoded, path, pattern)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("byte_pairs")
        encoder = _encoder(*source.value)
        for batch in pieces(batches):
            found = [encoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["doc_id", "data"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids and of the bytes they decode to, and
    the ids (array of int) if asked for. Encodes, then decodes the ids, in one pass."""
    rows = texts(docs)
    source = _vocabulary(docs, path, pattern)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("byte_pairs")
        encoder = _encoder(*source.value)
        for batch in pieces(batches):
            counts, ids_sha, data_sha, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = encoder.encode(text)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                data_sha.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(np.array(ids, np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                       pa.array(data_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(digests, schema + ", ids array<int>" * with_ids)
