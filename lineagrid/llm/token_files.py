"""Token ids in wavelet-matrix files, one compressed file per shard.

Shards are ranges of doc_id. A shard's file has a row per block of whole
documents (about ``BLOCK_TOKENS`` ids; a longer document is a block of its own),
with the block's documents and their lengths, and its ids as a wavelet matrix: one
plane of bits for each bit of an id, from the highest, each plane in the stable
order of the bits above it, with counts of ones per ``STEP`` bits. From that
alone come the id at a place (access), how often an id occurs before a place
(rank) and where its k-th occurrence is (select), each in a step per plane.

Defined cases: a null or empty text is the end id alone; a repeated row is
written again, next to its like; documents with a null id come first; an empty
table writes an empty folder; columns other than id and text play no part.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lineagrid.llm.common import pieces, texts

SHARD_DOCS = 10_000
BLOCK_TOKENS = 1 << 18
STEP = 512
MAX_WORDS = 400_000
FILE_SCHEMA = (
    "shard int, block int, start_in_shard long, n_tokens long, doc_ids array<bigint>, "
    "lengths array<int>, zeros array<bigint>, planes array<binary>, ones array<binary>"
)


class WaveletMatrix:
    """Access, rank and select over a sequence of ids kept as planes of bits."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ones: list[bytes]):
        self.n = n
        self.zeros = zeros
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ones = [np.frombuffer(o, np.uint32) for o in ones]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        kind = np.uint16 if bits <= 16 else np.uint32  # half the bytes to move
        ids = ids.astype(kind)
        zeros, planes, ones = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (ids >> kind(level) & kind(1)).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-len(ids) // STEP) * STEP // 8, np.uint8)
            padded[: len(plane)] = plane
            counts = np.bitwise_count(padded).reshape(-1, STEP // 8).sum(axis=1, dtype=np.uint32)
            planes.append(padded.tobytes())
            ones.append(np.append(np.uint32(0), np.cumsum(counts, dtype=np.uint32)).tobytes())
            zeros.append(int(len(ids) - counts.sum()))
            ids = np.concatenate([ids[~bit], ids[bit]])
        found = cls(0, zeros, planes, ones)
        found.n = len(ids)
        return found

    def _ones_before(self, level: int, at: int) -> int:
        whole, rest = divmod(at, STEP)
        piece = self.planes[level][whole * STEP // 8 : (at + 7) // 8]
        inside = int(np.unpackbits(piece, count=rest, bitorder="little").sum()) if rest else 0
        return int(self.ones[level][whole]) + inside

    def access(self, at: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][at // 8]) >> (at % 8) & 1
            before = self._ones_before(level, at)
            at = zeros + before if bit else at - before
            value = value * 2 + bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before ``end`` stand below the last plane."""
        low = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones_before(level, low), self._ones_before(level, end)
            if token >> (len(self.zeros) - 1 - level) & 1:
                low, end = zeros + a, zeros + b
            else:
                low, end = low - a, end - b
        return low, end

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before a place."""
        if token >> len(self.zeros):
            return 0
        low, high = self._range(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0); there must be that many."""
        at = self._range(token, self.n)[0] + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            nth = at - self.zeros[level] if bit else at
            at = self._nth(level, bit, nth)
        return at

    def _nth(self, level: int, bit: int, nth: int) -> int:
        """Place of the nth one or zero of a plane."""
        starts = self.ones[level].astype(np.int64)
        if not bit:
            starts = np.arange(len(starts), dtype=np.int64) * STEP - starts
        whole = int(np.searchsorted(starts, nth, side="right")) - 1
        piece = np.unpackbits(
            self.planes[level][whole * STEP // 8 : (whole + 1) * STEP // 8], bitorder="little"
        )
        return whole * STEP + int(np.flatnonzero(piece == bit)[nth - int(starts[whole])])

    def all_ids(self) -> np.ndarray:
        """The whole sequence: from the last plane up, put what stood after the zeros and
        ones of a plane back to where they were."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        value = np.zeros(self.n, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, kind)
            before[~bit] = value[: self.zeros[level]]
            before[bit] = value[self.zeros[level] :] | kind(1 << (len(self.zeros) - 1 - level))
            value = before
        return value.astype(np.uint32)


# --- writing -------------------------------------------------------------------


class WordEncoder(dict):
    """Ids by word, as 32-bit little-endian bytes.

    For tokenizers that drop white space and never look across it, so that a
    text's ids are those of its words one after the other, and that lower the case
    and keep runs of letters together (tested for the public ``word_bpe_49k``). A word met
    for the first time goes to the library's model if it is one piece there, else through
    all of the library's steps. A word that holds an added token such as ``<|endoftext|>``,
    in any case, always goes there as it is: the library looks for added tokens before it
    lowers the case. Two tables of known words take turns: when the younger is full the
    older is let go, so that words in use stay known.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.encode().lower() for token in added]
        #: what every added token begins with
        self.sign = os.path.commonprefix(self.added)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            if self.sign in word and self.holds_added(word):
                found = self.by_library(word)
            else:
                body, end = plainer(word)
                if body == word:
                    found = self.learned(word)
                else:
                    found = self[body] + self[end] if end else self[body]
        self[word] = found
        return found

    def holds_added(self, word: bytes) -> bool:
        lower = word.lower()
        return any(token in lower for token in self.added)

    def learned(self, word: bytes) -> bytes:
        piece = one_piece(word)
        if piece is None:
            return self.by_library(word)
        return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()

    def by_library(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, batch: list[bytes]) -> list[bytes]:
        """Ids of texts in UTF-8. Capitals of ASCII are lowered in the text as a whole, unless it
        may hold an added token, so that fewer forms of a word are met."""
        if len(self) > MAX_WORDS:
            self.older = dict(self)
            self.clear()
        lowered = [text if self.sign in text else text.lower() for text in batch]
        return [b"".join(map(self.__getitem__, text.split())) for text in lowered]


#: byte-level tokenizers write a byte as this character: itself where it can be printed
BYTE_CHARS = {
    byte: 256 + i
    for i, byte in enumerate(b for b in range(256) if b < 33 or 126 < b < 161 or b == 173)
}


def one_piece(word: bytes) -> str | None:
    """The bytes, as characters, of a lower-case word of Latin letters in composed form."""
    if word.isascii():
        return word.decode() if word.isalpha() else None
    text = word.decode()
    if not text.isalpha() or max(text) >= "\u0250" or text != text.lower() or not is_normalized("NFC", text):
        return None
    return word.decode("latin-1").translate(BYTE_CHARS)


#: signs that are no part of a piece with letters; an apostrophe may be (``'s``)
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def plainer(word: bytes) -> tuple[bytes, bytes]:
    """A word in small letters, without the signs after its last letter or digit; and those
    signs, which are a piece of their own."""
    body = word.rstrip(SIGNS)
    if word.isascii():
        if body[-1:].isalnum():
            return body.lower(), word[len(body):]
        return word.lower(), b""
    text = body.decode()
    if not (text[-1:].isalpha() and text[-1:].lower()[-1:].isalpha()):  # U+0130 ends in a mark then
        return word, b""
    small = text.lower().encode() if max(text) < "\u0250" and "\u0130" not in text else body
    return small, word[len(body):]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """Built once in each Python worker, from the library's own file."""
    return WordEncoder(path)


def _block(shard: int, block: int, start: int, docs: list[tuple]) -> dict:
    ids = np.frombuffer(b"".join(d[1] for d in docs), "<u4")
    matrix = WaveletMatrix.of(ids)
    return {
        "shard": shard, "block": block, "start_in_shard": start, "n_tokens": len(ids),
        "doc_ids": [d[0] for d in docs], "lengths": [len(d[1]) // 4 for d in docs],
        "zeros": matrix.zeros, "planes": [p.tobytes() for p in matrix.planes],
        "ones": [o.tobytes() for o in matrix.ones],
    }


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}
    fields = (field.split(" ", 1) for field in FILE_SCHEMA.split(", "))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Encode whole texts and write the shard files under ``path``.

    Texts are exchanged once, by ranges of their ids, as many as there are shards; the
    task that gets a range encodes it and packs it, one block in memory at a time, so that
    ids never leave it but as planes. Rows that share an id, even very many, are dealt to
    ranges by a hash of their text.
    """
    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    n_shards = max(1, -(-rows.count() // SHARD_DOCS))
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, schema = _encoder(tokenizer), _arrow_schema()
        shard, block, start, docs, held = 0, 0, 0, [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(shard, block, start, docs)], schema)

        for batch in pieces(batches):
            found = encoder.encode(batch.column(1).cast(pa.binary()).to_pylist())
            for doc_id, shard, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), found):
                n = len(ids) // 4 + 1
                if docs and held + n > BLOCK_TOKENS:
                    yield closed()
                    block, start, docs, held = block + 1, start + held, [], 0
                docs.append((doc_id, ids + end))
                held += n
        if docs:
            yield closed()

    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(n_shards, *order).sortWithinPartitions(*order)
    dealt.withColumn("shard", F.spark_partition_id()).mapInArrow(pack, FILE_SCHEMA).write.partitionBy(
        "shard"
    ).option("compression", "zstd").parquet(path)


# --- reading -------------------------------------------------------------------


def open_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ones"])


def shard_starts(blocks: DataFrame) -> DataFrame:
    """shard, shard_start: ids in all shards before; from the counts alone."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")
    )


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (array), read back."""
    blocks = open_token_files(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                ids = _matrix(row).all_ids().astype("<u4")
                ends = np.cumsum(row["lengths"])
                data, stops = memoryview(ids.tobytes()), (ends * 4).tolist()
                crcs = [zlib.crc32(data[a:b]) for a, b in zip([0, *stops], stops)]
                columns = [
                    pa.array([row["shard"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start_in_shard"] + ends - row["lengths"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["shard", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(0, ends).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long"
    rows = blocks.mapInArrow(read, schema + ", ids array<int>" * with_ids)
    return rows.join(shard_starts(blocks), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids,
    )


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id and position in the document of every occurrence of an id, by select."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                matrix = _matrix(row)
                at = np.array([matrix.select(token, k) for k in range(matrix.count(token))], np.int64)
                ends = np.cumsum(row["lengths"])
                of = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][d] for d in of], pa.int64()),
                     pa.array(at - (ends - row["lengths"])[of], pa.int64())],
                    ["doc_id", "position"],
                )

    return open_token_files(spark, path).mapInArrow(find, "doc_id long, position long")
