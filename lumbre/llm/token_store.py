"""Token ids in binary blocks with Elias-Fano document boundaries.

A block holds consecutive documents in ascending id order:

    magic b"LMEF" | version, id width (2 or 4 bytes), n_documents, n_tokens, n_null_ids, least id (header of fixed size)
    ids of all documents end to end, little endian, in the least width that holds the vocabulary
    Elias-Fano sequence of the documents' end offsets | Elias-Fano sequence of doc_id - least id

An Elias-Fano sequence of n numbers below u keeps the low log2(u / n) bits packed and the rest in unary: about
2 + log2(u / n) bits a number, and no table of 64-bit offsets. The place of every 64th set bit is stored in four bytes; select(i) starts
from the sample and reads on from there, without unpacking the rest. Blocks are kept as a binary column of Parquet files in the shared folder, so any store that Spark writes to will do.

Nulls: a null text is empty (only the end id); documents with a null id come first. Repeated ids: each row is a document of
its own, in the order of its text. Empty table: no blocks. A very long text is a block of its own and is encoded in parts. Clashing names: only the id and the text are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_trie import byte_letters, simple_pattern, text_slices
from .shared import as_rows, column, partitions, stage

MAGIC, VERSION = b"LMEF", 2
HEADER = struct.Struct("<4sHHQQQq")
SEQUENCE = struct.Struct("<QBQQ")  # n, low bits, bytes of low bits, bytes of high bits; then the samples, low bits and high bits
SAMPLE = 64
#: Pieces in a generation of a worker's memory, and their letters; two generations are kept.
REMEMBER, REMEMBER_LETTERS = 300_000, 4 << 20
#: Letters of a text after which it is cut at the next blank.
PART = 1 << 18
#: Bytes of ids after which a block is closed, and documents: building the boundaries takes some 400 bytes a document.
BLOCK, DOCUMENTS = 4 << 20, 1 << 16
#: How the vocabulary's byte-level splitter cuts text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|[\s]+(?![^\s])|[\s]+"
RARE = re.compile("[\u0530-\U0010ffff\x00\x1c-\x1f]")


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, samples: np.ndarray, low: bytes, high: bytes):
        self.n, self.low_bits, self.samples, self.low, self.high = n, low_bits, samples, low, high

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint32), b"", b"")
        low_bits = max(0, int(values[-1] + np.uint64(1)) // n).bit_length() - 1
        low_bits = max(0, low_bits)
        low = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        return cls(n, low_bits, places[::SAMPLE].astype("<u4"), np.packbits(low, bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes())

    def to_bytes(self) -> bytes:
        return SEQUENCE.pack(self.n, self.low_bits, len(self.low), len(self.high)) + self.samples.tobytes() + self.low + self.high

    @classmethod
    def from_bytes(cls, blob: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b = SEQUENCE.unpack_from(blob, at)
        samples = np.frombuffer(blob, "<u4", -(-n // SAMPLE), at + SEQUENCE.size)
        at += SEQUENCE.size + samples.nbytes
        return cls(n, low_bits, samples, bytes(blob[at : at + a]), bytes(blob[at + a : at + a + b])), at + a + b

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        word = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Number i of the sequence, found from the sampled place before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = self.high[at // 8] & (0xFF << (at % 8) & 0xFF)
        k = at // 8
        while (ones := byte.bit_count()) <= left:
            left -= ones
            k += 1
            byte = self.high[k]
        for _ in range(left):
            byte &= byte - 1
        place = 8 * k + (byte & -byte).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return high | (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)


def write_block(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    nulls = sum(d is None for d in doc_ids)
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    ends = EliasFano.of(np.cumsum([len(x) for x in ids]))
    numbers = EliasFano.of(np.array([d - least for d in known], np.uint64))
    body = [np.ascontiguousarray(x, f"<u{width}") for x in ids]
    return b"".join([HEADER.pack(MAGIC, VERSION, width, len(doc_ids), sum(map(len, ids)), nulls, least), *body, ends.to_bytes(), numbers.to_bytes()])


class Block:
    """Reads a block: the ids of document i are those from the end of document i - 1 to its own end."""

    def __init__(self, blob: bytes):
        magic, version, width, self.n, self.n_tokens, nulls, least = HEADER.unpack_from(blob)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block")
        self.ids = np.frombuffer(blob, f"<u{width}", self.n_tokens, HEADER.size)
        self.ends, at = EliasFano.from_bytes(memoryview(blob), HEADER.size + width * self.n_tokens)
        numbers, _ = EliasFano.from_bytes(memoryview(blob), at)
        self.doc_ids: list[int | None] = [None] * nulls + [int(x) + least for x in numbers.all()]

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends.select(i)]


class Pieces(dict):
    """The ids of pieces of text as bytes. A new piece is looked up in the generation before, or else encoded by the library's model."""

    def __init__(self, tokenize, dtype: np.dtype):
        super().__init__()
        self.tokenize, self.dtype = tokenize, dtype
        self.table = str.maketrans({b: c for b, c in enumerate(byte_letters())})
        self.before: dict[str, bytes] = {}
        self.letters = 0

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.before.get(piece)) is None:
            ids = array(self.dtype.char, [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.table))]).tobytes()
        self[piece] = ids
        self.letters += len(piece)
        return ids

    def age(self) -> None:
        if len(self) > REMEMBER or self.letters > REMEMBER_LETTERS:
            self.before = dict(self)
            self.clear()
            self.letters = 0


class ByteTokenizer:
    """The library's byte-level BPE; it encodes each distinct piece of text once and the pieces' ids are joined."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = list(self.library.get_added_tokens_decoder().values())
        self.special = [t.content for t in added]
        self.odd = re.compile("|".join([RARE.pattern, *map(re.escape, self.special)]))
        #: A piece begins at the first blank behind a letter or mark, if no special token reaches across it.
        self.cut = None if any(t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added) else re.compile("[!-~\u00a1-\u052f\u3040-\u9fff][ \t\r\n]")
        self.split = simple_pattern(SPLIT)
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.known = Pieces(self.library.model.tokenize, self.dtype)

    def parts(self, text: str) -> Iterator[str]:
        """The text, or parts of a long one that are encoded as they are in it."""
        at = 0
        while self.cut and len(text) - at > PART and (found := self.cut.search(text, at + PART)):
            yield text[at : found.end() - 1]
            at = found.end() - 1
        yield text[at:]

    def encode(self, text: str) -> bytes:
        if self.odd.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def batch(self, texts: list[str], end: int) -> Iterator[np.ndarray]:
        last = np.array([end], self.dtype).tobytes()
        self.known.age()
        for t in texts:
            if len(t) <= PART:
                ids = self.encode(t) + last
            else:
                pieces = []
                for part in self.parts(t):
                    pieces.append(self.encode(part))
                    self.known.age()
                ids = b"".join([*pieces, last])
            yield np.frombuffer(ids, self.dtype)


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def write_tokens(docs: DataFrame, path: str, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written blocks: part (ascending with the ids), seq, start (within the part), n_tokens, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part = byte_tokenizer(path), TaskContext.get().partitionId()
        ids, arrays, held, start, seq = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            blob = write_block(ids, arrays, tokenizer.width)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((part, pa.int32()), (seq, pa.int32()), (start, pa.int64()), (held, pa.int64()), (blob, pa.binary()))], ["part", "seq", "start", "n_tokens", "block"])

        for batch in batches:
            for doc_ids, texts in text_slices(batch):
                for doc_id, a in zip(doc_ids, tokenizer.batch(texts, end), strict=True):
                    if held and ((held + len(a)) * tokenizer.width > BLOCK or len(ids) >= DOCUMENTS):
                        yield close()
                        start, seq, held = start + held, seq + 1, 0
                        ids, arrays = [], []
                    ids.append(doc_id)
                    arrays.append(a)
                    held += len(a)
        if ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = as_rows(docs, id_col, text_col).repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return stage(ordered.mapInArrow(run, "part int, seq int, start long, n_tokens long, block binary"), "token-blocks")


def read_tokens(blocks: DataFrame) -> DataFrame:
    """One row a document, from the blocks alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    # One row a part: as many as the writing job had tasks, whatever the data.
    sizes = sorted((p, n) for p, n in blocks.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, blob in zip(*(column(batch, c) for c in ("part", "start", "block")), strict=True):
                block = Block(blob.as_py())
                first = before[part.as_py()] + start.as_py()
                ends = np.array([block.ends.select(i) for i in range(block.n)], np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(block.ids[s:e].astype("<u4").tobytes()) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.select("part", "start", "block").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
