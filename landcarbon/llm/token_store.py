"""Token ids in directly addressable codes, written as a table of segments and read back.

An id is split into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level k the k-th chunk of those ids
that have one. A bitmap per level says which ids continue, and a rank directory (ones before every 512 bits) turns a
place on one level into the place on the next. So any token, or run of tokens, is read without decoding what is
before it.

Files: a Parquet table of segments under the shared folder, one row each: part, number in the part, tokens of the part
before it, document ids, their token ends, and the code bytes. Segments follow each other in ascending document id
(null first; equal ids in a fixed order). A segment ends after ``SEGMENT`` tokens, at the end of a document.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landcarbon.llm.common import map_arrow, shared_path

SEGMENT = 1 << 19
CACHE = 500_000  # distinct pieces that a task keeps
BLOCK = 512
MAGIC = b"DAC1"
# A word of these letters keeps them under normalisation, but for their case; the tokenizer splits it from the marks.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(f"[{LETTERS}{LETTERS.replace('ß', '').replace('ÿ', '').upper()}]+").fullmatch
MARKS = b".,!?;:*%&$#|"


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pack(ids: np.ndarray) -> bytes:
    """Code bytes of unsigned 32-bit ids: header, then per level its size, chunks, bitmap and directory."""
    out, rest = [], ids.astype(np.uint32)
    levels = 0
    while levels == 0 or len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate((bits, np.zeros(-len(bits) % 8 + 8, np.uint8)))
        ones = np.concatenate(([0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64)))) if len(more) else np.zeros(1, np.int64)
        chunks = (rest & 255).astype(np.uint8).tobytes()
        out += [struct.pack("<QQQ", len(rest), len(bits), len(ones)), chunks, b"\0" * (-len(chunks) % 8), bits.tobytes(), ones.astype("<u4").tobytes(), b"\0" * (-4 * len(ones) % 8)]
        rest = rest[more] >> 8
        levels += 1
    return MAGIC + struct.pack("<I", levels) + b"".join(out)


class Codes:
    """Random access to packed ids."""

    def __init__(self, data: bytes):
        assert data[:4] == MAGIC
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", data, 4)[0]):
            n, n_bits, n_ones = struct.unpack_from("<QQQ", data, at)
            at += 24
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n + -n % 8
            bits = np.frombuffer(data, "<u8", n_bits // 8, at)
            at += n_bits
            ones = np.frombuffer(data, "<u4", n_ones, at)
            at += 4 * n_ones + -4 * n_ones % 8
            self.levels.append((chunks, bits, ones))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, ones: np.ndarray, i: int) -> int:
        """Set bits before place i."""
        i = int(i)
        first, word = i // BLOCK * (BLOCK // 64), i // 64
        last = bits[word] & np.uint64((1 << i % 64) - 1) if i % 64 else np.uint64(0)
        return int(ones[i // BLOCK]) + int(np.bitwise_count(bits[first:word]).sum()) + int(np.bitwise_count(last))

    def __getitem__(self, i: int) -> int:
        value = shift = 0
        for chunks, bits, ones in self.levels:
            value |= int(chunks[i]) << shift
            if not int(bits[i // 64]) >> i % 64 & 1:
                return value
            i, shift = self._rank(bits, ones, i), shift + 8
        raise ValueError("the last level continues")

    def run(self, start: int, end: int) -> np.ndarray:
        """Ids from start to end, exclusive."""
        out = np.zeros(end - start, np.uint32)
        where = np.arange(end - start)
        for k, (chunks, bits, ones) in enumerate(self.levels):
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * k)
            own = np.unpackbits(bits[start // 64 : end // 64 + 1].view(np.uint8), bitorder="little")
            where = where[own[start % 64 : start % 64 + end - start].astype(bool)]
            if not len(where):
                break
            start, end = self._rank(bits, ones, start), self._rank(bits, ones, end)
        return out


class Tokens:
    """Ids of texts as little-endian bytes, by a tokenizer that never joins what white space separates.

    It also splits words from marks, so each distinct word and each distinct run of marks is encoded once.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from tokenizers.pre_tokenizers import ByteLevel

        made = Tokenizer.from_str(tokenizer)
        self.batch = getattr(made, "encode_batch_fast", made.encode_batch)
        self.merge = made.model.tokenize
        # What the byte-level step makes of a letter.
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {ord(c): shown(c)[0][0] for c in LETTERS}
        self.known: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [(text or "").encode().split() for text in texts]
        pieces = set().union(*split)
        # One by one: a difference with the keys would walk over all that is known, for each batch.
        known = self.known
        new = [piece for piece in pieces if piece not in known]
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, list(pieces)
            self.words = {}
        self._learn(new)
        return [b"".join(map(self.known.__getitem__, own)) for own in split]

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of new pieces. A word of plain letters goes to the merges at once, apart from the marks behind it."""
        words, known, whole = self.words, self.known, []
        for piece in pieces:
            word = piece.rstrip(MARKS)
            if word.isalpha():  # ASCII letters only
                low = word.lower()
                ids = words.get(low)
                if ids is None:
                    ids = words[low] = self._merged(low.decode())
            else:
                text = word.decode()
                if not PLAIN(text):
                    whole.append(piece)
                    continue
                text = text.lower()
                low = text.encode()
                ids = words.get(low)
                if ids is None:
                    ids = words[low] = self._merged(text.translate(self.shown))
            if len(word) < len(piece):
                tail = piece[len(word) :]
                if tail not in words:
                    words[tail] = self._each([tail.decode()])[0]
                ids += words[tail]
            known[piece] = ids
        self.known.update(zip(whole, self._each([p.decode() for p in whole])))

    def _merged(self, word: str) -> bytes:
        return pack_ids([t.id for t in self.merge(word)])

    def _each(self, pieces: list[str]) -> list[bytes]:
        return [pack_ids(e.ids) for e in self.batch(pieces, add_special_tokens=False)]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append the end id, and write segments in ascending document id. Null counts as empty."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"part int, number int, before long, n_tokens long, doc_ids array<{kind}>, ends array<int>, codes binary"
    close = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part = Tokens(tokenizer), TaskContext.get().partitionId()
        ids: list = []
        data: list[bytes] = []
        ends: list[int] = []
        number = before = 0

        def segment(id_type: pa.DataType) -> pa.RecordBatch:
            n = ends[-1]
            codes = pack(np.frombuffer(b"".join(data), "<u4"))
            arrays = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64())]
            arrays += [pa.array([ids], pa.list_(id_type)), pa.array([ends], pa.list_(pa.int32())), pa.array([codes], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["part", "number", "before", "n_tokens", "doc_ids", "ends", "codes"])

        for batch in batches:
            own = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                for doc, coded in zip(own[at : at + 256], made.encode(texts[at : at + 256])):
                    ids.append(doc)
                    data.append(coded + close)
                    ends.append((ends[-1] if ends else 0) + len(coded) // 4 + 1)
                    if ends[-1] >= SEGMENT:
                        yield segment(batch.column(0).type)
                        number, before = number + 1, before + ends[-1]
                        ids, data, ends = [], [], []
            kept_type = batch.column(0).type
        if ends:
            yield segment(kept_type)

    order = [F.col(id_col), F.xxhash64(text_col)]
    # Ranges over both, so that a very frequent id spreads too.
    dealt = docs.select(id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    map_arrow(dealt, run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the written segments."""
    segments = spark.read.parquet(path)
    kind = dict(segments.dtypes)["doc_ids"][6:-1]
    # One row per written part, so its number is bounded by the partitions of the write.
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = totals.selectExpr("part", "sum(n) over (order by part) - n as offset")
    placed = segments.join(F.broadcast(offsets), "part").selectExpr("offset + before as first", "doc_ids", "ends", "codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                first, codes = batch.column(0)[k].as_py(), Codes(batch.column(3)[k].as_py())
                ends = np.array(batch.column(2)[k].values)
                starts = np.concatenate(([0], ends[:-1]))
                ids = memoryview(codes.run(0, len(codes))).cast("B")  # all documents of a segment are wanted here
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                arrays = [batch.column(1)[k].values, pa.array(first + starts, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(placed, run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def stored(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write and read back under the shared folder."""
    path = shared_path(docs.sparkSession)
    write_tokens(docs, tokenizer, end_id, path, id_col, text_col)
    return read_tokens(docs.sparkSession, path)
