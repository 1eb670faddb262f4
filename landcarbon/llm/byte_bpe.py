"""Byte-level BPE as numpy matrices, by a public rank file.

Texts are split by the tokenizer's pattern. The distinct pieces of a batch are put into padded matrices by length;
in each round every row merges its leftmost pair of minimum rank. Ranks are found in a sorted table of hashed pairs,
and rows that have nothing left to merge are taken out. A piece beyond ``LONG`` bytes would need as many rounds as
bytes, so such pieces are merged with a heap, to the same ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from landcarbon.llm.common import map_arrow

LONG = 256
CACHE = 300_000  # distinct pieces that a task keeps
TOGETHER = 1 << 20  # characters of texts whose pieces are merged at once
NONE = np.int64(1 << 40)


class Ranks:
    """A rank file: bytes of every id, and merge ranks by pair of ids."""

    def __init__(self, data: bytes):
        pairs = [line.split() for line in data.splitlines() if line.strip()]
        self.ids = {base64.b64decode(t): int(r) for t, r in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ids.values(), default=-1) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.byte = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        keys, ranks = [], []
        get = self.ids.get
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):  # any two tokens that make up a third can merge
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    ranks.append(rank)
        # Open addressing in a table at most a quarter full.
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        keys, ranks = np.array(keys, np.int64), np.array(ranks, np.int64)
        self.probes, at = 0, self._hash(keys)
        while len(keys):
            self.probes += 1
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[free]  # of several keys for one slot, the last one stays
            won = self.slots[at] == keys
            self.values[at[won]] = ranks[won]
            keys, ranks, at = keys[~won], ranks[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, which is the id of the merged token; NONE if it doesn't merge."""
        keys = left << 20 | right
        at = self._hash(keys)
        out = np.where(self.slots[at] == keys, self.values[at], NONE)
        lost = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] >= 0))
        for _ in range(1, self.probes):
            if not len(lost):
                break
            at[lost] = (at[lost] + 1) & ((1 << self.bits) - 1)
            hit = self.slots[at[lost]] == keys[lost]
            out[lost[hit]] = self.values[at[lost[hit]]]
            lost = lost[~hit & (self.slots[at[lost]] >= 0)]
        return out

    def encode(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece, in the order given."""
        out: list[tuple[int, ...] | None] = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > LONG:
                out[i] = self._heap(piece)
            elif piece:
                by_size.setdefault((len(piece) + 3) // 4, []).append(i)
            else:
                out[i] = ()
        for rows in by_size.values():
            for start in range(0, len(rows), 4096):
                chunk = rows[start : start + 4096]
                for i, ids in zip(chunk, self._matrix([pieces[i] for i in chunk])):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        n, width = len(pieces), max(map(len, pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        inside = np.arange(width) < sizes[:, None]
        ids = np.where(inside, self.byte[raw], -1)
        ranks = np.full((n, width), NONE, np.int64)
        both = inside[:, 1:]
        r, c = np.nonzero(both)
        ranks[r, c] = self.rank(ids[r, c], ids[r, c + 1])
        rows = np.arange(n)
        out: list[tuple[int, ...]] = [()] * n
        while len(rows):
            best = ranks.argmin(1)
            every = np.arange(len(rows))
            low = ranks[every, best]
            done = low == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[rows[k]] = tuple(ids[k, : sizes[k]].tolist())
                go = ~done
                rows, ids, ranks, sizes, best, low = rows[go], ids[go], ranks[go], sizes[go], best[go], low[go]
                if not len(rows):
                    break
                every = np.arange(len(rows))
            ids[every, best] = low
            # Compaction: what stands right of the merged pair moves one place to the left.
            width = ids.shape[1]
            take = np.arange(width - 1) + (np.arange(width - 1) > best[:, None])
            ids = np.take_along_axis(ids, take, 1)
            ranks = np.take_along_axis(ranks, take, 1)
            sizes = sizes - 1
            right = best + 1 < sizes
            ranks[every, best] = NONE
            k = every[right]
            ranks[k, best[right]] = self.rank(ids[k, best[right]], ids[k, best[right] + 1])
            left = best > 0
            k = every[left]
            ranks[k, best[left] - 1] = self.rank(ids[k, best[left] - 1], ids[k, best[left]])
        return out

    def _heap(self, piece: bytes) -> tuple[int, ...]:
        """Leftmost pair of minimum rank first, by a heap over a linked list."""
        get, tokens = self.ids.get, self.tokens
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

        def rank(i: int) -> int | None:
            j = after[i]
            return get(tokens[ids[i]] + tokens[ids[j]]) if j < n else None

        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (x := rank(k)) is not None:
                    heapq.heappush(heap, (x, k, ids[k], ids[after[k]]))
        return tuple(x for x in ids if x >= 0)


class Encoder:
    """Texts to ids and back; keeps a bounded number of pieces."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.ranks = Ranks(data)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text; the new pieces of some texts together are merged at once."""
        texts = list(texts)
        start = 0
        while start < len(texts):
            split, size = [], 0
            while start < len(texts) and size < TOGETHER:
                text = texts[start] or ""
                split.append(self.split(text))
                size += len(text)
                start += 1
            pieces = set().union(*split)
            new = list(pieces - self.known.keys())
            if len(self.known) + len(new) > CACHE:
                self.known, new = {}, list(pieces)
            self.known.update(zip(new, self.ranks.encode([p.encode() for p in new])))
            known = self.known.__getitem__
            for own in split:
                yield list(itertools.chain.from_iterable(map(known, own)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.tokens.__getitem__, ids))


def encoded(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every text. Null counts as empty and has no ids; repeated rows are encoded one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            ids = pa.array(encoder.encode(batch.column(1).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return map_arrow(docs.select(id_col, text_col), run, f"doc_id {dict(docs.dtypes)[id_col]}, ids array<int>")


def decoded(ids: DataFrame, ranks: bytes) -> DataFrame:
    """(doc_id, bytes) of every row of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Ranks(ranks).tokens
        for batch in batches:
            out = [b"".join(map(tokens.__getitem__, row)) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return map_arrow(ids.select("doc_id", "ids"), run, f"doc_id {dict(ids.dtypes)['doc_id']}, bytes binary")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts to ids and back in one pass, kept as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        digits = [str(i) for i in range(len(encoder.ranks.tokens))]
        for batch in batches:
            counts, coded, back = [], [], []
            for ids in encoder.encode(batch.column(1).to_pylist()):
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select(id_col, text_col), run, schema)
