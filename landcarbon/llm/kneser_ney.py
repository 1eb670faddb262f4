"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Words are counted first; their 64-bit hashes, sorted, give every word an id. Word pairs are then counted by id: a task
counts what it reads and sends one block of sorted keys per shard, a shard merges its blocks and writes a sorted array
of keys and one of counts. Shards go by the hash of the pair, so that a frequent word is spread over all of them.
Followers and predecessors of each word are summed from the shards by ranges of ids. Workers map the files into memory,
so that a machine holds one copy in its page cache, whatever the number of workers.

The folder of the model must be mounted on all machines. Files are written under another name first and then renamed,
so a task that runs twice leaves the same file. Null counts as an empty text, which is one end token; a null id counts
as an empty one; repeated rows count as often as they stand.
"""

from __future__ import annotations

import itertools
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import map_arrow, mounted, shared_path

END, BEGIN = b" end", b" begin"  # no word holds a blank
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_MIX = 0x9E3779B97F4A7C15
_BACK = pow(_MIX, -1, 1 << 64)
LEAST_BITS = 7  # shards: 128 at least, each with about SHARD keys at most
SHARD = 1 << 20
TOGETHER = 1 << 21  # tokens counted at once
KNOWN = 300_000  # words that a task keeps with their ids


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, A-Z in lower case, then the end token."""
    out = [w for w in (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ") if w]
    out.append(END)
    return out


def hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def held_out(id_col: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == part


def _save(path: str, array: np.ndarray) -> None:
    part = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


def _bits(total: int) -> int:
    return max(LEAST_BITS, (max(total - 1, 1) // SHARD).bit_length())


def count_words(docs: DataFrame, folder: str, text_col: str) -> tuple[int, int, list[int]]:
    """Write sorted word hashes and counts per shard; returns tokens, distinct tokens and the shard sizes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            h = hashes(list(counts)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(list(counts.values()), pa.int64())], ["h", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
                if len(counts) > 2 * KNOWN:
                    yield flush()
                    counts.clear()
        yield flush()

    words = map_arrow(docs.select(text_col), count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    bits = LEAST_BITS + 3  # by the hash itself: about even for any number of words

    def write(table: pa.Table) -> pa.Table:
        h = table["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        shard = int(h[0] >> np.uint64(64 - bits))
        n = table["n"].to_numpy()[order]
        _save(f"{folder}/word-{shard}.npy", h[order])
        _save(f"{folder}/times-{shard}.npy", n)
        return pa.table({"shard": pa.array([shard], pa.int32()), "size": pa.array([len(h)], pa.int64()), "n": pa.array([int(n.sum())], pa.int64())})

    shards = words.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("shard")).applyInArrow(write, "shard int, size long, n long").collect()
    sizes = [0] * (1 << bits)
    for r in shards:
        sizes[r.shard] = r["size"]
    return sum(r.n for r in shards), sum(sizes), sizes


class Words:
    """Ids and counts of words, from mapped files. Unknown words share the id behind the last one."""

    def __init__(self, folder: str, sizes: list[int]):
        self.bits = (len(sizes) - 1).bit_length()
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.size = int(self.start[-1])
        self.begin = self.size + 1
        opened = [(np.load(f"{folder}/word-{i}.npy", mmap_mode="r"), np.load(f"{folder}/times-{i}.npy", mmap_mode="r")) if n else None for i, n in enumerate(sizes)]
        self.shards = opened
        self.known: dict[bytes, int] = {}  # place in the two arrays behind
        self.id_of, self.times_of = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Id and training count of every token of the rows, one row behind the other."""
        seen = set().union(*rows)
        new = list(seen - self.known.keys())
        if len(self.known) + len(new) > KNOWN:
            self.known, new = {}, list(seen)
            self.id_of, self.times_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = hashes(new)
        order = np.argsort(h)
        at = np.full(len(new), self.size, np.int64)
        times = np.zeros(len(new), np.int64)
        sorted_h = h[order]
        cuts = np.searchsorted(sorted_h >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if self.shards[s] is None:
                continue
            own = order[cuts[s] : cuts[s + 1]]
            table, n = self.shards[s]
            place = np.minimum(np.searchsorted(table, h[own]), len(table) - 1)
            hit = table[place] == h[own]
            at[own[hit]] = place[hit] + self.start[s]
            times[own[hit]] = n[place[hit]]
        self.known.update(zip(new, range(len(self.id_of), len(self.id_of) + len(new))))
        self.id_of, self.times_of = np.concatenate((self.id_of, at)), np.concatenate((self.times_of, times))
        places = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(rows)), np.int64, sum(map(len, rows)))
        return self.id_of[places], self.times_of[places]

    def pairs(self, ids: np.ndarray, lengths: list[int]) -> np.ndarray:
        """Mixed keys of (word before, word); the first word of a text follows the begin mark."""
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)] = self.begin
        return (before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)) * np.uint64(_MIX)


def _chunks(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    rows, size = [], 0
    for text in texts:
        rows.append(tokens(text))
        size += len(rows[-1])
        if size >= TOGETHER // 8:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def count_pairs(docs: DataFrame, folder: str, sizes: list[int], total: int, text_col: str) -> dict:
    """Write sorted pair keys and counts per shard, and followers and predecessors per range of ids."""
    bits = _bits(total)
    step = max(1, -(-(sum(sizes) + 2) // (1 << LEAST_BITS)))  # ids per range
    low = np.uint64(64 - bits)

    def blocks(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = np.searchsorted(keys >> low, np.arange((1 << bits) + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cuts)).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([keys[cuts[s] : cuts[s + 1]].tobytes() for s in used], pa.binary()),
                pa.array([counts[cuts[s] : cuts[s + 1]].astype("<u4").tobytes() for s in used], pa.binary()),
            ],
            ["shard", "keys", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, waiting, size = Words(folder, sizes), [], 0
        for batch in batches:
            for rows in _chunks(batch.column(0).to_pylist()):
                waiting.append(words.pairs(words.ids(rows)[0], [len(r) for r in rows]))
                size += len(waiting[-1])
                if size >= 2 * TOGETHER:
                    yield blocks(*np.unique(np.concatenate(waiting), return_counts=True))
                    waiting, size = [], 0
        if waiting:
            yield blocks(*np.unique(np.concatenate(waiting), return_counts=True))

    def merge(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), "<u8")
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), "<u4")
        keys, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, counts, len(keys)).astype(np.int64)
        _save(f"{folder}/pair-{shard}.npy", keys)
        _save(f"{folder}/pairs-{shard}.npy", counts.astype(np.uint32 if counts.max() < 2**32 else np.int64))
        pairs = keys * np.uint64(_BACK)
        before, after = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ids, place = np.unique(np.concatenate((before, after + (1 << 32))), return_inverse=True)
        n = np.zeros((len(ids), 4), np.int64)
        np.add.at(n, (place[: len(keys)], np.minimum(counts, 3) - 1), 1)
        np.add.at(n, (place[len(keys) :], 3), 1)
        follows, ids = ids >> 32, ids & 0xFFFFFFFF
        n[:, :3] *= (follows == 0)[:, None]
        n[:, 3] *= follows
        order = np.argsort(ids, kind="stable")
        ids, n = ids[order], n[order]
        cuts = np.searchsorted(ids, np.arange((1 << LEAST_BITS) + 1) * step)
        used = np.flatnonzero(np.diff(cuts)).tolist()
        of = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "ids": pa.array([ids[cuts[r] : cuts[r + 1]].astype("<u4").tobytes() for r in used], pa.binary()),
                "n": pa.array([n[cuts[r] : cuts[r + 1]].astype("<u4").tobytes() for r in used], pa.binary()),
                "of": pa.array([of.tolist() if k == 0 else [0] * 4 for k in range(len(used))], pa.list_(pa.int64())),
                "pairs": pa.array([len(keys) if k == 0 else 0 for k in range(len(used))], pa.int64()),
                "shard": pa.array([shard] * len(used), pa.int32()),
            }
        )

    def around(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        n = np.zeros((step, 4), np.int64)
        for ids, own in zip(table["ids"].to_pylist(), table["n"].to_pylist()):
            np.add.at(n, np.frombuffer(ids, "<u4") - part * step, np.frombuffer(own, "<u4").reshape(-1, 4))
        _save(f"{folder}/around-{part}.npy", n)
        kinds = np.bincount(np.minimum(n[:, 3], 5), minlength=6)[1:]
        of = np.array(table["of"].to_pylist()).sum(0)
        shards = [s for s, k in zip(table["shard"].to_pylist(), table["pairs"].to_pylist()) if k]
        return pa.table(
            {
                "part": pa.array([part], pa.int32()),
                "of": pa.array([of.tolist()], pa.list_(pa.int64())),
                "kinds": pa.array([kinds.tolist()], pa.list_(pa.int64())),
                "pairs": pa.array([sum(table["pairs"].to_pylist())], pa.int64()),
                "shards": pa.array([shards], pa.list_(pa.int32())),
            }
        )

    counted = map_arrow(docs.select(text_col), count, "shard int, keys binary, counts binary")
    merged = counted.groupBy("shard").applyInArrow(merge, "part int, ids binary, n binary, of array<long>, pairs long, shard int")
    rows = merged.groupBy("part").applyInArrow(around, "part int, of array<long>, kinds array<long>, pairs long, shards array<int>").collect()
    sums = lambda name, n: np.array([r[name] for r in rows] or [[0] * n]).sum(0).tolist()
    return {
        "bits": bits,
        "step": step,
        "of": sums("of", 4),
        "kinds": sums("kinds", 5),
        "pairs": sum(r.pairs for r in rows),
        "shards": sorted(s for r in rows for s in r.shards),
        "parts": sorted(r.part for r in rows),
    }


def discounts(of: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of counts 1 to 4; 0.5, 1 and 1.5 where those are too few."""
    n1, n2, n3, n4 = of[:4]
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return [float(min(max(d, 0.05), k - 0.05)) for k, d in zip((1, 2, 3), raw)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Count the training documents and write the model; returns its folder."""
    folder = mounted(shared_path(docs.sparkSession))
    os.makedirs(folder, exist_ok=True)
    own = docs.filter(~held_out(id_col))
    n, distinct, sizes = count_words(own, folder, text_col)
    pairs = count_pairs(own, folder, sizes, n, text_col)
    with open(f"{folder}/model.json", "w") as f:
        json.dump({"tokens": n, "distinct": distinct, "sizes": sizes, **pairs}, f)
    return folder


class Model:
    def __init__(self, folder: str):
        with open(f"{folder}/model.json") as f:
            self.m = json.load(f)
        m = self.m
        self.words = Words(folder, m["sizes"])
        load = lambda name: np.load(f"{folder}/{name}.npy", mmap_mode="r")
        self.pairs = {s: (load(f"pair-{s}"), load(f"pairs-{s}")) for s in m["shards"]}
        self.around = {p: load(f"around-{p}") for p in m["parts"]}
        self.d, self.d_low = np.array([0.0, *discounts(m["of"])]), np.array([0.0, *discounts(m["kinds"])])
        kinds = m["kinds"]
        left = self.d_low[1] * kinds[0] + self.d_low[2] * kinds[1] + self.d_low[3] * sum(kinds[2:])
        self.uniform = (left / m["pairs"] if m["pairs"] else 1.0) / (m["distinct"] + 1)

    def _around(self, ids: np.ndarray) -> np.ndarray:
        """Followers with count 1, 2, 3 or more, and predecessors, of sorted ids."""
        out, step = np.zeros((len(ids), 4), np.int64), self.m["step"]
        cuts = np.searchsorted(ids, np.arange((1 << LEAST_BITS) + 1) * step)
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            if p in self.around:
                own = slice(cuts[p], cuts[p + 1])
                out[own] = self.around[p][ids[own] - p * step]
        return out

    def _per_id(self, ids: np.ndarray) -> np.ndarray:
        used, place = np.unique(ids, return_inverse=True)
        return self._around(used)[place]

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Probability of the word after the word before it, for sorted mixed keys."""
        counts, bits = np.zeros(len(keys), np.int64), self.m["bits"]
        cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s in self.pairs:
                own = slice(cuts[s], cuts[s + 1])
                table, n = self.pairs[s]
                place = np.minimum(np.searchsorted(table, keys[own]), len(table) - 1)
                counts[own] = np.where(table[place] == keys[own], n[place], 0)
        pairs = keys * np.uint64(_BACK)
        before, after = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        own, own_after = self._per_id(before), self._per_id(after)[:, 3]
        low = np.maximum(own_after - self.d_low[np.minimum(own_after, 3)], 0) / max(self.m["pairs"], 1) + self.uniform
        total = self._totals(before)
        rest = np.where(total > 0, (own[:, :3] @ self.d[1:]) / np.maximum(total, 1), 1.0)
        high = np.maximum(counts - self.d[np.minimum(counts, 3)], 0) / np.maximum(total, 1)
        return high + rest * low

    def _totals(self, ids: np.ndarray) -> np.ndarray:
        """Training tokens that follow each id: its own count, or the number of texts behind the begin mark."""
        used, place = np.unique(ids, return_inverse=True)
        out = np.zeros(len(used), np.int64)
        shard = np.searchsorted(self.words.start, used, side="right") - 1
        for s in np.unique(shard).tolist():
            if s < len(self.m["sizes"]) and self.words.shards[s] is not None:
                own = shard == s
                out[own] = self.words.shards[s][1][used[own] - self.words.start[s]]
        end = self.words.ids([[END]])
        out[used == self.words.begin] = int(end[1][0])
        out[used == int(end[0][0])] = 0
        return out[place]


def scores(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text, in log10."""
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder)
        n, distinct = model.m["tokens"], model.m["distinct"]
        for batch in batches:
            out: list[np.ndarray] = []
            for rows in _chunks(batch.column(2).to_pylist()):
                lengths = [len(r) for r in rows]
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
                ids, times = model.words.ids(rows)
                keys, place = np.unique(model.words.pairs(ids, lengths), return_inverse=True)
                log = np.log10(model.probabilities(keys))[place]
                base = np.log10((times + 1) / (n + distinct + 1))
                out.append(np.stack([lengths, np.add.reduceat((times > 0).astype(float), starts), np.add.reduceat(base, starts), np.add.reduceat(log, starts)]))
            got = np.concatenate(out, 1) if out else np.zeros((4, 0))
            arrays = [batch.column(0), batch.column(1), *(pa.array(got[i].astype(np.int64)) for i in (0, 1)), pa.array([n] * batch.num_rows, pa.int64()), pa.array(got[2]), pa.array(got[3])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_arrow(docs.select(id_col, held_out(id_col).alias("held"), text_col), run, schema)
