"""Benchmark decontamination with generalised suffix automata of the normalised test items.

Items become word sequences. Those of one block, a bounded number of words, form one automaton: every state is a set
of word strings that end at the same places. A window is 10 words, or a whole shorter item. The 64-bit hash of every window
of the benchmark stands in a sorted index with the blocks that hold it, so the documents are read once, whatever the size of the
benchmark: only stretches of words whose windows are in the index are streamed through the automata of their blocks. There the
length of the longest match that ends at each word is tracked, and where it reaches a window, the matched words are hit. So
the hashes choose what is looked at, and equal words alone decide.

Automata and index are files that the workers map or load; their folder must be mounted on all machines.
"""

from __future__ import annotations

import itertools
import os
import pickle
import re
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import WORD_BYTES, map_arrow, mounted, shared_path, staged, word_list

WINDOW = 10
BLOCK_WORDS = 2_000  # bounds one automaton: at most twice as many states
PIECE_WORDS = 5_000  # longer items are cut into overlapping pieces
BLOCKS_AT_ONCE = 16  # bounds the automata that one task keeps
SHARD = 1 << 20  # windows in a file of the index, about
FILTER_BITS = 28  # bounds the bits that a task asks before it looks into the index
CHUNK_BYTES = 1 << 20  # text that is hashed at once
_MIX = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95
_BACK = pow(_MIX, -1, 1 << 64)


class Automaton:
    """Suffix automaton of several word sequences; ``items`` are (words, ids, whole)."""

    def __init__(self, items: list[tuple[list[bytes], list[str], bool]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids = [ids for _, ids, _ in items]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for words, _, _ in items]
        whole: dict[int, list[int]] = {}
        for k, (codes, item) in enumerate(zip(coded, items)):
            state = 0
            for c in codes:
                state = self._extend(state, c)
            if 0 < len(codes) < window and item[2]:
                whole.setdefault(state, []).append(k)
        self._windows(coded)
        self._short(whole)

    def dump(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        made = cls.__new__(cls)
        vars(made).update(pickle.loads(data))
        return made

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def _windows(self, coded: list[list[int]]) -> None:
        """For each state, the state of its strings' last ``window`` words, and for that one the items that hold it."""
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.at_window = [-1] * len(order)
        for s in order[1:]:
            up = self.link[s]
            self.at_window[s] = self.at_window[up] if self.length[up] >= self.window else s if self.length[s] >= self.window else -1
        self.holders: dict[int, set[int]] = {}
        for k, codes in enumerate(coded):
            state = 0
            for c in codes:
                state = self.next[state][c]
                if self.at_window[state] >= 0:
                    self.holders.setdefault(self.at_window[state], set()).add(k)

    def _short(self, whole: dict[int, list[int]]) -> None:
        """For each state, the whole short items that end its strings: (own ones, those of states above)."""
        self.above: list[tuple[tuple[int, int], ...]] = [()] * len(self.length)
        self.own = {s: tuple((self.length[s], k) for k in ks) for s, ks in whole.items()}
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[s]
            self.above[s] = self.above[up] + self.own.get(up, ())

    def scan(self, words: list[bytes], offset: int, spans: list[tuple[int, int]], found: set[int]) -> None:
        """Add the hit word ranges (start, end exclusive) and the items with occurring windows."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, c in enumerate(map(self.vocabulary.get, words, itertools.repeat(-1)), offset):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c not in nxt[state]:
                continue
            state = nxt[state][c]
            matched += 1
            if matched >= window:
                spans.append((i - matched + 1, i + 1))
                found |= self.holders[self.at_window[state]]
            for n, k in self.above[state]:
                spans.append((i - n + 1, i + 1))
                found.add(k)
            if matched == length[state]:
                for n, k in self.own.get(state, ()):
                    spans.append((i - n + 1, i + 1))
                    found.add(k)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(_MIX)
    return h ^ h >> np.uint64(29)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words(NamedTuple):
    """The words of some texts, one behind the other: their bytes, places, hashes, and the first word of each text."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        """Words as ``word_list`` has them. Long texts are hashed in stretches of bounded length."""
        data = b" ".join(texts).translate(WORD_BYTES)
        letters = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = letters != 32
        turns = np.diff(inside)
        start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        hashes = np.empty(len(start), np.uint64)
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(end, start[a] + CHUNK_BYTES, "right")))
            at, stop = int(start[a]), int(end[b - 1])
            sums = np.zeros(stop - at + 1, np.uint64)
            np.cumsum(letters[at:stop] * _powers(_MIX, stop - at), out=sums[1:])
            begin = start[a:b] - at
            hashes[a:b] = _mixed((sums[end[a:b] - at] - sums[begin]) * _powers(_BACK, stop - at)[begin])
            a = b
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        return cls(data, start, end, hashes, np.searchsorted(start, bounds))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every ``n`` words of a text."""
        total = len(self.hashes) - n + 1
        if total <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.full(total, n, np.uint64)
        for j in range(n):
            out = out * np.uint64(_STEP) + self.hashes[j : j + total]
        of = self.texts()
        at = np.flatnonzero(of[:total] == of[n - 1 :])
        return _mixed(out[at]), at

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def words(self, a: int, b: int) -> list[bytes]:
        return self.data[self.start[a] : self.end[b - 1]].split()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges joined where they overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


class Files(NamedTuple):
    """Automata and index as the workers open them: folder, lengths of windows, number of windows."""

    folder: str
    sizes: list[int]
    windows: int

    @property
    def shard_bits(self) -> int:
        return (max(self.windows - 1, 0) // SHARD).bit_length()

    @property
    def filter_bits(self) -> int:
        return max(min(self.windows.bit_length() + 4, FILTER_BITS), self.shard_bits + 3)

    def shard(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.shard_bits) if self.shard_bits else np.zeros(len(hashes), np.uint64)

    def bit(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.filter_bits)).astype(np.int64)


class Blocks(NamedTuple):
    """All items in blocks: what the index was made of, one row per block, and the files."""

    table: DataFrame
    count: int
    files: Files

    def groups(self) -> list[int]:
        """First block of each group of ``BLOCKS_AT_ONCE``, the automata that a task keeps; one group even without items."""
        return list(range(0, max(self.count, 1), BLOCKS_AT_ONCE))


def _save(path: str, write) -> None:
    """Write under another name first, so that a task that runs twice leaves the same file."""
    part = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(part, "wb") as f:
        write(f)
    os.replace(part, path)


def automata(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Blocks:
    """Automata of all items in blocks, and their index, as files. Items without words are none; a null id is called "null"."""
    spark = items.sparkSession
    folder = mounted(shared_path(spark))
    os.makedirs(folder, exist_ok=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lines, whole = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_list(text)
                for start in range(0, max(len(words) - window + 1, 1) if words else 0, PIECE_WORDS - window + 1):
                    ids.append("null" if item is None else item)
                    lines.append(b" ".join(words[start : start + PIECE_WORDS]))
                    whole.append(len(words) < window)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lines, pa.binary()), pa.array(whole, pa.bool_())], ["item", "line", "whole"])

    pieces = map_arrow(items.select(F.col(id_col).cast("string"), text_col), cut, "item string, line binary, whole boolean")
    pieces = staged(pieces.groupBy("line").agg(F.collect_set("item").alias("items"), F.max("whole").alias("whole")))
    words = pieces.agg(F.sum(F.length(F.col("line")) / 4)).first()[0] or 0
    blocks = int(words // block_words) + 1

    def build(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["line"].to_pylist(), table["items"].to_pylist(), table["whole"].to_pylist()))
        made = Automaton([(line.split(b" "), ids, whole) for line, ids, whole in rows], window)
        block = table["block"][0].as_py()
        data = made.dump()
        _save(f"{folder}/block-{block}", lambda f: f.write(data))
        texts: dict[int, list[bytes]] = {}
        for line, _, whole in rows:
            n = line.count(b" ") + 1
            if whole or n >= window:
                texts.setdefault(min(n, window), []).append(line)
        hashes = np.unique(np.concatenate([Words.of(lines).windows(n)[0] for n, lines in texts.items()]))
        columns = [pa.array([block], pa.int64()), pa.array([list(texts)], pa.list_(pa.int32())), pa.array([hashes.astype("<u8").tobytes()], pa.binary())]
        return pa.Table.from_arrays(columns, ["block", "sizes", "hashes"])

    grouped = pieces.withColumn("block", F.pmod(F.xxhash64("line"), F.lit(blocks)).cast("long"))
    built = staged(grouped.groupBy("block").applyInArrow(build, "block long, sizes array<int>, hashes binary"))
    sizes = sorted(r.n for r in built.select(F.explode("sizes").alias("n")).distinct().collect())
    windows = built.agg(F.sum(F.length("hashes")).cast("long")).first()[0] or 0
    files = Files(folder, sizes, windows // 8)
    _index(built, files)
    return Blocks(built, blocks, files)


def _index(built: DataFrame, files: Files) -> None:
    """Write the sorted hashes of all windows, their blocks, and a filter with one bit for several hashes, in shards by hash."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.frombuffer(data, "<u8")
                cuts = np.searchsorted(files.shard(h), np.arange((1 << files.shard_bits) + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(cuts)).tolist()
                columns = [pa.array(used, pa.int64()), pa.array([block] * len(used), pa.int64()), pa.array([h[cuts[s] : cuts[s + 1]].tobytes() for s in used], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "hashes"])

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        parts = [np.frombuffer(data, "<u8") for data in table["hashes"].to_pylist()]
        h, of = np.concatenate(parts), np.repeat(table["block"].to_numpy(), [len(p) for p in parts])
        order = np.lexsort((of, h))
        h = h[order]
        wide = files.filter_bits - files.shard_bits
        bits = np.zeros(1 << wide, bool)
        bits[files.bit(h) - (shard << wide)] = True
        for name, array in (("hashes", h), ("blocks", of[order]), ("bits", np.packbits(bits))):
            _save(f"{files.folder}/{name}-{shard}.npy", lambda f: np.save(f, array))
        return pa.table({"n": pa.array([len(h)], pa.int64())})

    dealt = map_arrow(built.select("block", "hashes"), deal, "shard long, block long, hashes binary")
    dealt.groupBy("shard").applyInArrow(write, "n long").agg(F.sum("n")).collect()


class Scanner:
    """Finds the windows of the benchmark in texts, with its automata and index as files."""

    def __init__(self, files: Files):
        self.files = files
        self.kept: OrderedDict[int, Automaton] = OrderedDict()
        opened = [self._open(shard) for shard in range(1 << files.shard_bits)]
        self.shards = [shard[:2] for shard in opened]
        self.filter = np.concatenate([shard[2] for shard in opened])

    def _open(self, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names = [f"{self.files.folder}/{name}-{shard}.npy" for name in ("hashes", "blocks", "bits")]
        if not os.path.exists(names[0]):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << (self.files.filter_bits - self.files.shard_bits - 3), np.uint8)
        return np.load(names[0], mmap_mode="r"), np.load(names[1], mmap_mode="r"), np.load(names[2])

    def _automaton(self, block: int) -> Automaton:
        if block not in self.kept:
            with open(f"{self.files.folder}/block-{block}", "rb") as f:
                self.kept[block] = Automaton.load(f.read())
            if len(self.kept) > BLOCKS_AT_ONCE:
                self.kept.popitem(last=False)
        self.kept.move_to_end(block)
        return self.kept[block]

    def _known(self, words: Words, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First words of the windows of ``n`` words that the index knows, each with the blocks that hold it."""
        h, at = words.windows(n)
        bit = self.files.bit(h)
        maybe = np.flatnonzero(self.filter[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
        h, at = h[maybe], at[maybe]
        shard = self.files.shard(h)
        for s in np.unique(shard).tolist():
            hashes, blocks = self.shards[s]
            own = np.flatnonzero(shard == s)
            low, high = (np.searchsorted(hashes, h[own], side) for side in ("left", "right"))
            own, low, count = own[high > low], low[high > low], (high - low)[high > low]
            # A window of very many blocks, again and again in a text, comes in bounded portions.
            portion = np.cumsum(count) // SHARD
            for p in np.unique(portion).tolist():
                mine = portion == p
                times = count[mine]
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                yield np.repeat(at[own[mine]], times), blocks[np.repeat(low[mine], times) + step]

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """Of each text the number of words, the hit word ranges (start, end exclusive), merged, and the items that occur."""
        counts: list[int] = []
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        waiting: dict[int, list[tuple[int, int, list[bytes]]]] = {}
        held = 0
        for chunk in _chunks(texts):
            words = Words.of(chunk)
            of = words.texts()
            for n in self.files.sizes:
                for at, block in self._known(words, n):
                    order = np.lexsort((at, block))
                    at, block = at[order], block[order]
                    apart = (np.diff(at) > n) | (np.diff(block) != 0) | (np.diff(of[at]) != 0)
                    first, last = np.flatnonzero(np.concatenate(([True], apart))), np.flatnonzero(np.concatenate((apart, [True])))
                    for k, a, b in zip(block[first].tolist(), at[first].tolist(), (at[last] + n).tolist()):
                        text = int(of[a])
                        waiting.setdefault(k, []).append((len(counts) + text, a - int(words.first[text]), words.words(a, b)))
                        held += b - a
                    if held > SHARD:
                        self._stream(waiting, spans, items)
                        held = 0
            counts += np.diff(words.first).tolist()
        self._stream(waiting, spans, items)
        return counts, [merged(s) for s in spans], items

    def _stream(self, waiting: dict[int, list[tuple[int, int, list[bytes]]]], spans: list, items: list) -> None:
        """Stretches of words through the automata of their blocks, block by block."""
        for block in sorted(waiting):
            automaton = self._automaton(block)
            for text, offset, words in waiting[block]:
                found: set[int] = set()
                automaton.scan(words, offset, spans[text], found)
                items[text].update(i for k in found for i in automaton.ids[k])
        waiting.clear()


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts of a bounded size together."""
    rows, size = [], 0
    for text in texts:
        rows.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def matches(docs: DataFrame, blocks: Blocks, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """Every document with its hits: (doc_id, text, keep..., n_words, spans in words, items).

    One pass over the documents, whatever the number of blocks. Null has no words, repeated rows are matched one by one.
    """
    kinds = dict(docs.dtypes)
    columns = [id_col, text_col, *(c for c in keep if c not in (id_col, text_col))]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    schema += ", `_words` long, `_spans` array<struct<start:int,end:int>>, `_items` array<string>"
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    files = blocks.files

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(files)
        for batch in batches:
            counts, spans, items = scanner.scan([(text or "").encode() for text in batch.column(1).to_pylist()])
            places = [[{"start": a, "end": b} for a, b in hit] for hit in spans]
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays += [pa.array(counts, pa.int64()), pa.array(places, pa.list_(span)), pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "_words", "_spans", "_items"])

    return map_arrow(docs.select(*columns), scan, schema)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of ``matches``."""
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col(id_col).alias("doc_id"),
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cleaned(docs: DataFrame, blocks: Blocks, max_coverage: float = 0.5, text_col: str = "text", length_col: str | None = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """Documents without benchmark passages, in the columns of ``docs``.

    Matched spans are cut out of the text, and a document goes if they cover more than ``max_coverage`` of its words.
    Removal is repeated on a changed document until no window is left, since what stood around a span now meets. Columns
    go by number meanwhile, so that they may have any names. A null text has no words and stays, repeated rows are cleaned
    one by one.
    """
    names = docs.columns
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    length_col = f"c{names.index(length_col)}" if length_col in names else None
    columns = docs.columns
    found = matches(docs, blocks, id_col, text_col, columns)
    covered = F.aggregate("_spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    stays = found.filter(covered <= F.col("_words") * max_coverage)
    return _cut(stays, docs, text_col, length_col, blocks.files).toDF(*names)


def _cut(found: DataFrame, docs: DataFrame, text_col: str, length_col: str | None, files: Files) -> DataFrame:
    """The columns of ``docs`` with the spans cut out of the text, until none is found."""
    columns = docs.columns
    source = found.schema.names
    place, length_at = columns.index(text_col), columns.index(length_col) if length_col else None

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            spans = batch.column(source.index("_spans")).to_pylist()
            arrays = [batch.column(source.index(c)) for c in columns]
            if any(spans):
                made = made or Scanner(files)
                texts = arrays[place].to_pylist()
                lengths = arrays[length_at].to_pylist() if length_at is not None else None
                for i, hit in enumerate(spans):
                    if hit:
                        texts[i] = _without(texts[i], [(s["start"], s["end"]) for s in hit], made)
                        if lengths:
                            lengths[i] = len(texts[i])
                arrays[place] = pa.array(texts, arrays[place].type)
                if lengths:
                    arrays[length_at] = pa.array(lengths, arrays[length_at].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return map_arrow(found, remove, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))


def _without(text: str, spans: list[tuple[int, int]], scanner: Scanner) -> str:
    data = text.encode()
    while spans:
        places = [m.span() for m in _WORD.finditer(data)]
        out, at = [], 0
        for a, b in spans:
            out.append(data[at : places[a][0]])
            at = places[b - 1][1]
        data = b"".join([*out, data[at:]])
        spans = scanner.scan([data])[1][0]
    return data.decode()
