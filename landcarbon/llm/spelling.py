"""Groups spelling variants: words that differ by one edit, found through a reduced alphabet.

``words`` counts the words of all texts. ``near`` finds the pairs: every letter is hashed to one of ``SYMBOLS``
symbols; of each reduced word the full neighbourhood of one edit (itself, deletions, replacements, insertions over
the symbols) is generated and joined with the reduced vocabulary, and the words behind two reduced words that meet are
compared as they are. Words one edit apart are at most one edit apart after reduction too, so none is missed.

Reduced words that stand for many words would give a square of comparisons. Where two that meet stand for more than
``CROWDED`` pairs, the same generation is done once more over the letters themselves: a word has a bounded number of
neighbours there, and only real ones meet.

Null texts have no words, a null id counts as empty text, repeated rows count as often as they stand there. Other columns
are never read. An empty table gives no rows. Batches are bounded in bytes, so very long texts need no more than themselves.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import map_arrow, staged

LENGTH = 6  # least code points of a word
TIMES = 5  # least occurrences
RATIO = 5  # a form stands at least so many times as often
DAMAGED = 199
SYMBOLS = 8
CROWDED = 4096
HELD = 400_000  # words that a task counts before it passes them on
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Latin-1: letters, A-Z as lower case; all else is a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words(docs: DataFrame, length: int = LENGTH, times: int = TIMES, damaged: int = DAMAGED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of whole texts with at least ``length`` code points and ``times`` occurrences.

    A run whose checksum, together with the id, ``damaged`` divides loses the code point that the checksum points to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            keys = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([keys, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # What Latin-1 lacks becomes "?", which ends a run as the character itself does.
                own = Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split())
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word in [w for w in own if zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start) % damaged == 0]:
                    h, n = zlib.crc32(word.decode("latin-1").encode(), start), own.pop(word)
                    at = h % len(word)
                    held[word[:at] + word[at + 1 :]] += n
                held.update(own)
                if len(held) > HELD:
                    yield counted()
                    held.clear()
        yield counted()

    found = map_arrow(docs.select(F.col(id_col).cast("string"), text_col), run, "word string, n long")
    found = found.filter(F.length("word") >= length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def symbols(letters: np.ndarray, number: int | None) -> np.ndarray:
    """Letters (code points) as symbols from 0 on; ``None`` leaves every letter a symbol of its own."""
    if number is None:
        return letters.astype(np.uint64)
    x = letters.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(40)) % np.uint64(number)


def keyed(digits: np.ndarray) -> np.ndarray:
    """The key of each row of symbols: a polynomial in 64 bits, and so of every word of one length at once."""
    powers = np.cumprod(np.full(digits.shape[1] + 1, _BASE), dtype=np.uint64)
    return ((digits + np.uint64(1)) * powers[:-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood(digits: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, keys) of all that one edit at most makes of words of one length, each just once."""
    n, length = digits.shape
    rows = np.arange(n)
    powers = np.cumprod(np.full(length + 2, _BASE), dtype=np.uint64)
    term = (digits + np.uint64(1)) * powers[:length]
    whole = term.sum(axis=1, dtype=np.uint64)
    yield rows, whole
    zero = np.zeros((n, 1), np.uint64)
    before = np.concatenate([zero, np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
    # What follows a place, moved by one place to the left or to the right.
    left = np.concatenate([np.cumsum(((digits[:, 1:] + np.uint64(1)) * powers[: length - 1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], zero], axis=1)
    right = np.concatenate([np.cumsum(((digits + np.uint64(1)) * powers[1 : length + 1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], zero], axis=1)
    for i in range(length):  # deletions; of a run of equal symbols only the first
        new = np.ones(n, bool) if i == 0 else digits[:, i] != digits[:, i - 1]
        yield rows[new], (before[:, i] + left[:, i])[new]
    for c in alphabet:
        own = powers * (c + np.uint64(1))
        for i in range(length):
            new = digits[:, i] != c
            yield rows[new], (whole - term[:, i] + own[i])[new]
        for i in range(length + 1):  # insertions; never before the same symbol
            new = digits[:, i] != c if i < length else np.ones(n, bool)
            yield rows[new], (before[:, i] + own[i] + right[:, i])[new]


def _by_length(found: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length."""
    sizes = np.array([len(w) for w in found], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer("".join(found[i] for i in at).encode("utf-32-le"), "<u4").reshape(len(at), size)


def _keys(df: DataFrame, number: int | None) -> DataFrame:
    """``df``, which starts with the word, with ``key``: that of the reduced word."""
    names = [*df.columns, "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, np.uint64)
            for at, letters in _by_length(batch.column(0).to_pylist()):
                key[at] = keyed(symbols(letters, number))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], names)

    return map_arrow(df, run, ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", key long")


def _neighbours(df: DataFrame, number: int | None, alphabet: list[int]) -> DataFrame:
    """(own, key): of (own, word) rows, the keys of all that is one edit of the symbols away at most."""
    chars = np.array(alphabet if number is None else range(number), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for at, letters in _by_length(batch.column(1).to_pylist()):
                digits = symbols(letters, number)
                held = max(1, (1 << 20) // (2 * len(chars) * digits.shape[1]))
                for first in range(0, len(at), held):
                    parts = list(neighbourhood(digits[first : first + held], chars))
                    of = own[at[first : first + held]][np.concatenate([r for r, _ in parts])]
                    keys = np.concatenate([k for _, k in parts]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(keys)], ["own", "key"])

    return map_arrow(df.select("own", "word"), run, f"own {dict(df.dtypes)['own']}, key long")


def near(vocabulary: DataFrame, number: int = SYMBOLS, crowded: int = CROWDED) -> DataFrame:
    """(word, n, other, other_n): every word of staged (word, n) rows with every one that is exactly one edit away."""
    keyed_words = staged(_keys(vocabulary.select("word", "n"), number))
    reduced = staged(keyed_words.groupBy("key").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("size")))
    # Of each reduced word one word stands for all: what one edit makes of its symbols is the same for them.
    around = _neighbours(reduced.select(F.col("key").alias("own"), "word"), number, [])
    sizes = reduced.select(F.col("key").alias("own"), F.col("size").alias("own_size"))
    met = around.join(reduced.select("key", "size").hint("shuffle_merge"), "key").filter("own != key or size > 1")
    met = staged(met.join(sizes, "own"))

    of = lambda side, key: keyed_words.select(F.col("key").alias(key), F.col("word").alias(side), F.col("n").alias(f"{side}_n"))
    one_edit = "abs(length(l) - length(r)) < 2 and levenshtein(l, r, 1) = 1"
    few = met.filter(f"own_size * size <= {crowded}").select("own", "key")
    pairs = few.join(of("l", "own"), "own").join(of("r", "key"), "key").filter(one_edit)
    out = ["l as word", "l_n as n", "r as other", "r_n as other_n"]
    many = met.filter(f"own_size * size > {crowded}").select("own", "key")
    if many.isEmpty():
        return pairs.selectExpr(*out)

    # Between crowded reduced words: the neighbourhood over the letters themselves.
    many = staged(many)
    ends = many.select(F.explode(F.array("own", "key")).alias("key")).distinct()
    there = staged(_keys(keyed_words.join(ends, "key", "left_semi").select("word", "n", F.col("key").alias("reduced")), None))
    letters = [ord(r.c) for r in there.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if r.c]
    around = _neighbours(there.select(F.col("word").alias("own"), "word"), None, letters)
    right = there.select("key", F.col("word").alias("r"), F.col("n").alias("r_n"), F.col("reduced").alias("r_reduced"))
    left = there.select(F.col("word").alias("l"), F.col("n").alias("l_n"), F.col("reduced").alias("l_reduced"))
    close = around.withColumnRenamed("own", "l").join(right.hint("shuffle_merge"), "key").filter(one_edit).join(left, "l")
    close = close.join(many, (F.col("l_reduced") == F.col("own")) & (F.col("r_reduced") == many["key"]), "left_semi")
    return pairs.selectExpr(*out).unionByName(close.selectExpr(*out))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead in the end, of staged (word, form) rows whose forms have no circle.

    Each round looks twice as far ahead, and a form is ``RATIO`` times as frequent as its word, so rounds are few.
    """
    ahead = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = staged(ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if ahead.filter("moved").isEmpty():
            return ahead.select("word", "root")
        ahead = ahead.drop("moved")


def variants(docs: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    The form is the most frequent word one edit away, of equally frequent ones the least by code point, if it stands at
    least ``ratio`` times as often; the root is where forms lead in the end.
    """
    vocabulary = staged(words(docs, **options))
    pairs = near(vocabulary)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    around = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    around = around.selectExpr("word", "n_near", f"if(-best.less >= {ratio} * n, best.other, null) as form", f"if(-best.less >= {ratio} * n, -best.less, null) as form_n")
    around = staged(around)
    last = roots(around.filter("form is not null").select("word", "form"))
    joined = vocabulary.join(around, "word", "left").join(last, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
