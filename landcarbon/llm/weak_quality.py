"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every text, for each aspect of bad text. The votes of all texts are
counted per pattern in Spark; expectation-maximisation over these counts (at most 3 to the number of labellers) estimates
how accurate each labeller is. The posterior of its pattern is the label of a text, and posterior labels of a bounded
sample train a linear scorer over hashed features. The scorer judges every text.

Null counts as an empty text. A text without words has no features and gets the scorer's bias alone; repeated rows
get equal scores; other columns are not read.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import map_arrow

SAMPLE = 6000  # bound of the training sample
BITS = 18
ASPECTS = ("symbols", "shouting", "repetition", "toxic")

# Words of insult, those that are hardly ever meant otherwise first.
INSULTS = frozenset(b"idiot idiots moron morons stupid imbecile scum bastard retard".split())
HARSH = frozenset(b"loser losers trash worthless pathetic disgusting filthy garbage dumb ugly hate kill".split())
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_MARKS = b".,;:!?()[]\"'" + _SYMBOLS
# Votes: against (1), for (0), none (2), by (measure, against from, for up to).
# Those on shares have no vote on texts of fewer than ``FEW`` words.
FEW = 8
LABELLERS = {
    "symbols": (("symbols", 0.3, 0.1), ("marked", 0.25, 0.1), ("symbol_bytes", 0.05, 0.02)),
    "shouting": (("capitals", 0.5, 0.2), ("exclaims", 0.3, 0.1), ("upper_bytes", 0.4, 0.2)),
    "repetition": (("repeats", 0.3, 0.1), ("windows", 0.5, 0.3), ("lines", 0.4, 0.2)),
    "toxic": (("insults", 1, 0), ("harsh", 1, 0), ("attack_rate", 0.004, 0.0), ("attack_kinds", 2, 0)),
}
SHARES = [m for a in ASPECTS[:3] for m, _, _ in LABELLERS[a]]


def measures(text: str | None) -> tuple[dict[str, float], set[bytes]]:
    """Measures of a text and its distinct words in lower case without marks around them."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, lower = data.split(), data.lower().split()
    n, size = max(len(words), 1), max(len(data), 1)
    kinds = {w.strip(_MARKS) for w in set(lower)}
    insults, harsh = INSULTS & kinds, HARSH & kinds
    bad = insults | harsh
    attacks = sum(w.strip(_MARKS) in bad for w in lower) if bad else 0
    found = {"insults": len(insults), "harsh": len(harsh), "attack_rate": attacks / max(n, 20), "attack_kinds": len(bad), "few": len(words) < FEW}
    if found["few"]:
        return found | dict.fromkeys(SHARES, 0.0), kinds
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    found |= {
        "symbols": symbols / n,
        "marked": sum(len(w) != len(w.translate(None, _SYMBOLS)) for w in words) / n if symbols else 0.0,
        "symbol_bytes": symbols / size,
        "capitals": sum(map(bytes.isupper, words)) / n,
        "exclaims": data.count(b"!") / n,
        "upper_bytes": (len(data) - len(data.translate(None, _UPPER))) / size,
        "repeats": sum(map(operator.eq, words, words[1:])) / n,
        "windows": 1 - len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1),
        "lines": 1 - len(set(lines)) / max(len(lines), 1),
    }
    return found, kinds


def votes(found: dict[str, float]) -> str:
    """A digit per labeller of each aspect: 1 against, 0 for, 2 none."""
    out = []
    for aspect in ASPECTS:
        for m, bad, good in LABELLERS[aspect]:
            none = found["few"] and m in found and aspect != "toxic"
            out.append("2" if none else "1" if found[m] >= bad else "0" if found[m] <= good else "2")
    return "".join(out)


def features(found: dict[str, float], kinds: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: presence of words, and shares in steps of their square root."""
    ids = [zlib.crc32(w) & ((1 << BITS) - 1) for w in kinds]
    shares = {m: min(found[m], 4.0) ** 0.5 for m in SHARES}
    ids += [zlib.crc32(b"=" + m.encode()) & ((1 << BITS) - 1) for m in shares]
    return np.array(ids, np.int64), np.array([1.0] * len(kinds) + list(shares.values()))


def count_votes(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Number of texts per pattern of votes, over all texts. Patterns are few, whatever the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                key = votes(measures(text)[0])
                counts[key] = counts.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    counted = map_arrow(docs.select(text_col), run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return {r.pattern: r.n for r in counted.collect()}


def accuracies(counts: dict[str, int], rounds: int = 60) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over (pattern, count) for one aspect: (share of bad texts, P(vote against | class) per labeller, posteriors).

    It starts from labellers that are right in most cases, and holds them to be right in half the cases at least;
    a missing vote says nothing. Patterns without any vote keep the prior.
    """
    patterns = sorted(counts)
    if not patterns:
        return 0.1, np.zeros((0, 2)), {}
    v = np.array([[int(c) for c in p] for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    prior = 0.1
    p = np.tile(np.array([0.1, 0.8]), (v.shape[1], 1))  # (labeller, class)
    for _ in range(rounds):
        log = np.where(v[:, :, None] == 1, np.log(p), np.where(v[:, :, None] == 0, np.log(1 - p), 0)).sum(1)
        odds = np.clip(log[:, 1] - log[:, 0] + np.log(prior / (1 - prior)), -50, 50)
        bad = 1 / (1 + np.exp(-odds))
        prior = float(np.clip((bad * n).sum() / n.sum(), 1e-4, 0.5))
        for cls, weight, low, high in ((0, (1 - bad) * n, 1e-4, 0.5), (1, bad * n, 0.5, 1 - 1e-4)):
            against = ((v == 1) * weight[:, None]).sum(0) + (0.1 if cls == 0 else 0.8)
            p[:, cls] = np.clip(against / (((v < 2) * weight[:, None]).sum(0) + 1), low, high)
    return prior, p, dict(zip(patterns, bad.tolist()))


def sample(docs: DataFrame, limit: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> list:
    """Votes and features of at most ``limit`` texts, those with the smallest hashes of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found, kinds = measures(text)
                ids, values = features(found, kinds)
                rows.append((votes(found), ids.astype("<i4").tobytes(), values.astype("<f4").tobytes()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.binary())))], ["key", "pattern", "ids", "values"])

    total = docs.select(id_col).count()
    key = F.xxhash64(F.lit(3), F.col(id_col))
    # A little more than asked for, so that the sort below sees few rows.
    near = docs.select(key.alias("key"), text_col).filter(F.pmod("key", F.lit(1 << 30)) <= int((1 << 30) * min(1.0, 1.3 * limit / max(total, 1))))
    picked = map_arrow(near, run, "key long, pattern string, ids binary, values binary")
    return picked.orderBy(F.pmod("key", F.lit(1 << 30)), "ids").limit(limit).collect()


def fit_scorer(rows: list, posterior: dict[str, float], start: int, end: int, rounds: int = 100, l1: float = 2e-4, least: int = 8) -> tuple[dict[int, float], float]:
    """Logistic weights over hashed features, by accelerated proximal gradient with an L1 penalty.

    Features seen in fewer than ``least`` texts of the sample keep weight 0. Returns the non-zero weights and the bias.
    """
    if not rows:
        return {}, -2.0
    target = np.array([posterior.get(r.pattern[start:end], 0.5) for r in rows])
    ids = [np.frombuffer(bytes(r.ids), "<i4") for r in rows]
    values = np.concatenate([np.frombuffer(bytes(r["values"]), "<f4") for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(i) for i in ids])
    known, column, seen = np.unique(np.concatenate(ids), return_inverse=True, return_counts=True)
    keep = (seen >= min(least, len(rows)))[column]
    row, column, values = row[keep], column[keep], values[keep]
    # Both classes weigh alike, or a rare one would hardly be learnt.
    share = float(np.clip(target.mean(), 0.02, 0.98))
    weight = target / share * 0.5 + (1 - target) / (1 - share) * 0.5
    weight /= weight.sum()
    w, bias = np.zeros(len(known)), 0.0
    z, z_bias, t = w, bias, 1.0
    # Curvature bound, from the largest row: words are few hundred features of size 1.
    sizes = np.bincount(row, values**2, len(rows)) + 1
    step = 4.0 / max(float((weight * sizes).sum()), 1e-9)
    for _ in range(rounds):
        score = np.bincount(row, z[column] * values, len(rows)) + z_bias
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - target) * weight
        new = z - step * np.bincount(column, error[row] * values, len(known))
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_bias = z_bias - step * error.sum()
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, z_bias = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    used = np.flatnonzero(w)
    return dict(zip(known[used].tolist(), w[used].tolist())), float(bias)


def train(docs: DataFrame, limit: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> dict[str, tuple[dict[int, float], float]]:
    """A scorer per aspect."""
    counts, rows = count_votes(docs, text_col), sample(docs, limit, id_col, text_col)
    model, start = {}, 0
    for aspect in ASPECTS:
        end = start + len(LABELLERS[aspect])
        own: dict[str, int] = {}
        for pattern, n in counts.items():
            own[pattern[start:end]] = own.get(pattern[start:end], 0) + n
        model[aspect] = fit_scorer(rows, accuracies(own)[2], start, end)
        start = end
    return model


def scored(docs: DataFrame, model: dict, keep: list[str] = (), id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """(id, keep..., probability of each aspect, rejected) of every text."""
    kinds = dict(docs.dtypes)
    columns = [id_col, text_col, *(c for c in keep if c not in (id_col, text_col))]
    named = [c for c in columns if c != text_col or c in keep]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in named) + "".join(f", p_{a} double" for a in ASPECTS) + ", rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << BITS) - 1
        words = {a: model[a][0] for a in ASPECTS}
        used = set().union(*words.values())
        for batch in batches:
            out: dict[str, list[float]] = {a: [] for a in ASPECTS}
            for text in batch.column(1).to_pylist():
                found, kinds = measures(text)
                hit = [i for i in (zlib.crc32(w) & mask for w in kinds) if i in used]
                ids, values = features(found, set())
                for a in ASPECTS:
                    get = words[a].get
                    score = model[a][1] + sum(get(i, 0.0) for i in hit) + sum(get(i, 0.0) * v for i, v in zip(ids.tolist(), values.tolist()))
                    out[a].append(float(1 / (1 + np.exp(-np.clip(score, -40, 40)))))
            bad = [max(p) >= limit for p in zip(*out.values())]
            arrays = [batch.column(columns.index(c)) for c in named]
            arrays += [*(pa.array(out[a], pa.float64()) for a in ASPECTS), pa.array(bad, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*named, *(f"p_{a}" for a in ASPECTS), "rejected"])

    return map_arrow(docs.select(*columns), run, schema)


def filtered(docs: DataFrame, limit: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the scorer does not reject, in the columns of ``docs``."""
    clash = [*(f"p_{a}" for a in ASPECTS), "rejected"]
    plain = docs.withColumnsRenamed({c: f"_own_{c}" for c in clash if c in docs.columns})
    kept = scored(plain, train(docs, limit, id_col, text_col), plain.columns, id_col, text_col).filter("not rejected").drop(*clash)
    return kept.withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*docs.columns)
