"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

The network is trained in numpy, on windows of a bounded sample whose labels are the spans of the exact patterns. It
knows characters only by class, so that it goes by the shape of what is around them. A span holds a digit or an "@" by
definition, so only windows that do are decoded; they overlap by half. Where windows overlap, their scores are
averaged, and one Viterbi pass decodes each stretch of joined windows as a whole. What the network finds besides is
added, with a kind of its own (``seq_email`` and so on); exact spans always stay.

Positions are code points, end exclusive. A null text counts as empty; repeated rows are searched one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; first and further character of each kind
WIDTH, STRIDE = 64, 32
SAMPLE_WINDOWS = 1024  # bound of the training sample
CLASSES = 24

_TRIGGER = re.compile(r"[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can begin inside a run of digits whose first digit begins none, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each "@": the run before it as far as the last match, and a domain behind it."""
    last = 0  # end of the last match, or the place behind the last "@"
    at = text.find("@")
    while at >= 0:
        run = _LOCAL.match(text[last:at][::-1])
        domain = _DOMAIN.match(text, at + 1)
        last = at + 1
        if run and domain:
            yield at - run.end(), domain.end()
            last = domain.end()
        at = text.find("@", last)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def exact(text: str) -> list[tuple[int, int, int]]:
    """Spans of the exact patterns as (start, kind number, end), sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _class_table() -> np.ndarray:
    """Character class of each code point below 256; all others share one."""
    table = np.full(257, 3, np.uint8)
    table[48:58], table[65:91], table[97:123] = 1, 2, 4
    for i, c in enumerate("@.-+() \n_%:/,\"'=|;"):
        table[ord(c)] = 5 + i
    table[256] = 3
    return table


_CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 256)]


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    marks = {m.start() // STRIDE for m in _TRIGGER.finditer(text)}
    return sorted({s * STRIDE for k in marks for s in (k - 1, k) if s >= 0})


class Tagger:
    """LSTM in both directions over character classes, and a linear-chain CRF over its scores."""

    def __init__(self, seed: int = 7, embed: int = 8, hidden: int = 12):
        r = np.random.default_rng(seed)
        scale = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.hidden = hidden
        self.p = {"emb": r.normal(0, 0.5, (CLASSES, embed)), "out": scale(2 * hidden, TAGS), "out_b": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            self.p |= {f"x{d}": scale(embed, 4 * hidden), f"h{d}": scale(hidden, 4 * hidden), f"b{d}": np.repeat([1.0, 0, 0, 0], hidden)}

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (time, rows, hidden) of one direction, and what the backward pass needs."""
        p, H = self.p, self.hidden
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], H), x.dtype)
        out, kept = np.zeros((*x.shape[:2], H), x.dtype), []
        gates_x = x @ p[f"x{d}"] + p[f"b{d}"]
        for t in steps:
            z = gates_x[t] + h @ p[f"h{d}"]
            s = 1 / (1 + np.exp(-z[:, : 3 * H]))
            f, i, o, g = s[:, :H], s[:, H : 2 * H], s[:, 2 * H :], np.tanh(z[:, 3 * H :])
            before, c = (h, c), f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            kept.append((t, before, f, i, o, g, tc))
        return out, kept

    def scores(self, chars: np.ndarray) -> np.ndarray:
        """Tag scores (rows, time, tags) of rows of character classes."""
        x = self.p["emb"][chars.T]
        both = np.concatenate([self._run(x, d)[0] for d in "fb"], 2)
        return (both @ self.p["out"] + self.p["out_b"]).transpose(1, 0, 2)

    def _crf(self, e: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Mean negative log-likelihood and its gradients by scores, transitions and first tags."""
        n, T, K = e.shape
        trans = self.p["trans"]
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.p["first"]
        for t in range(1, T):
            alpha[:, t] = lse(alpha[:, t - 1, :, None] + trans, 1) + e[:, t]
        for t in range(T - 2, -1, -1):
            beta[:, t] = lse(trans + (e[:, t + 1] + beta[:, t + 1])[:, None], 2)
        z = lse(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - z[:, None, None])
        rows, times = np.arange(n), np.arange(T)
        gold = self.p["first"][tags[:, 0]] + e[rows[:, None], times, tags].sum(1) + trans[tags[:, :-1], tags[:, 1:]].sum(1)
        d_trans = np.zeros_like(trans)
        for t in range(1, T):
            d_trans += np.exp(alpha[:, t - 1, :, None] + trans + (e[:, t] + beta[:, t] - z[:, None])[:, None]).sum(0)
        np.add.at(d_trans, (tags[:, :-1], tags[:, 1:]), -1)
        d_first = marginal[:, 0].sum(0)
        np.add.at(d_first, tags[:, 0], -1)
        marginal[rows[:, None], times, tags] -= 1
        return float((z - gold).mean()), marginal / n, d_trans / n, d_first / n

    def _gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, H = self.p, self.hidden
        x = p["emb"][chars.T]
        runs = {d: self._run(x, d) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], 2)
        loss, de, d_trans, d_first = self._crf((both @ p["out"] + p["out_b"]).transpose(1, 0, 2), tags)
        de = de.transpose(1, 0, 2)
        g = {"trans": d_trans, "first": d_first, "out": np.einsum("tnh,tnk->hk", both, de), "out_b": de.sum((0, 1))}
        d_both, dx = de @ p["out"].T, np.zeros_like(x)
        for k, d in enumerate("fb"):
            dh = dc = np.zeros((x.shape[1], H))
            g |= {f"h{d}": np.zeros_like(p[f"h{d}"])}
            dz_all = np.zeros((*x.shape[:2], 4 * H))
            for t, (h0, c0), f, i, o, gg, tc in reversed(runs[d][1]):
                dh = dh + d_both[t, :, k * H : (k + 1) * H]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * c0 * f * (1 - f), dc * gg * i * (1 - i), dh * tc * o * (1 - o), dc * i * (1 - gg * gg)], 1)
                g[f"h{d}"] += h0.T @ dz
                dz_all[t] = dz
                dh, dc = dz @ p[f"h{d}"].T, dc * f
            g[f"x{d}"], g[f"b{d}"] = np.einsum("tne,tnz->ez", x, dz_all), dz_all.sum((0, 1))
            dx += dz_all @ p[f"x{d}"].T
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], chars.T, dx)
        return loss, g

    def fit(self, chars: np.ndarray, tags: np.ndarray, steps: int = 240, batch: int = 64, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam on random batches; returns the losses."""
        r, losses = np.random.default_rng(seed), []
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for s in range(1, steps + 1 if len(chars) else 1):
            rows = r.integers(0, len(chars), batch)
            loss, g = self._gradients(chars[rows], tags[rows])
            losses.append(loss)
            now = rate * (1 - 0.9 * s / steps)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**s)) / (np.sqrt(v[k] / (1 - 0.99**s)) + 1e-8)
        return losses

    def small(self) -> dict[str, np.ndarray]:
        return {k: v.astype(np.float32) for k, v in self.p.items()}

    @classmethod
    def of(cls, p: dict[str, np.ndarray]) -> Tagger:
        made = cls()
        made.p, made.hidden = p, p["hf"].shape[0]
        return made

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags (rows, time) for scores (rows, time, tags)."""
        n, T, K = e.shape
        back = np.zeros((n, T, K), np.int8)
        best = e[:, 0] + self.p["first"]
        for t in range(1, T):
            all_ = best[:, :, None] + self.p["trans"]
            back[:, t] = all_.argmax(1)
            best = np.take_along_axis(all_, back[:, t][:, None].astype(np.int64), 1)[:, 0] + e[:, t]
        tags = np.zeros((n, T), np.int64)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(T - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        return tags

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Spans (start, kind number, end) in each text, from windows reconciled over the whole text."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        # Stretches of windows that overlap, as (text, start, end of the last window).
        stretches, rows, places = [], [], []
        for k, text in enumerate(texts):
            starts = windows(text)
            if not starts:
                continue
            codes = np.concatenate((classes(text), np.zeros(WIDTH, np.uint8)))
            for s in starts:
                if not stretches or stretches[-1][0] != k or s - stretches[-1][2] > STRIDE - WIDTH:
                    stretches.append([k, s, s + WIDTH])
                stretches[-1][2] = s + WIDTH
                places.append((len(stretches) - 1, s))
                rows.append(codes[s : s + WIDTH])
        if not rows:
            return found
        chars = np.stack(rows)
        weight = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)[:, None]
        total = [np.zeros((b - a, TAGS + 1), np.float32) for _, a, b in stretches]
        for at in range(0, len(chars), 4096):
            for (stretch, s), e in zip(places[at : at + 4096], self.scores(chars[at : at + 4096])):
                own = total[stretch][s - stretches[stretch][1] :][:WIDTH]
                own[:, :TAGS] += e * weight
                own[:, TAGS:] += weight
        by_length: dict[int, list[int]] = {}
        for i, t in enumerate(total):
            by_length.setdefault(len(t), []).append(i)
        for same in by_length.values():
            for at in range(0, len(same), 2048):
                own = same[at : at + 2048]
                e = np.stack([total[i][:, :TAGS] / np.maximum(total[i][:, TAGS:], 1) for i in own])
                for i, tags in zip(own, self.viterbi(e)):
                    k, start, _ = stretches[i]
                    found[k] += _tag_spans(tags, start, texts[k])
        return [sorted(f) for f in found]


def _tag_spans(tags: np.ndarray, offset: int, text: str) -> list[tuple[int, int, int]]:
    """Runs of one kind that hold a trigger, without blanks at their ends."""
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    begins = (tags > 0) & (tags % 2 == 1)
    cuts = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | begins[1:], [True])))
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if kind[a] < 0:
            continue
        start, end = offset + a, min(offset + b, len(text))
        piece = text[start:end]
        start, end = start + len(piece) - len(piece.lstrip()), end - (len(piece) - len(piece.rstrip()))
        inside = text[start:end]
        if ("@" in inside) if kind[a] == 0 else sum(c.isdigit() for c in inside) >= (4 if kind[a] == 1 else 7):
            out.append((start, int(kind[a]), end))
    return out


def training_windows(docs: DataFrame, limit: int = SAMPLE_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of a bounded sample of different windows, in the order of a hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, chars, tags = [], [], []
            for text in batch.column(1).to_pylist():
                starts = windows(text or "")
                if starts:
                    codes = np.concatenate((classes(text), np.zeros(WIDTH, np.uint8)))
                    own = np.zeros(len(codes), np.uint8)
                    for a, kind, b in exact(text):
                        own[a:b] = 2 * kind + 2
                        own[a] = 2 * kind + 1
                    for s in starts:
                        chars.append(codes[s : s + WIDTH].tobytes())
                        tags.append(own[s : s + WIDTH].tobytes())
                        keys.append(hashlib.blake2b(text[s : s + WIDTH].encode(), digest_size=8).digest())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (keys, chars, tags)], ["key", "chars", "tags"])

    rows = map_arrow(docs.select(id_col, text_col), cut, "key binary, chars binary, tags binary").distinct().orderBy("key", "chars", "tags").limit(limit).collect()
    as_rows = lambda name: np.frombuffer(b"".join(bytes(r[name]) for r in rows), np.uint8).reshape(len(rows), WIDTH).astype(np.int64)
    return as_rows("chars"), as_rows("tags")


def train(docs: DataFrame, limit: int = SAMPLE_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray]:
    tagger = Tagger()
    tagger.fit(*training_windows(docs, limit, id_col, text_col))
    return tagger.small()


def personal_data(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every text, with spans as (start, end, kind), sorted by start, then kind.

    Spans of the network that overlap an exact one of the same kind only repeat it and are left out.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger.of(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for i in range(0, len(texts), 512):
                part = texts[i : i + 512]
                for text, more in zip(part, tagger.spans(part)):
                    sure = exact(text) if _TRIGGER.search(text) else []
                    rows.append(_joined(sure, more))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return map_arrow(docs.select(id_col, text_col), run, f"doc_id {dict(docs.dtypes)[id_col]}, spans array<struct<start:int,end:int,kind:string>>")


def _joined(sure: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[dict]:
    covered: dict[int, list[tuple[int, int]]] = {}
    for a, k, b in sure:
        covered.setdefault(k, []).append((a, b))
    out = [(a, k, b, KINDS[k]) for a, k, b in sure]
    at = dict.fromkeys(covered, 0)
    for a, k, b in more:  # both sides are sorted, and spans of a kind do not overlap
        own = covered.get(k, [])
        while own and at[k] < len(own) and own[at[k]][1] <= a:
            at[k] += 1
        if not (own and at[k] < len(own) and own[at[k]][0] < b):
            out.append((a, len(KINDS) + k, b, f"seq_{KINDS[k]}"))
    return [{"start": a, "end": b, "kind": name} for a, _, b, name in sorted(out)]


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``personal_data``."""
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) as n_{k}") for k in KINDS]
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> not startswith(s.kind, 'seq_'))"
    return found.select("doc_id", *counts, F.expr(f"sha2({text.format(base)}, 256)").alias("base_sha256"), F.expr(text.format("spans")).alias("spans"))
