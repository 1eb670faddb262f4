"""Near-duplicates by order MinHash, verified by banded alignment.

The k-mers of a text are its runs of five words, each labelled with how often it has occurred before. A sketch takes
the ``TAKE`` labelled k-mers with the smallest hashes and keeps them in text order, so it is the same for two texts only
if they share these k-mers in the same order: it follows edit similarity, where plain MinHash is blind to order. Two
texts that share the share J of their k-mers have the same sketch with a chance of about J to the power of ``TAKE``;
with 24 sketches, at J = 0.8 they miss all with a chance of 3 in a million.

Equal texts (by their words) are one node. Nodes with an equal sketch are a bucket; its smallest node is aligned with
each other one, so a bucket of n gives n - 1 pairs. Buckets in which an alignment fails are looked through once more,
each with a node of its own in the middle, which a hash picks. The nodes of buckets that are not one component by then
are joined exactly: two texts with a share of 0.8 or more have one of their rarest k-mers in common (prefix filter), so
nodes with such a k-mer meet, first the smallest one with the others, then every two that are in different components.
A pair holds if at most a fifth of the longer text's words must be inserted, deleted or replaced. Classes are the
connected components of these pairs.

A text of fewer than five words is one k-mer; texts without words, null among them, are copies of each other. A node
is a 64-bit fingerprint. Rows that repeat an id are one document if their texts are equal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import fresh, map_arrow, staged, word_list
from landcarbon.operators.dissolve import connected_components

WORDS = 5
TAKE = 4
SKETCHES = 24
SIMILARITY = 0.8
SLOTS = 20  # bits of the slots in which occurrences of k-mers are counted
_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _B
    return x ^ x >> np.uint64(29)


def kmers(words: np.ndarray) -> np.ndarray:
    """Occurrence-labelled k-mers of word hashes, in text order."""
    n = max(len(words) - WORDS + 1, 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(WORDS, len(words))):
        h = _mix(h * _A + words[j : j + n])
    order = np.argsort(h, kind="stable")
    first = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    starts = np.flatnonzero(first)
    label = np.empty(n, np.uint64)
    label[order] = (np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))).astype(np.uint64)
    return _mix(h + label * _A)


def sketches(labelled: np.ndarray, seeds: np.ndarray = _SEEDS, take: int = TAKE) -> np.ndarray:
    """One hash per sketch: of the smallest k-mers under its order, in text order."""
    n, take = len(labelled), min(take, len(labelled))
    out = np.empty(len(seeds), np.uint64)
    rows = max(1, (1 << 20) // n)
    for at in range(0, len(seeds), rows):
        own = labelled * seeds[at : at + rows, None]
        own ^= own >> np.uint64(31)
        low = np.sort(np.argpartition(own, take - 1, axis=1)[:, :take], axis=1)
        h = np.arange(at, at + len(own), dtype=np.uint64)
        for j in range(take):
            h = _mix(h * _A + labelled[low[:, j]])
        out[at : at + rows] = h
    return out


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, keys, codes) of every text; ``codes`` has one character per word.

    A task gives keys and codes once per node, as copies need none of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        seen: set[int] = set()
        for batch in batches:
            nodes, keys, codes = [], [], []
            for text in batch.column(1).to_pylist():
                words = word_list(text)
                node = xxh3_64_intdigest(b" ".join(words))
                nodes.append(node)
                if node in seen:
                    keys.append(None)
                    codes.append(None)
                    continue
                seen.add(node)
                h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
                keys.append(sketches(kmers(h)).view(np.int64))
                # The planes from 1 to 15, in which every number is a character.
                codes.append(((h >> np.uint64(20)) % np.uint64(0xF0000) + np.uint64(0x10000)).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"))
            arrays = [batch.column(0), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(codes, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "keys", "codes"])

    return map_arrow(docs.select(id_col, text_col), run, f"doc_id {dict(docs.dtypes)[id_col]}, node long, keys array<long>, codes string")


def _stars(members: DataFrame, any_node: bool = False) -> DataFrame:
    """(key, a, b): the middle of each bucket with each other node of it."""
    pick = F.min_by("node", F.xxhash64("node", "key")) if any_node else F.min("node")
    middle = members.groupBy("key").agg(pick.alias("a"), F.count(F.lit(1)).alias("n"))
    return members.withColumnRenamed("node", "b").join(middle.filter("n > 1").drop("n"), "key").filter("a != b")


def aligned(pairs: DataFrame, codes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, near) of distinct pairs, by a banded alignment of their words.

    Bands grow from narrow to what the similarity allows, so that near copies cost little.
    """
    of = lambda side: codes.select(F.col("node").alias(side), F.col("codes").alias(f"codes_{side}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    # The share of a fifth is a little less in binary, so whole limits would be missed by one.
    both = both.withColumn("limit", F.floor(F.greatest(F.length("codes_a"), F.length("codes_b")) * (1 - similarity) + 1e-9).cast("int"))
    # A word that stands on one side only costs an edit, so too many of them rule a pair out.
    lone = "size(array_except(split(codes_{}, ''), split(codes_{}, ''))) > limit"
    near = F.expr(
        "case when abs(length(codes_a) - length(codes_b)) > limit then false "
        "when levenshtein(codes_a, codes_b, least(16, limit)) >= 0 then true "
        f"when limit <= 16 or {lone.format('a', 'b')} or {lone.format('b', 'a')} then false "
        "when levenshtein(codes_a, codes_b, least(128, limit)) >= 0 then true "
        "when limit <= 128 then false else levenshtein(codes_a, codes_b, limit) >= 0 end"
    )
    return both.select("a", "b", near.alias("near"))


def linked(sk: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of the nodes that some pair holds of, from staged ``sketched`` rows."""
    members = staged(sk.filter("keys is not null").select("node", F.explode("keys").alias("key")).distinct())
    stars = staged(_stars(members))
    first = stars.select("a", "b").distinct()
    tested = staged(aligned(first, _codes(sk, _ends(first)), similarity))

    # Buckets with a pair that fails, once more around other nodes.
    failed = stars.join(tested.filter("not near").select("a", "b"), ["a", "b"], "left_semi").select("key").distinct()
    unlike = staged(members.join(failed, "key", "left_semi"))
    second = _stars(unlike, any_node=True).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = staged(second.join(tested.select("a", "b"), ["a", "b"], "left_anti"))
    tested = tested.unionByName(staged(aligned(second, _codes(sk, _ends(second)), similarity)))
    found = connected_components(tested.filter("near").select("a", "b"))
    return _resolved(sk, unlike, tested, found, similarity)


def _resolved(sk: DataFrame, unlike: DataFrame, tested: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Components after the exact join of the nodes in buckets that are not yet one component."""
    unlike = unlike.join(found, "node", "left").selectExpr("key", "node", "coalesce(component, node) as component")
    mixed = unlike.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    rest = staged(unlike.join(mixed, "key", "left_semi").select("node", "component").distinct())
    if rest.isEmpty():
        return found
    codes = _codes(sk, rest.select("node"))
    often = _frequencies(codes)
    # The component travels on one row per node; the many rows of the prefixes are joined with nothing by node.
    of = staged(prefixes(codes.join(rest, "node"), often, similarity))
    groups = _groups(of).select("key", F.col("first").alias("l"))
    stars = of.withColumn("r", F.struct("node", "component", "n", "at")).select("key", "r").join(groups, "key")
    third = staged(_possible(stars, tested, similarity))
    more = staged(aligned(third, codes, similarity))
    now = staged(_merged(rest, more))

    # What is left: every two nodes of different components.
    each = staged(prefixes(codes.join(now.select("node", "component"), "node"), often, similarity))
    each = staged(each.join(_groups(each).select("key"), "key", "left_semi").select("key", F.struct("node", "component", "n", "at").alias("l")))
    pairs = each.join(each.withColumnRenamed("l", "r"), "key").filter("l.node < r.node")
    fourth = staged(_possible(pairs, tested.unionByName(more), similarity))
    more = more.unionByName(staged(aligned(fourth, codes, similarity)))
    last = staged(_merged(rest, more).groupBy("before").agg(F.min("component").alias("last")))
    whole = found.unionByName(rest.join(found, "node", "left_anti"))
    return whole.join(last, whole.component == last.before, "left").selectExpr("node", "coalesce(last, component) as component")


def _groups(of: DataFrame) -> DataFrame:
    """(key, first): k-mers whose nodes are of several components, one k-mer for each set of nodes, with its smallest node.

    A passage that texts share has many k-mers with the same nodes. Of those the first in the order of rarity stands for
    all: where it is the first that two nodes share, their places in the order say the most.
    """
    first = F.min(F.struct("node", "component", "n", "at")).alias("first")
    marks = [F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor")]
    groups = of.groupBy("key").agg(first, F.count(F.lit(1)).alias("size"), *marks, F.min("component").alias("lo"), F.max("component").alias("hi"))
    groups = groups.filter("lo != hi")
    one = groups.groupBy("size", "sum", "xor").agg(F.min_by(F.struct("key", "first"), F.struct("first.at", "key")).alias("g"))
    return staged(one.select("g.key", "g.first"))


def _merged(rest: DataFrame, tested: DataFrame) -> DataFrame:
    """(node, before, component): components of ``rest`` joined by pairs that are near."""
    of = lambda side: rest.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    near = tested.filter("near").join(of("a"), "a").join(of("b"), "b")
    by = connected_components(near.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct())
    by = by.withColumnsRenamed({"node": "before", "component": "after"})
    return rest.withColumnRenamed("component", "before").join(by, "before", "left").selectExpr("node", "before", "coalesce(after, before) as component")


def _possible(pairs: DataFrame, tested: DataFrame, similarity: float) -> DataFrame:
    """Distinct untested (a, b) of different components that can share enough k-mers, by their numbers and places in the order."""
    least, share = similarity - 1e-9, similarity / (1 + similarity) - 1e-9
    able = f"l.component != r.component and least(l.n, r.n) >= {least} * greatest(l.n, r.n) and least(l.n - l.at, r.n - r.at) >= {share} * (l.n + r.n)"
    new = pairs.filter(able).selectExpr("least(l.node, r.node) as a", "greatest(l.node, r.node) as b").distinct()
    return new.join(tested.select("a", "b"), ["a", "b"], "left_anti")


_PARTS, _OWN = 64, 1 << SLOTS - 6


def _labelled(codes: str) -> np.ndarray:
    return kmers(np.frombuffer(codes.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64))


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SLOTS)).astype(np.int64)


def _frequencies(codes: DataFrame):
    """How often k-mers occur, counted in a fixed number of slots; a broadcast of 4 MB."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(_PARTS * _OWN, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(n, _slot(_labelled(text)), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array([c.tobytes() for c in n.reshape(_PARTS, _OWN)], pa.binary())], ["part", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(n, np.int64) for n in table["n"].to_pylist()], axis=0)
        return pa.table({"part": table["part"][:1], "n": pa.array([np.minimum(total, 2**31 - 1).astype("<i4").tobytes()], pa.binary())})

    counted = map_arrow(codes.select("codes"), count, "part int, n binary").groupBy("part").applyInArrow(add, "part int, n binary")
    of_part = {r.part: bytes(r.n) for r in counted.collect()}
    return codes.sparkSession.sparkContext.broadcast(b"".join(of_part.get(p, bytes(4 * _OWN)) for p in range(_PARTS)))


def prefixes(nodes: DataFrame, often, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component, key, n, at): the rarest of a node's n k-mers and their places in the order of rarity.

    Two nodes with enough k-mers in common share one of these under any order that is the same for all nodes, so it is
    enough to count occurrences in slots. K-mers that many texts share come last and are mostly left out.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.frombuffer(often.value, "<i4")
        for batch in batches:
            keys, sizes = [np.zeros(0, np.uint64)], []
            for text in batch.column(2).to_pylist():
                k = _labelled(text)
                first = len(k) - math.ceil(similarity * len(k) - 1e-9) + 1
                keys.append(k[np.lexsort((k, times[_slot(k)]))[:first]])
                sizes.append((len(k), len(keys[-1])))
            of_text = [s for _, s in sizes]
            node, component = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), of_text) for i in (0, 1))
            n = np.repeat(np.array([s for s, _ in sizes], np.int32), of_text)
            at = np.concatenate([np.zeros(0, np.int32), *(np.arange(s, dtype=np.int32) for s in of_text)])
            arrays = [pa.array(node, pa.int64()), pa.array(component, pa.int64()), pa.array(np.concatenate(keys).view(np.int64)), pa.array(n, pa.int32()), pa.array(at, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "component", "key", "n", "at"])

    return map_arrow(nodes.select("node", "component", "codes"), pick, "node long, component long, key long, n int, at int")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _codes(sk: DataFrame, nodes: DataFrame) -> DataFrame:
    """Codes of some nodes, once per node."""
    own = sk.filter("codes is not null").select("node", "codes").join(nodes, "node", "left_semi")
    return staged(own.groupBy("node").agg(F.max("codes").alias("codes")))


def classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) of every row: the smallest id of its class, which is its own id where it has no duplicate."""
    sk = staged(sketched(docs, id_col, text_col))
    components = linked(sk, similarity)
    least = sk.groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = staged(least.join(components, "node", "left").selectExpr("node", "coalesce(component, node) as component", "least"))
    # As a table, so that both sides of the join are dealt out for it and a large class can be split.
    class_ids = staged(labelled.groupBy("component").agg(F.min("least").alias("class_id")))
    by_node = labelled.join(class_ids, "component").select("node", "class_id")
    return sk.select("doc_id", "node").join(by_node, "node").select("doc_id", "class_id")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, in the columns of ``docs``: the one with the smallest id."""
    found = staged(classes(docs, similarity, id_col, text_col))
    own, n = fresh("_kept", docs), fresh("_n", docs)
    kept = found.filter("doc_id <=> class_id").groupBy(F.col("doc_id").alias(own)).agg(F.count(F.lit(1)).alias(n))
    # Ids grow with the documents, so they are never broadcast, however few they are in a small run.
    stays = docs.join(kept.select(own).hint("shuffle_merge"), docs[id_col].eqNullSafe(F.col(own)), "left_semi")
    if kept.filter(F.col(n) > 1).isEmpty():
        return stays
    return stays.dropDuplicates([id_col, text_col])
