"""Repairs the structure of conversations with the cheapest edits.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Its turns, in order, are repaired by
keeping a row (cost 0), giving it the role user or assistant (2), deleting it (3) or inserting a user or assistant turn
without text (2). Rows that are blank (no character but white space) or repeat the role and text of an earlier row must
go; a row that ends in no ``.``, ``!`` or ``?`` costs 1 more if it stays. ``searched`` finds the cheapest edits.

**Search.** The edit lattice has a node for each number of rows done and each state of the pattern. Two searches by
cost, one from the start and one back from the ends, each with a heap, go on until their heaps cannot hold a part of a
cheapest path any more; then every edge where a settled node of the one meets a settled node of the other at the least
total is a crossing. Of all paths through crossings the one whose audit, the initials of its edits, is the least in
ASCII is read off from the front: a set of nodes that share the audit so far takes the least letter together. Equally
cheap ways to one node never continue each other (what they have more would be insertions, which cost), so the least
audit is that of the least front and the least back.

**Large conversations.** Rows are sorted in ranges and cut into segments of at most ``SEGMENT`` rows, each searched by
itself: a conversation in one segment from its start to its ends, another one between every two states. Segments of a
conversation are then joined two by two, cheapest and then least first. What is held there is the audits, which are one
value of the result each. The rows themselves are never collected; ``repaired`` has them as rows again, and a digest reads
them one after the other.

Rows of a conversation stand by turn (null first), then role, then a hash of the text, so that equal rows are
neighbours. Null roles and texts count as one blank, and so do a null id and turn in the checksum that ``damaged`` takes;
rows without an id are one conversation. Rows that stand there several times are duplicates of their first. Other columns are
left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landcarbon.llm.common import WHITE, map_arrow, staged

SEGMENT = 4096
CHANGE, DELETE, INSERT, CUT = 2, 3, 2, 1  # costs; CUT for a truncated row that stays
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
_STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# Codes of rows: "x" must go; otherwise the initial, as a capital if the row is truncated ("o" for other roles).
_AWAY = "x"

Edge = tuple[int, str, int]  # state after it, letter, cost


def _row_edges(code: str, state: int) -> list[Edge]:
    """Edges over a row from a state to the states after it."""
    out = [(state, "D", DELETE)]
    if code != _AWAY:
        more, initial = (CUT if code.isupper() else 0), code.lower()
        for role in "sua":
            if (state, role) in _STEP:
                if role == initial:
                    out.append((_STEP[state, role], "K", more))
                elif role != "s":
                    out.append((_STEP[state, role], "R", CHANGE + more))
    return out


_FORTH = {(c, q): _row_edges(c, q) for c in "xsuaoSUAO" for q in range(4)}
_BACK = {(c, q): [(p, letter, w) for p in range(4) for r, letter, w in _FORTH[c, p] if r == q] for c in "xsuaoSUAO" for q in range(4)}
_ADD = {q: [(r, "I", INSERT) for (p, role), r in _STEP.items() if p == q and role != "s"] for q in range(4)}
_ADDED = {q: [(p, "I", INSERT) for p in range(4) for r, _, _ in _ADD[p] if r == q] for q in range(4)}


class _Search:
    """One of the two searches: settled distances, and a heap of what to settle next."""

    def __init__(self, nodes: list[tuple[int, int]]):
        self.settled: dict[tuple[int, int], int] = {}
        self.best = dict.fromkeys(nodes, 0)
        self.heap = [(0, n) for n in nodes]
        heapq.heapify(self.heap)

    def top(self) -> int | None:
        while self.heap and self.heap[0][1] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> tuple[tuple[int, int], int]:
        cost, node = heapq.heappop(self.heap)
        self.settled[node] = cost
        return node, cost

    def reach(self, node: tuple[int, int], cost: int) -> None:
        if cost < self.best.get(node, cost + 1):
            self.best[node] = cost
            heapq.heappush(self.heap, (cost, node))


def _after(codes: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], str, int]]:
    i, q = node
    if i < len(codes):
        for r, letter, w in _FORTH[codes[i], q]:
            yield (i + 1, r), letter, w
    for r, letter, w in _ADD[q]:
        yield (i, r), letter, w


def _ahead_of(codes: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], str, int]]:
    i, q = node
    if i > 0:
        for p, letter, w in _BACK[codes[i - 1], q]:
            yield (i - 1, p), letter, w
    for p, letter, w in _ADDED[q]:
        yield (i, p), letter, w


def searched(codes: str, start: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of rows from one state to one of others, the audit being the least in ASCII."""
    n = len(codes)
    forth, back = _Search([(0, start)]), _Search([(n, q) for q in ends])
    least = None  # of the whole ways seen
    while (a := forth.top()) is not None and (b := back.top()) is not None and (least is None or a + b <= least):
        one, other, edges = (forth, back, _after) if a <= b else (back, forth, _ahead_of)
        node, cost = one.settle()
        if node in other.best and (least is None or cost + other.best[node] < least):
            least = cost + other.best[node]
        for to, _, w in edges(codes, node):
            one.reach(to, cost + w)
            if to in other.best and (least is None or cost + w + other.best[to] < least):
                least = cost + w + other.best[to]
    if least is None:
        return None

    # Crossings, and the settled nodes from which tight edges lead to one.
    goals = {(n, q) for q in ends}
    remains = back.settled | dict.fromkeys(goals, 0)
    leads = set()
    for node, cost in forth.settled.items():
        if remains.get(node) == least - cost or any(remains.get(to) == least - cost - w for to, _, w in _after(codes, node)):
            leads.add(node)
    stack = list(leads)
    while stack:
        node = stack.pop()
        for to, _, w in _ahead_of(codes, node):
            if to not in leads and to in forth.settled and forth.settled[to] + w == forth.settled[node]:
                leads.add(to)
                stack.append(to)

    def left(node: tuple[int, int]) -> int | None:
        """What remains to be paid from a node of a cheapest path; None for others."""
        return least - forth.settled[node] if node in leads else remains.get(node)

    audit, paid, front = [], 0, {(0, start)}
    while not (paid == least and front & goals):
        moves = [(letter, to, w) for node in front for to, letter, w in _after(codes, node) if left(to) == least - paid - w]
        letter = min(m[0] for m in moves)
        audit.append(letter)
        # The letters so far settle what was paid, so it is the same for all nodes of the front.
        paid += next(w for given, _, w in moves if given == letter)
        front = {to for given, to, _ in moves if given == letter}
    return least, "".join(audit)


def followed(codes: str, audit: str, state: int = START) -> tuple[list[tuple[list[str], str | None, bool]], list[str], int]:
    """What an audit does: per row the roles inserted before it, its new role if it has one, and whether it stays; the
    roles inserted at the end; and the state after it."""
    out, added, at = [], [], 0
    for letter in audit:
        # A changed or inserted turn can have one role only.
        role = "a" if state == USER else "u"
        if letter == "I":
            added.append("user" if role == "u" else "assistant")
            state = _STEP[state, role]
            continue
        code = codes[at].lower()
        at += 1
        if letter != "D":
            state = _STEP[state, role if letter == "R" else code]
        out.append((added, ("user" if role == "u" else "assistant") if letter == "R" else None, letter != "D"))
        added = []
    return out, added, state


def _joined(left: dict, right: dict) -> dict:
    """The cheapest and then least way through two neighbouring stretches, from each state to each; with the lengths of its parts."""
    out = {}
    for (p, m), (cost, audit, sizes) in left.items():
        for (m2, q), (cost2, audit2, sizes2) in right.items():
            if m == m2:
                way = (cost + cost2, audit + audit2, sizes + sizes2)
                if (p, q) not in out or way[:2] < out[p, q][:2]:
                    out[p, q] = way
    return out


def damaged(talks: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by a checksum of id and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = talks.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20).alias("_by"))
    text = F.when(F.col("_by") == 1, F.lit("")).when(F.col("_by") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_by") == 4, F.lit("user")).otherwise(F.col("role"))
    rows = rows.filter("_by != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "_by")
    return rows.withColumn("_copy", F.explode(F.expr("sequence(1, if(_by = 3, 2, 1))"))).drop("_by", "_copy")


def placed(talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in order, with a number ``seq`` that grows with conversation and turn, and (seq, conv_id, turn, initial, fault, code)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = talks.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text")).withColumn("_hash", F.md5("text"))
    parts = max(8, int(talks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "_hash")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = staged(rows.withColumn("seq", F.monotonically_increasing_id()))

    first = rows.groupBy("conv_id", "role", "_hash").agg(F.min("seq").alias("first")).select(F.col("first").alias("seq"), F.lit(True).alias("_first"))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("o"))
    has_text = F.col("text").rlike(f"[^{WHITE}]")
    ended = F.col("text").rlike(f"[.!?][{WHITE}]*\\z")
    marked = rows.select("seq", "conv_id", "turn", initial.alias("initial"), has_text.alias("_has"), ended.alias("_ended")).join(first.hint("shuffle_merge"), "seq", "left")
    fault = F.when(~F.col("_has"), "blank").when(F.col("_first").isNull(), "duplicate").when(~F.col("_ended"), "truncated")
    marked = marked.select("seq", "conv_id", "turn", "initial", fault.alias("fault"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(_AWAY)).when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return rows.drop("_hash"), staged(marked.withColumn("code", code))


def segments(marked: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Per conversation and stretch of rows (conv_id, seg, first_seq, codes, initials, next, opens, closes)."""
    rows = marked.withColumn("seg", F.expr(f"seq div {size}")).groupBy("conv_id", "seg")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("seq", "code", "initial"))).alias("r"))
    joined = lambda c: F.array_join(F.transform("r", lambda x: x[c]), "").alias(f"{c}s")
    cut = rows.select("conv_id", "seg", F.col("r")[0]["seq"].alias("first_seq"), joined("code"), joined("initial"))
    of = Window.partitionBy("conv_id").orderBy("seg")
    follows = F.lead(F.substring("initials", 1, 1)).over(of).alias("next")
    cut = cut.select("*", follows, F.lag("seg").over(of).isNull().alias("opens"), F.lead("seg").over(of).isNull().alias("closes"))
    # The segments of one conversation are searched by different tasks.
    return cut.repartition("seg")


_WAYS = "array<struct<p: int, q: int, cost: bigint, audit: string>>"


def repairs(marked: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, seg, first_seq, codes, illegal, state, audit, cost) of every segment, staged: its part of the conversation's
    audit and the state before it. ``cost`` is that of the conversation, on its first segment."""
    cut = segments(marked, size)
    kind = dict(cut.dtypes)["conv_id"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            illegal, found = [], []
            for codes, initials, follows, opens, closes in zip(*(batch.column(i).to_pylist() for i in range(3, 8))):
                whole = initials + (follows or "")
                illegal.append(sum(whole[i : i + 2] not in ("su", "ua", "au") for i in range(len(whole) - 1)))
                goals = [(-1, ENDS)] if closes else [(q, (q,)) for q in range(4)]
                ways = [(p, q, searched(codes, p, ends)) for p in ((START,) if opens else range(4)) for q, ends in goals]
                found.append([{"p": p, "q": q, "cost": w[0], "audit": w[1]} for p, q, w in ways if w])
            kinds = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
            arrays = [*(batch.column(i) for i in range(4)), pa.array(illegal, pa.int64()), batch.column(6), batch.column(7), pa.array(found, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "seg", "first_seq", "codes", "illegal", "opens", "closes", "ways"])

    schema = f"conv_id {kind}, seg long, first_seq long, codes string, illegal long, opens boolean, closes boolean, ways {_WAYS}"
    found = staged(map_arrow(cut, search, schema))
    columns = ["conv_id", "seg", "first_seq", "codes", "illegal"]
    alone = found.filter("opens and closes").select(*columns, F.lit(START).alias("state"), F.expr("ways[0].audit as audit"), F.expr("ways[0].cost as cost"))

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("seg")
        parts = [{(w["p"], w["q"]): (w["cost"], w["audit"], [len(w["audit"])]) for w in ways} for ways in table["ways"].to_pylist()]
        while len(parts) > 1:
            parts = [_joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        cost, audit, sizes = parts[0][START, -1]
        at, state, states, audits = 0, START, [], []
        for codes, n in zip(table["codes"].to_pylist(), sizes):
            states.append(state)
            audits.append(audit[at : at + n])
            state = followed(codes, audits[-1], state)[2]
            at += n
        costs = [cost] + [0] * (len(sizes) - 1)
        return table.select(columns).append_column("state", pa.array(states, pa.int32())).append_column("audit", pa.array(audits, pa.string())).append_column("cost", pa.array(costs, pa.int64()))

    many = found.filter("not (opens and closes)").select(*columns, "ways").groupBy("conv_id")
    many = many.applyInArrow(join, f"conv_id {kind}, seg long, first_seq long, codes string, illegal long, state int, audit string, cost long")
    return staged(alone.unionByName(many))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, seq, line, role, text): the repaired turns, in order of seq and line."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, roles, stays, befores, afters = [], [], [], [], []
            for first, codes, state, audit in zip(*(batch.column(i).to_pylist() for i in range(4))):
                done, added, _ = followed(codes, audit, state)
                for i, (before, role, stay) in enumerate(done):
                    after = added if i == len(done) - 1 else []
                    if stay or before or after:
                        for out, v in zip((seqs, roles, stays, befores, afters), (first + i, role, stay, before, after)):
                            out.append(v)
            lists = pa.list_(pa.string())
            arrays = [pa.array(seqs, pa.int64()), pa.array(roles, pa.string()), pa.array(stays, pa.bool_()), pa.array(befores, lists), pa.array(afters, lists)]
            yield pa.RecordBatch.from_arrays(arrays, ["seq", "new_role", "stays", "before", "after"])

    schema = "seq long, new_role string, stays boolean, before array<string>, after array<string>"
    by_row = map_arrow(edits.select("first_seq", "codes", "state", "audit"), follow, schema)
    turn = "struct({} as role, {} as text)"
    empty = f"transform({{}}, x -> {turn.format('x', chr(39) * 2)})"
    own = f"if(stays, array({turn.format('coalesce(new_role, role)', 'text')}), array())"
    lines = F.expr(f"concat({empty.format('before')}, {own}, {empty.format('after')})")
    both = rows.select("seq", "conv_id", "role", "text").join(by_row.hint("shuffle_merge"), "seq")
    return both.select("conv_id", "seq", F.posexplode(lines).alias("line", "_turn")).select("conv_id", "seq", "line", "_turn.role", "_turn.text")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows. A conversation is read in order, turn by turn, and never held."""
    line = F.concat("role", F.lit(":"), "text")
    ordered = turns.select("conv_id", "seq", "line", line.alias("_text")).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            ids, sums = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or key != now:
                    if digest is not None:
                        ids.append(now)
                        sums.append(digest.hexdigest())
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(sums, pa.string())], ["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([digest.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    return map_arrow(ordered.select("conv_id", "_text"), run, f"conv_id {dict(turns.dtypes)['conv_id']}, repaired_sha256 string")


def report(talks: DataFrame, rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every id of ``talks``, for its
    rows in ``rows``; without any, zeros, an empty audit and the hash of an empty text."""
    rows, marked = placed(rows)
    edits = repairs(marked, size)
    faults = marked.groupBy("conv_id").agg(*(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    turns = marked.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("_one"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    audits = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "")
    whole = edits.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audits.alias("audit"))
    out = talks.select("conv_id").distinct()
    for k, part in enumerate((gaps, faults, whole, digests(repaired(rows, edits)))):
        part = part.withColumnRenamed("conv_id", f"_id{k}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"_id{k}")), "left").drop(f"_id{k}")
    number = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *number, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
