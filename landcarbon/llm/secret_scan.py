"""Secret scans with multipart credential linking, in built-in functions only.

Strong spans (assigned secrets, access keys, long hex strings) are reported as they are. Weak parts are an access
identifier, a secret or an endpoint that means little alone. They are linked by an interval join within a scope: the
parts of a text are sorted once, and a forward and a backward sweep carry the nearest identifier, secret and endpoint,
so a part meets its complements without pairing up with each of them. A weak part is reported only where they occur:
a weak secret beside an identifier or an endpoint, a weak identifier beside a secret, an endpoint beside both. Parts that
overlap do not complete each other, so an identifier whose value looks like a secret is not its own secret.

Everything of a row is in its text, so nothing is shuffled. Positions are code points, end exclusive. A null text
counts as empty, repeated rows are scanned one by one, other columns stay out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.llm.common import WHITE, fresh

SCOPE = 200  # code points between two parts that belong together
_SET = r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"

# (kind, role, pattern, what the text must contain). The first three patterns.
ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){_SET}([A-Za-z0-9+/_.=-]+)"
KINDS = (
    ("assign", "secret", ASSIGN, "=:"),
    ("access", "id", r"AKIA[A-Z0-9]{14,}", "A"),
    ("hex", "secret", r"[0-9a-f]{16,}", ""),
    ("weak_id", "id", rf"(?i:access_?key_?id|access_?key|client_?id|user_?name|user_?id|user|login|account){_SET}[A-Za-z0-9._@-]{{3,}}", "=:"),
    ("weak_secret", "secret", rf"(?i:passphrase|passcode|pass|pwd|credential|private_?key|signature|auth){_SET}[A-Za-z0-9+/_.=-]{{8,}}", "=:"),
    ("endpoint", "endpoint", rf"(?i:https?|jdbc:[a-z]+|postgresql|postgres|mysql|mongodb|redis|amqp|ftp|s3)://[^{WHITE}\x22\x27<>]{{3,}}", "=:"),
)
NAMES = [k[0] for k in KINDS]
STRONG = 3  # the first kinds
_GATES = {"=:": "(contains(txt, '=') or contains(txt, ':'))", "A": "contains(txt, 'AKIA')", "": "true"}
_BLOCK = 256


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def scan(array: str, start: str, out_type: str, step: str, item: str) -> str:
    """Running values along an array: ``step`` gives the next state and ``item`` the output, from ``acc`` and ``x``.

    Outputs are appended block by block, so that the cost of copying stays far from quadratic.
    """
    empty = f"cast(array() as array<{out_type}>)"
    inner = f"aggregate(block, named_struct('acc', outer.acc, 'out', {empty}), (inner, x) -> {let('acc', 'inner.acc', f'''named_struct('acc', {step}, 'out', concat(inner.out, array({item})))''')})"
    blocks = f"transform(sequence(0, greatest(size(arr) - 1, 0) div {_BLOCK}), b -> slice(arr, b * {_BLOCK} + 1, {_BLOCK}))"
    whole = (
        f"aggregate({blocks}, named_struct('acc', {start}, 'out', cast(array() as array<array<{out_type}>>)), "
        f"(outer, block) -> {let('r', inner, '''named_struct('acc', r.acc, 'out', concat(outer.out, array(r.out)))''')}, outer -> flatten(outer.out))"
    )
    return let("arr", array, whole)


def found(pattern: str, rank: int) -> str:
    """Leftmost non-overlapping matches of a pattern as (start, rank, end, match)."""
    steps = f"zip_with(slice(split(txt, r'{pattern}', -1), 1, size(ms)), ms, (p, m) -> named_struct('g', length(p), 'n', length(m), 'm', m))"
    spans = scan(
        steps,
        "0",
        "struct<start:int,rank:int,end:int,m:string>",
        "acc + x.g + x.n",
        f"named_struct('start', acc + x.g, 'rank', {rank}, 'end', acc + x.g + x.n, 'm', x.m)",
    )
    return let("ms", f"regexp_extract_all(txt, r'{pattern}', 0)", spans)


def parts() -> str:
    """All strong and weak parts of ``txt``, sorted by start, then kind."""
    each = []
    for rank, (name, _, pattern, gate) in enumerate(KINDS):
        spans = found(pattern, rank)
        if name == "assign":
            spans = f"filter({spans}, s -> length(regexp_extract(s.m, r'{pattern}', 1)) >= 12)"
        spans = f"transform({spans}, s -> named_struct('start', s.start, 'rank', s.rank, 'end', s.end))"
        each.append(f"if({_GATES[gate]} and txt rlike r'{pattern}', {spans}, cast(array() as array<struct<start:int,rank:int,end:int>>))")
    return f"sort_array(concat({', '.join(each)}))"


def _is(role: str, x: str = "x") -> str:
    return f"{x}.rank in ({', '.join(str(i) for i, k in enumerate(KINDS) if k[1] == role)})"


def _swept(at: str, until: str, scope: int) -> str:
    """The parts, each with the roles that lie within ``scope`` before it without overlapping it, along one direction.

    Every part is noted at ``until``, its far end, and looked at when the sweep reaches ``at``, its near end.
    """
    roles = ("id", "secret", "endpoint")
    event = "transform(ps, p -> named_struct('pos', cast({} as bigint), 'look', {}, 'start', p.start, 'rank', p.rank, 'end', p.end))"
    state = "named_struct(" + ", ".join(f"'{r}', {{}}" for r in roles) + ")"
    seen = state.format(*(f"if(x.look = 0 and {_is(r)}, x.pos, acc.{r})" for r in roles))
    near = ", ".join(f"'{r}', x.pos - acc.{r} <= {scope}" for r in roles)
    out = "struct<start:int,rank:int,end:int,look:int,id:boolean,secret:boolean,endpoint:boolean>"
    item = f"named_struct('start', x.start, 'rank', x.rank, 'end', x.end, 'look', x.look, {near})"
    events = f"sort_array(concat({event.format(until, 0)}, {event.format(at, 1)}))"
    return f"sort_array(filter({scan(events, state.format(*[f'{-(1 << 40)}L'] * 3), out, seen, item)}, s -> s.look = 1))"


def linked(scope: int) -> str:
    """The parts to report, from ``parts``: strong ones, and weak ones beside complements that they do not overlap."""
    before, after = _swept("p.start", "p.end", scope), _swept("-p.end", "-p.start", scope)
    has = {r: f"(s.b.{r} or s.a.{r})" for r in ("id", "secret", "endpoint")}
    weak = {"weak_id": has["secret"], "weak_secret": f"({has['id']} or {has['endpoint']})", "endpoint": f"({has['id']} and {has['secret']})"}
    reported = " or ".join([f"s.b.rank < {STRONG}", *(f"s.b.rank = {NAMES.index(k)} and {v}" for k, v in weak.items())])
    both = f"zip_with({before}, {after}, (b, a) -> named_struct('b', b, 'a', a))"
    return f"transform(filter({both}, s -> {reported}), s -> named_struct('start', s.b.start, 'rank', s.b.rank, 'end', s.b.end))"


def with_spans(df: DataFrame, text_col: str = "text", out: str = "_spans", scope: int = SCOPE) -> DataFrame:
    """Add the reported spans as an array of (start, rank, end), sorted; ``NAMES`` has the kind of each rank."""
    few = f"if(exists(ps, s -> s.rank >= {STRONG}), {linked(scope)}, ps)"
    text = f"coalesce(`{text_col}`, '')"
    return df.withColumn(out, F.expr(let("txt", text, let("ps", parts(), few))))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = ", ".join(f"'{n}'" for n in NAMES)
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', get(array({names}), s.rank), s.start, s.end)), ',')")


def secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans) of every text."""
    spans = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("txt_")), "txt_", "found", scope)
    counts = [F.expr(f"cast(size(filter(found, s -> s.rank = {i})) as long) as n_{NAMES[i]}") for i in range(STRONG)]
    linked_count = F.expr(f"cast(size(filter(found, s -> s.rank >= {STRONG})) as long) as n_linked")
    base = joined(f"filter(found, s -> s.rank < {STRONG})")
    return spans.select("doc_id", *counts, linked_count, F.sha2(base, 256).alias("base_sha256"), joined("found").alias("spans"))


def redacted(docs: DataFrame, mark: str = "<secret>", scope: int = SCOPE, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """Documents with every reported span replaced by ``mark``, in the columns of ``docs``."""
    found = fresh("_spans", docs)
    spans = with_spans(docs, text_col, found, scope)
    piece = f"concat(substring(txt, acc + 1, greatest(0, x.start - acc)), if(x.start >= acc, '{mark}', ''))"
    cut = scan("sp", "0", "string", "greatest(acc, x.end)", piece)
    rest = "substring(txt, array_max(transform(sp, s -> s.end)) + 1)"
    text = let("txt", f"`{text_col}`", let("sp", found, f"concat(array_join({cut}, ''), {rest})"))
    new = spans.withColumn(text_col, F.expr(f"if(size({found}) = 0, `{text_col}`, {text})"))
    if length_col in docs.columns:
        new = new.withColumn(length_col, F.expr(f"if(size({found}) = 0, `{length_col}`, length(`{text_col}`))"))
    return new.select(*docs.columns)
