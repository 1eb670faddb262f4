"""Conversation repair, curriculum and spelling variants against brute force, with nulls, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from landcarbon.llm import conversation_repair, curriculum, spelling

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
TALK = "conv_id long, turn long, role string, text string"


def faulty(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if by == 1 else re.sub("[.!?]", "", text) if by == 2 else text
        out += [(c, t, "user" if by == 4 else role, text)] * (0 if by == 0 else 2 if by == 3 else 1)
    return out


def cheapest(rows):
    """All edits, row by row: the cheapest way to each state with its audit and lines."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        for _ in range(4):
            for q, (cost, audit, lines) in list(ways.items()):
                for role in ("user", "assistant"):
                    if (q, role[0]) in STEP:
                        put(ways, STEP[q, role[0]], (cost + 2, audit + "I", (*lines, f"{role}:")))
        return ways

    ways = inserted({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for q, (cost, audit, lines) in ways.items():
            put(after, q, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                for new, more, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (q, new[:1]) in STEP:
                        put(after, STEP[q, new[:1]], (cost + more + (fault == "truncated"), audit + letter, (*lines, f"{new}:{text}")))
        ways = inserted(after)
    cost, audit, lines = min((ways[q] for q in ("", "a") if q in ways), key=lambda w: w[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talk(r, n, of, ties):
    """Random rows: ``of`` to a conversation, or of few ids and turns with nulls and repeats."""
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    texts = ["Hi.", "a", "Yes!", "", "  ", "What? ", None, "x.\n", "ü", *(f"t{k}." for k in range(30))]
    place = lambda i: (r.choice([None, 1, 2, 3]), r.choice([None, *range(30)])) if ties else (i // of, i % of)
    return [(*place(i), r.choice(roles), r.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("n,of,ties,size", [(150, 6, True, 4096), (800, 6, False, 4096), (900, 300, False, 7), (300, 100, True, 16)])
def test_repair_is_the_cheapest_and_least(spark, n, of, ties, size):
    rows = talk(random.Random(n), n, of, ties)
    talks = spark.createDataFrame([(*x, "extra", 1) for x in rows], TALK + ", seq string, code int").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in conversation_repair.report(talks, conversation_repair.damaged(talks), size).collect()}
    by = defaultdict(list, {c: [] for c, *_ in rows})
    for x in faulty(rows):
        by[x[0]].append(x)
    assert got == {c: cheapest(own) for c, own in by.items()}


def test_repair_of_an_empty_table_and_of_very_long_turns(spark):
    none = spark.createDataFrame([], TALK)
    assert conversation_repair.report(none, none).count() == 0
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} " + "long text " * 50_000 + ".") for t in range(4)]
    talks = spark.createDataFrame([*rows, (2, None, None, None)], TALK)
    got = {r.conv_id: r for r in conversation_repair.report(talks, talks).collect()}
    assert (got[1].cost, got[1].audit) == (0, "KKKK") and (got[2].audit, got[2].blank) == ("D", 1)
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows).encode()).hexdigest()


def test_search_agrees_with_all_ways_between_states():
    r = random.Random(3)
    for _ in range(300):
        codes = "".join(r.choice("xsuaoSUAO") for _ in range(r.randint(0, 6)))
        for p in range(4):
            ways = {p: (0, "")}

            def better(ways, q, way):
                if q not in ways or way < ways[q]:
                    ways[q] = way

            def inserted(ways):
                for _ in range(4):
                    for q, (cost, audit) in list(ways.items()):
                        for to, letter, w in conversation_repair._ADD[q]:
                            better(ways, to, (cost + w, audit + letter))
                return ways

            ways = inserted(ways)
            for c in codes:
                after = {}
                for q, (cost, audit) in ways.items():
                    for to, letter, w in conversation_repair._row_edges(c, q):
                        better(after, to, (cost + w, audit + letter))
                ways = inserted(after)
            for q in range(4):
                assert conversation_repair.searched(codes, p, (q,)) == ways.get(q)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, row string, target int, size int").repartition(3)


@pytest.fixture(scope="module")
def pile(spark):
    """A source with a third of all documents, small ones, a null one, one without words, repeated rows."""
    r = random.Random(8)
    rows = []
    for i in range(900):
        source = "hot" if i < 300 else r.choice(["a", "b", "é", "z", None, "tiny" if i % 50 == 0 else "c"])
        n = r.choice([0, 1, 5, 20, 80]) if i % 100 else 3000
        rows.append((None if i % 90 == 0 else i, source, None if i % 70 == 0 else " ".join("w" * n), "own", 1, 2))
    rows += [(2000 + i, "empty", "", "own", 1, 2) for i in range(5)]
    return documents(spark, rows + rows[:4] + [(5, "hot", "one two", "own", 1, 2)])


def test_targets_and_taken_words(spark, pile):
    got = [r.asDict() for r in curriculum.report(pile).collect()]
    assert len(got) == pile.count()
    sizes = Counter()
    for r in pile.collect():
        sizes[r.source] += len((r.text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, open_ = {}, set(order)
    while True:  # share, cut off, share again
        rest = sum(sizes.values()) - sum(want.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * sizes[s]
            open_.remove(s)
    want |= share
    by_size = {sizes[s]: s for s in sizes}
    taken = Counter()
    for r in got:
        source = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(want[source]) and r["taken"] <= 3 * r["size"] and (r["taken"] == 0) == (r["first_start"] is None)
        taken[source] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(80, 0.01 * want[s])


def test_mixing_again_gives_the_same(pile):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(curriculum.report(pile).collect(), key=key) == sorted(curriculum.report(pile.repartition(7)).collect(), key=key)


def test_copies_follow_the_schedules(pile):
    copies, _, wanted = curriculum.mixed(pile)
    turn = {r.source: r.turn for r in wanted.collect()}
    rows = sorted(copies.collect(), key=lambda r: r.start)
    assert [r.time for r in rows] == sorted(r.time for r in rows) and 0 <= rows[0].time and rows[-1].time <= 1
    at = 0
    for r in rows:
        assert r.start == at
        at += r.size
    for source, k in turn.items():
        own, before = [r for r in rows if r.source == source], 0
        own.sort(key=lambda r: r.time)
        total = sum(r.size for r in own)
        points = curriculum.SCHEDULES[k % 3]

        def integral(t):
            parts = [(min(t, b) - a) * (u + u + (v - u) * (min(t, b) - a) / (b - a)) / 2 for (a, u), (b, v) in zip(points, points[1:]) if t > a]
            return sum(parts)

        for r in own:
            assert integral(r.time) / integral(1) == pytest.approx(before / total, abs=1e-9)
            before += r.size


def test_curriculum_limits(spark, pile):
    assert curriculum.report(pile.limit(0)).count() == 0
    alone = curriculum.report(documents(spark, [(1, "a", "", "x", 1, 2), (2, "a", None, "x", 1, 2)])).collect()
    assert [(r.size, r.target, r.taken) for r in alone] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        curriculum.due(((0.0, 1.0), (0.5, 1.0)), None)


def spelled(rows, ratio=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) < 2:
                short, long = sorted((a, b), key=len)
                head = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
                if short[head + (len(a) == len(b)) :] == long[head + 1 :]:
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda x: (-words[x], x))
        if words[best] >= ratio * words[w]:
            form[w] = best
    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


@pytest.mark.parametrize("crowded", [1, spelling.CROWDED])
def test_spelling_variants(spark, monkeypatch, crowded):
    monkeypatch.setattr(spelling.near, "__defaults__", (spelling.SYMBOLS, crowded))
    r = random.Random(4)
    letters = "abceABéßÿ×÷"
    stems = ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "Łódźka"]

    def misspelt(w):
        i, c = r.randrange(len(w)), r.choice(letters)
        return r.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])

    pool = stems * 12 + [misspelt(w) for w in stems for _ in range(5)]
    rows = [(None if i % 37 == 0 else i, None if i % 41 == 0 else r.choice(["", " ", ", ", "1"]).join([" ".join(r.choice(pool) for _ in range(60)), "end漢🙂"])) for i in range(150)]
    rows += rows[:5] + [(900, "Stehlampe " * 40_000 + "x" * 200_000), (901, "")]
    docs = spark.createDataFrame([(*x, "w", 1) for x in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {tuple(x) for x in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == spelled(rows) and any(x[1] for x in got)
    assert spelling.variants(docs.limit(0)).count() == 0


def test_forms_are_followed_to_the_last(spark):
    n, docs = 5, []
    for k, word in enumerate(["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg"]):
        docs.append((f"{word} " * (n * 6**k)).strip())
    got = {x.word: x for x in spelling.variants(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), damaged=10**12).collect()}
    assert {x.root for x in got.values()} == {"abjihg"} and got["abcdef"].form == "abcdeg"


def test_own_columns_with_internal_names_stay(spark):
    """All stages of the pipeline that hand documents on, with columns that are named as theirs."""
    from landcarbon.llm import decontaminate, order_minhash, secret_scan, weak_quality

    names = "_spans _Words _items _kept _n _row _by txt ps sp arr acc found node key keys codes component least class_id doc_id_ size hit".split()
    text = "the river flows over stones token = abcdefghijkl0123 and " + " ".join(f"word{i}" for i in range(60))
    rows = [(i, t, "en", "s", 0, *(f"{n}{i}" for n in names)) for i, t in enumerate([text, text, None, "", "other words of the item here that nobody else has in it at all"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in names))
    items = spark.createDataFrame([("b", "nobody else has in it at all")], "item_id string, text string")
    for stage in (secret_scan.redacted, order_minhash.deduplicated, weak_quality.filtered, lambda d: decontaminate.cleaned(d, decontaminate.automata(items))):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() > 0
        for r in out.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names)
