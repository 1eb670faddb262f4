"""Comparison of two runs by key: against the rows themselves, and without an exchange."""

from collections import Counter, defaultdict
from datetime import date

import pytest

from landcarbon.sources.keyed_snapshots import key_changes, keyed_runs, open_keyed, rows_to_redo, write_keyed

SCHEMA = "site string, part int, area double, note string"
OLD = [("a", 1, 1.0, "x"), ("a", 2, 2.0, None), ("b", 1, 3.0, "y"), ("b", 1, 3.0, "y"), (None, 1, 4.0, "z"), ("c", None, 5.0, ""), ("d", 1, 6.0, "w"), ("e", 1, None, "v")]
# Repeated once less, NULL for empty, swapped between columns, gone, new, and a hot key.
NEW = [("a", 2, 2.0, None), ("a", 1, 1.0, "x"), ("b", 1, 3.0, "y"), (None, 1, 4.0, "z"), ("c", None, 5.0, None), ("e", 1, None, "v"), ("f", 9, 1.0, "u")] + [("hot", 0, float(i), "h") for i in range(500)]


def statuses(old, new):
    sides = []
    for rows in (old, new):
        by_key = defaultdict(Counter)
        for r in rows:
            by_key[r[:2]][r] += 1
        sides.append(by_key)
    a, b = sides
    kind = lambda k: "new" if k not in a else "gone" if k not in b else "same" if a[k] == b[k] else "changed"
    return {k: (kind(k), sum(a[k].values()) if k in a else 0, sum(b[k].values()) if k in b else 0) for k in {*a, *b}}


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("keyed"))
    for moment, rows in ((date(2024, 1, 1), NEW), (date(2024, 1, 1), OLD), (date(2025, 1, 1), NEW), (date(2026, 1, 1), [])):
        write_keyed(spark.createDataFrame(rows, SCHEMA).repartition(3), base, "report", moment, ["site", "part"], buckets=4)
    return base


def test_changes_by_key(spark, base):
    other = spark.newSession()
    runs = [open_keyed(other, base, "report", r) for r in keyed_runs(other, base, "report")]
    assert keyed_runs(other, base, "report") == ["20240101", "20250101", "20260101"]
    found = lambda a, b: {(r.site, r.part): (r.status, r.n_before, r.n_after) for r in key_changes(a, b).collect()}
    for i, old in enumerate((OLD, NEW, [])):
        for j, new in enumerate((OLD, NEW, [])):
            assert found(runs[i], runs[j]) == statuses(old, new), (i, j)
    redo = Counter(tuple(r) for r in rows_to_redo(runs[0], runs[1]).collect())
    states = statuses(OLD, NEW)
    assert redo == Counter(r for r in NEW if states[r[:2]][0] in ("new", "changed"))


def test_neither_run_is_shuffled(spark, base):
    runs = [open_keyed(spark, base, "report", r) for r in ("20240101", "20250101")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = key_changes(*runs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_run_that_breaks_off_is_unseen(spark, base, monkeypatch):
    from landcarbon.sources import keyed_snapshots

    def broken(*_):
        raise RuntimeError("broken off")

    monkeypatch.setattr(keyed_snapshots, "put_text", broken)
    with pytest.raises(RuntimeError):
        write_keyed(spark.createDataFrame(OLD, SCHEMA), base, "report", date(2027, 1, 1), ["site", "part"], buckets=4)
    assert keyed_runs(spark, base, "report")[-1] == "20260101"
    with pytest.raises(LookupError):
        open_keyed(spark, base, "report", "20270101")
