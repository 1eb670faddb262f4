"""Mixes sources to target weights along a curriculum.

``targets`` shares the words of all documents among the sources by weight; no source gives more than ``REPEATS`` times
its own words, and what it cannot give is shared again by weight among the others, until none is above that.

``allotted`` turns a target into whole documents. Documents of a source stand in the order of a hash. All are taken as
often as the target holds the source whole; one more copy of some fills the rest. These are cut off where the words
before them reach what is left, document by document of a length class, long ones first; what a class takes too much or
too little is carried to the next one, so that the short ones level it.

``scheduled`` gives every copy its place. The weight of a source changes over training time from 0 to 1, in straight
lines between the points of its schedule. Its integral, scaled to the words taken, is the demand up to a time; a copy
that starts after c words of its source is due when the demand reaches c, which is the root of a quadratic.
``mixed`` writes the copies in that order, by a range sort, with the words before each of them.

Sources are ordered by code point, null last, and null is a source of its own. A null or empty text has no words: it is
never taken. A source without words has the target 0. Equal documents are told apart by their row, repeated rows each
count; which of them takes a copy is settled by hash, id and number of the row, so runs repeat. Other columns stay out
of the way. An empty table gives no rows. Sources may be of any number and size: sums along an order are taken over
ranges, and whether sources are broadcast is left to Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landcarbon.llm.common import WHITE, map_arrow, staged

WEIGHTS = (5, 2, 1)
REPEATS = 3
# Weight over training time, per weight in turn: (time, weight) from 0 to 1.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.5), (1.0, 1.0)), ((0.0, 0.2), (0.7, 0.8), (1.0, 3.0)))
# Length classes: documents above these shares of their source's target, and the rest.
LONG = (1 / 16, 1 / 128, 1 / 1024)


def running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df``, staged in order of keys and ``order``, with the sum of ``value`` over the earlier rows of the keys.

    Rows are sorted in ranges, so that a key of any size spreads over tasks; a range then adds what earlier ranges have.
    """
    columns = df.columns
    where = [columns.index(k) for k in keys]
    at = columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            before = []
            for *key, v in zip(*(batch.column(i).to_pylist() for i in where), batch.column(at).to_pylist()):
                if key != last:
                    last, total = key, 0
                before.append(total)
                total += v
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*columns, name])

    ordered = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered)
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", {name} long"
    placed = staged(map_arrow(placed, run, schema).withColumn("_range", F.spark_partition_id()))

    # A range begins and ends with the keys of its neighbours, so these are about as many rows as ranges and keys.
    sums = placed.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.select(*keys, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")))
    same = F.col("p._range") == F.col("o._range")
    for k in keys:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"o.{k}"))
    out = placed.alias("p").join(offsets.alias("o"), same)
    return out.select(*(f"p.{c}" for c in columns), (F.col(f"p.{name}") + F.col("o._offset")).alias(name))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, doc_id, source, size) of every document, staged; ``row`` tells rows apart, ``size`` is the number of words."""
    size = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(f"[^{WHITE}]+")).cast("long")
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, turn, source_size, target), staged: the words that the mix wants of each source; ``turn`` is that of its weight."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1).cast("long"))
    turn = F.expr(f"cast(_rank % {len(weights)} as int)")
    ranked = running(sources, [], ["source"], "_one", "_rank").select("source", turn.alias("turn"), "source_size")
    weight = F.expr(f"element_at(array({', '.join(f'{float(w)!r}D' for w in weights)}), turn + 1)")
    ranked = staged(ranked.withColumn("_weight", weight))
    # One weight's share rises with every source that reaches its limit, so this ends after as many rounds at most.
    share, limited = 0.0, -1
    while True:
        above = F.lit(share) * F.col("_weight") > repeats * F.col("source_size")
        sums = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(above, repeats * F.col("source_size"))).alias("given"), F.sum(F.when(~above, F.col("_weight"))).alias("open"), F.count_if(above).alias("n")).first()
        if sums.n <= limited or not sums.open:
            break
        limited = sums.n
        share = (sums.all - (sums.given or 0)) / sums.open
    target = F.least(F.lit(share) * F.col("_weight"), (repeats * F.col("source_size")).cast("double"))
    return staged(ranked.select("source", "turn", "source_size", target.alias("target")))


def allotted(sizes: DataFrame, wanted: DataFrame, repeats: int = REPEATS, long: tuple[float, ...] = LONG) -> DataFrame:
    """(row, doc_id, source, size, copies) of documents that the mix takes at least once."""
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats)).cast("long")
    shares = wanted.filter("source_size > 0").select("source", "target", "source_size", whole.alias("whole"))
    length = F.lit(len(long))
    for k in reversed(range(len(long))):
        length = F.when(F.col("size") > F.col("target") * F.lit(long[k]), F.lit(k)).otherwise(length)
    own = sizes.alias("d").join(shares.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).filter("size > 0")
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    own = own.select("row", "doc_id", "d.source", "size", "whole", length.alias("length"), order.alias("order"))
    own = staged(running(own, ["source", "length"], ["order", "doc_id", "size", "row"], "size"))

    sums = own.groupBy("source", "length").agg(F.sum("size").alias("words"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    part = sums.alias("c").join(shares.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
    part = staged(part.select("c.source", "length", (rest * F.col("words") / F.col("source_size")).alias("part")))
    left = shares.select("source", F.lit(0.0).alias("carry"))
    cuts = []
    fits = F.col("before") + F.col("size") / 2 < F.col("need")
    for k in range(len(long) + 1):
        of_class = part.filter(F.col("length") == k).alias("c").join(left.alias("l"), F.col("c.source").eqNullSafe(F.col("l.source")))
        need = staged(of_class.select("c.source", "length", (F.col("part") + F.col("carry")).alias("need")))
        cuts.append(need)
        if k < len(long):
            took = own.filter(F.col("length") == k).alias("d").join(need.alias("n"), F.col("d.source").eqNullSafe(F.col("n.source")))
            took = took.groupBy("d.source", "need").agg(F.coalesce(F.sum(F.when(fits, F.col("size"))), F.lit(0)).alias("took"))
            over = took.select(F.col("source").alias("from"), (F.col("need") - F.col("took")).alias("over"))
            left = left.join(over, F.col("source").eqNullSafe(F.col("from")), "left")
            left = staged(left.select("source", F.coalesce("over", "carry").alias("carry")))
    every = cuts[0]
    for cut in cuts[1:]:
        every = every.unionByName(cut)
    both = own.alias("d").join(staged(every).alias("n"), F.col("d.source").eqNullSafe(F.col("n.source")) & (F.col("d.length") == F.col("n.length")))
    both = both.select("row", "doc_id", "d.source", "size", (F.col("whole") + fits.cast("long")).alias("copies"))
    return both.filter("copies > 0")


def due(schedule: tuple[tuple[float, float], ...], share: Column) -> Column:
    """The time at which the integral of a schedule reaches a share of its whole."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1 or any(b[0] <= a[0] for a, b in zip(schedule, schedule[1:])) or min(w for _, w in schedule) < 0:
        raise ValueError(f"a schedule runs from time 0 to 1 with weights from 0 on: {schedule}")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    if sum(areas) <= 0:
        raise ValueError(f"a schedule needs weight at some time: {schedule}")
    time = F.lit(1.0)
    for k in reversed(range(len(areas))):
        (t0, w0), (t1, w1) = schedule[k], schedule[k + 1]
        over = share * F.lit(float(sum(areas))) - F.lit(float(sum(areas[:k])))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * (w1 - w0) / (t1 - t0)) * over, F.lit(0.0)))
        within = F.when(over > 0, F.lit(t0) + 2 * over / (F.lit(float(w0)) + root)).otherwise(F.lit(float(t0)))
        time = F.when(over <= F.lit(float(areas[k])), F.least(within, F.lit(float(t1)))).otherwise(time)
    return time


def scheduled(taken: DataFrame, wanted: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """(row, doc_id, source, size, copy, time) of every copy that ``allotted`` gives."""
    copies = taken.select("row", "doc_id", "source", "size", F.expr("explode(sequence(1L, copies))").alias("copy"))
    order = F.md5(F.concat_ws(":", F.col("copy").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    copies = staged(running(copies.withColumn("order", order), ["source"], ["copy", "order", "doc_id", "size", "row"], "size"))
    sums = copies.groupBy(F.col("source").alias("from")).agg(F.sum("size").alias("all"))
    about = wanted.select("source", "turn").join(sums, F.col("source").eqNullSafe(F.col("from"))).select("from", "turn", "all")
    share = F.col("before") / F.col("all")
    time = due(schedules[-1], share)
    for k in reversed(range(len(schedules) - 1)):
        time = F.when(F.expr(f"turn % {len(schedules)} = {k}"), due(schedules[k], share)).otherwise(time)
    placed = copies.join(staged(about), F.col("source").eqNullSafe(F.col("from")))
    return placed.select("row", "doc_id", "source", "size", "copy", time.alias("time"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, schedules: tuple = SCHEDULES, **columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(copies, sizes, targets): the copies in training order, with ``time`` and the words before each as ``start``."""
    sizes = sized(docs, **columns)
    wanted = targets(sizes, weights, repeats)
    copies = scheduled(allotted(sizes, wanted, repeats), wanted, schedules)
    return running(copies, [], ["time", "source", "copy", "doc_id", "row"], "size", "start"), sizes, wanted


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_start) of every document; the last is null where none is taken."""
    copies, sizes, wanted = mixed(docs, **options)
    sums = copies.groupBy(F.col("row").alias("own")).agg(F.sum("size").alias("taken"), F.min("start").alias("first_start"))
    every = sizes.join(sums.hint("shuffle_merge"), F.col("row") == F.col("own"), "left").alias("d")
    every = every.join(wanted.alias("w"), F.col("d.source").eqNullSafe(F.col("w.source")))
    return every.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_start")
