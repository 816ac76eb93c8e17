"""Mixing sources to target weights by weighted fair queueing.

1. Every source gets a target: its share by weight of the words to take, at
   most ``repeats`` times its own words; what is above that is shared again by
   weight (``share_out``).
2. The documents of a source queue in the order of a hash of their ids. A
   document's virtual finish time is the number of its source's words up to and
   including it, divided by the source's target. A source longer than its queue
   queues again, ``repeats`` times in all (``queue``).
3. All entries of all sources are range-sorted by finish time, and the mix is
   what comes first, up to the words to take (``cut``).

All of it is DataFrame work. A running sum inside a source is taken in two
steps: a source of n rows is cut into about sqrt(n) stretches of the hash, the
totals of the stretches are summed in order, and so are the rows of a stretch;
no task holds a source. The global order needs the totals of the slices and one
slice's rows.

Defined results: NULL text and text without a word have size 0, take nothing
and stay in the result with 0 words taken; NULL is a source of its own, the
last; rows that repeat source, id and size queue one after another; a NULL id
counts as an empty one for the order; ties in finish time go to the source that
is earlier by code point; a source without words has target 0; an empty table gives
no rows; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh_name, whole_text
from tidewater.operators.skew import null_safe_join, numbered, running_sums
from tidewater.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
# Rows that repeat source, id and size and are expanded by one row of the plan.
COPIES_AT_ONCE = 100_000
KEY = ["source", "doc_id", "size"]


def sized(docs: DataFrame) -> DataFrame:
    """source, doc_id and size in words, a row per row."""
    words = F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint")
    return docs.select(F.col("source").cast("string").alias("source"), "doc_id", words.alias("size"))


def _shuffle(doc_id: str = "doc_id") -> Column:
    """Place of an id in the shuffled order: 60 bits of its MD5."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def share_out(sources: DataFrame, weights: Sequence[int], share: float, repeats: int) -> tuple[DataFrame, float]:
    """Add turn, weight and target to the sources (source, source_size); also the words to take in all.

    Full sources are those whose ``repeats * size / weight`` lies at or below the
    level at which the targets add up; the others get the level times their
    weight. That is where sharing the excess again and again ends.
    """
    turns = numbered(sources, [], [F.col("source").asc_nulls_last()], "turn")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    queued = turns.withColumns({"weight": weight.cast("bigint"), "most": F.col("source_size") * repeats})
    queued = materialise(queued.withColumn("fills_at", F.col("most").cast("double") / F.col("weight")), "sources")
    words, heft = queued.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = min(share, repeats) * (words or 0)
    runs = running_sums(
        queued, [], [F.col("fills_at"), F.col("turn")], {"_most": F.col("most"), "_weight": F.col("weight")}
    )
    needed = F.col("_most") + F.col("fills_at") * (F.lit(heft or 0) - F.col("_weight"))
    marked = materialise(runs.withColumn("_full", needed <= F.lit(budget)), "sources")
    taken, used = marked.filter("_full").agg(F.sum("most"), F.sum("weight")).first()
    left = (heft or 0) - (used or 0)
    level = (budget - (taken or 0)) / left if left else 0.0
    target = F.when(F.col("_full"), F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return marked.withColumn("target", target).drop("_most", "_weight", "_full", "most", "fills_at"), budget


def queue(docs: DataFrame, weights: Sequence[int], share: float, repeats: int) -> tuple[DataFrame, float]:
    """Every document with its source's target and the words queued before it; also the words to take.

    Rows that repeat source, id and size are one row here, with their number.
    """
    groups = sized(docs).groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    groups = materialise(groups, "sizes")
    words = F.col("size") * F.col("copies")
    sources = groups.groupBy("source").agg(F.sum(words).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources, budget = share_out(sources, weights, share, repeats)
    sources = materialise(sources, "targets")  # a row per source: its real size decides the join
    rows = null_safe_join(groups, sources, ["source"]).withColumn("shuffle", _shuffle())
    stretches = F.ceil(F.sqrt("rows"))
    rows = rows.withColumn("stretch", F.floor(F.col("shuffle") / F.lit(float(1 << 60)) * stretches))
    before = Window.partitionBy("turn").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("turn", "stretch").agg(F.sum(words).alias("_all"))
    totals = totals.select("turn", "stretch", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    inside = (
        Window.partitionBy("turn", "stretch")
        .orderBy("shuffle", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_before") + F.coalesce(F.sum(words).over(inside), F.lit(0))
    placed = rows.join(totals, ["turn", "stretch"]).withColumn("_start", start)
    # One row per document again, some rows of a group of copies at a time.
    blocks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE))
    one = placed.withColumn("_block", F.explode(blocks))
    first = F.col("_block") * COPIES_AT_ONCE
    one = one.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1)))
    one = one.withColumn("start", F.col("_start") + F.col("copy") * F.col("size"))
    return one.select(*KEY, "copies", "copy", "turn", "source_size", "target", "start"), budget


def _entry(turn_around: Column) -> Column:
    """(finish time, source, words before) of a document's entry: the global order."""
    start = F.col("start") + turn_around * F.col("source_size")
    finish = F.when(F.col("size") > 0, (start + F.col("size")).cast("double") / F.col("target"))
    return F.struct(finish.alias("finish"), F.col("turn").alias("turn"), start.alias("start"))


def cut(queued: DataFrame, budget: float, repeats: int):
    """The first entry that no longer fits into ``budget`` words; None if all do."""
    slices = int(queued.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = queued.filter("size > 0").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), _entry)).alias("entry"), "size"
    )
    ordered = entries.select("entry.*", "size").repartitionByRange(slices, "finish", "turn", "start")
    ordered = materialise(ordered.withColumn("slice", F.spark_partition_id()), "entries")
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)  # a row per slice
    totals = ordered.groupBy("slice").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    over = totals.filter(F.col("upto") > F.lit(budget)).orderBy("slice").first()
    if over is None:
        return None
    inside = Window.orderBy("finish", "turn", "start").rowsBetween(Window.unboundedPreceding, 0)
    last = ordered.filter(F.col("slice") == over["slice"]).withColumn("upto", F.sum("size").over(inside))
    too_much = F.col("upto") + F.lit(over["upto"] - over["words"]) > F.lit(budget)
    return last.filter(too_much).agg(F.min(F.struct("finish", "turn", "start"))).first()[0]


def schedule(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row per document: source, doc_id, size, copies, copy, source_size, target, passes, taken, finish.

    ``passes`` is how often the mix takes the document, ``taken`` the words that
    makes, ``finish`` its first virtual finish time (NULL without words). Of
    rows that repeat source, id and size, ``copy`` counts from 0.
    """
    queued, budget = queue(docs, weights, share, repeats)
    queued = materialise(queued, "queue")
    end = cut(queued, budget, repeats)
    fits = F.col("size") > 0
    if end is not None:
        kinds = {"finish": "double", "turn": "bigint", "start": "bigint"}
        stop = F.struct(*[F.lit(end[c]).cast(kind).alias(c) for c, kind in kinds.items()])
        passes = sum((F.when(fits & (_entry(F.lit(k)) < stop), 1).otherwise(0) for k in range(repeats)), F.lit(0))
    else:
        passes = F.when(fits, repeats).otherwise(0)
    planned = queued.withColumns({"passes": passes, "finish": _entry(F.lit(0))["finish"]})
    taken = F.col("passes") * F.col("size")
    return planned.select(*KEY, "copies", "copy", "source_size", "target", "passes", taken.alias("taken"), "finish")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The mixed documents with all their columns, range-sorted by finish time (column ``finish``).

    A document taken twice comes twice. Where the table has a column of that
    name, the finish time is called ``_finish``.
    """
    # Of the plan's columns only key, copy and times travel, under names the table does not have.
    names = {c: fresh_name(docs, f"_{c}") for c in (*KEY, "copy", "finish", "pass")}
    finish = fresh_name(docs, "finish")
    plan = schedule(docs, weights, share, repeats).filter("passes > 0")
    step = F.col("source_size") / F.col("target")
    plan = plan.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    plan = materialise(plan.withColumn("finish", F.col("finish") + F.col("pass") * step), "mix-plan")
    keys = [names[c] for c in KEY]
    text = docs.withColumns(
        {
            names["source"]: F.col("source").cast("string"),
            names["doc_id"]: F.col("doc_id"),
            names["size"]: F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint"),
        }
    )
    renamed = lambda df, more: df.select(*[F.col(c).alias(names[c]) for c in (*KEY, *more)])
    single = null_safe_join(text, renamed(plan.filter("copies = 1"), ["finish"]), keys)
    repeated = plan.filter("copies > 1")
    same = null_safe_join(text, renamed(repeated, []).distinct(), keys)
    counted = numbered(same, keys, [F.xxhash64(whole_text())], names["copy"])
    counted = counted.withColumn(names["copy"], F.col(names["copy"]) - 1)
    several = null_safe_join(counted, renamed(repeated, ["copy", "finish"]), [*keys, names["copy"]])
    columns = [*docs.columns, F.col(names["finish"]).alias(finish)]
    return single.select(*columns).unionByName(several.select(*columns)).repartitionByRange(finish).sortWithinPartitions(finish)
