"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every document joins its source's queue in a shuffled order (by a hash of its id), once for each allowed epoch. A place in the
queue has a virtual finish time: the words of the source up to and including it, divided by the source's target. A global
order by finish time serves all sources in proportion to their targets, and the order is cut where the words reach the budget.

Prefix sums never put a source, or the whole order, into one task: a queue is cut into parts by ranges of the hash, sized from the
source's count, whose sums are added up first. The place of the cut is found through two histograms of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Documents in one part of a source's queue.
PART_ROWS = 4096
#: Bins of each histogram of finish times.
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """``(source, source_no, source_size, n_docs, target)``: the budget dealt by weight, full sources' excess dealt anew.

    Filling stops at ``repeats`` times a source's size. Sorted by the level at which sources fill, the common level follows from two
    running sums, which is the fixed point of dealing the excess again until no source is above.
    """
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    stats = stats.withColumn("source_no", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    stats = stats.withColumn("weight", weight).withColumn("most", (F.col("source_size") * repeats).cast("double"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    stats = stats.withColumn("level", left / rest)
    open_level = F.min(F.when(F.col("level") < F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), "source_no", "level"))).over(everything)["level"]
    return stats.select("source", "source_no", "source_size", "n_docs", F.least("most", F.coalesce(F.col("weight") * open_level, F.col("most"))).alias("target"))


def _cut(places: DataFrame, budget: float) -> Callable[[Column], Column]:
    """Whether a place with a finish time is served: those up to the last time at which the running sum of words is within the budget.

    Two histograms narrow the cut to one bin of one bin; only that is summed row by row, by distinct time.
    """
    steps: list[int] = []
    taken, end = 0.0, None

    def bins_of(time: Column) -> list[Column]:
        """Bins of a time on the levels so far and on the next."""
        scaled, out = time * (BINS // 2), []
        for chosen in [*steps, 0]:
            out.append(F.greatest(F.lit(0), F.least(F.floor(scaled), F.lit(BINS - 1))).cast("int"))
            scaled = (scaled - chosen) * BINS
        return out

    def inside(time: Column) -> Column:
        return reduce(and_, [at == chosen for at, chosen in zip(bins_of(time), steps)], F.lit(True))

    for _ in range(2):
        bins = places.where(inside(F.col("finish"))).groupBy(bins_of(F.col("finish"))[-1].alias("bin")).agg(F.sum("size").alias("words"))
        bins = bins.withColumn("upto", F.sum("words").over(Window.orderBy("bin")) + F.lit(taken))
        row = bins.where(F.col("upto") > budget).orderBy("bin").first()
        if row is None:
            end = float("inf")
            break
        taken = float(row.upto - row.words)
        steps.append(row.bin)
    if end is None:
        last = places.where(inside(F.col("finish"))).groupBy("finish").agg(F.sum("size").alias("words"))
        last = last.withColumn("upto", F.sum("words").over(Window.orderBy("finish")) + F.lit(taken))
        end = last.where(F.col("upto") <= budget).agg(F.max("finish").alias("finish")).first().finish

    def served(time: Column) -> Column:
        kept, so_far = F.lit(False), F.lit(True)
        for at, chosen in zip(bins_of(time), steps):
            kept, so_far = kept | (so_far & (at < chosen)), so_far & (at == chosen)
        return kept if end is None else kept | (so_far & (time <= F.lit(end)))

    return served


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, finish)`` for every row.

    ``share`` times all words are dealt to the sources by ``weights`` (repeating, sources by code point, null last); a target
    stops at ``repeats`` times its source. ``finish`` holds the virtual finish times of the copies that the mix takes and ``taken`` their
    words. A null or empty text has size 0 and takes nothing; repeated rows queue one after the other; rows with a null id are placed by their text.
    An empty table gives no rows. Extra columns are ignored.
    """
    order = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))), 1, 15), 16, 10).cast("long")
    sized = materialize(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), order.alias("place")))
    targets = source_targets(sized, weights, share, repeats).withColumnRenamed("source", "name")
    parts = (F.floor(F.col("n_docs") / PART_ROWS) + 1).cast("long")
    part = F.shiftright(F.shiftright("place", 28) * parts, 32)
    queued = materialize(sized.join(targets, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("part", part))
    sums = queued.groupBy("source_no", "part").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("source_no").orderBy("part")) - F.col("words")
    sums = sums.select("source_no", "part", ahead.alias("ahead"))
    within = Window.partitionBy("source_no", "part").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.col("ahead") + F.sum("size").over(within)
    times = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda k: (k * F.col("source_size") + F.col("cum")) / F.col("target"))
    queued = queued.join(sums, ["source_no", "part"]).withColumn("cum", cum)
    queued = materialize(queued.withColumn("times", F.when(F.col("size") > 0, times).otherwise(F.array().cast("array<double>"))))
    total = queued.agg(F.sum("size")).first()[0] or 0
    served = _cut(queued.select("size", F.explode("times").alias("finish")), share * total)
    taken = queued.select("doc_id", "source", "size", "source_size", "target", F.filter("times", served).alias("finish"))
    return taken.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("finish")).cast("long").alias("taken"), "finish")


def schedule(mixed: DataFrame) -> DataFrame:
    """The copies that the mix takes, range-sorted over all partitions by finish time: the order in which to read them."""
    return mixed.select("*", F.posexplode("finish").alias("epoch", "time")).drop("finish").orderBy("time", "source", "doc_id")
