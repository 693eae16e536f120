"""One order of boundaries from the master's and those that supports alone have seen, and the units between them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.stateful import _fold

Names = Sequence[str]


def ranked(df: DataFrame, group: Names, order: str, ties: Names, name: str, width: float) -> DataFrame:
    """Adds ``name``: each row's place in its group by ``order`` and then ``ties``, from 1.

    Two levels: places inside stretches of ``width`` of the order, and prefix sums over a small table with a row for each stretch, so a group of any size is
    spread over tasks.
    """
    rows = df.withColumn("__part", F.floor(F.col(order) / width))
    sizes = rows.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*group, "__part").orderBy(order, *ties))
    rows = rows.withColumn("__in", inside).join(sizes.select(*group, "__part", before.alias("__before")), [*group, "__part"])
    return rows.withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__part", "__in", "__before")


def insert_boundaries(masters: DataFrame, clusters: DataFrame, group: Names, width: float) -> DataFrame:
    """``(group, number, key, source, frame)``: master boundaries ``(group, key, frame)`` and accepted clusters ``(group, cluster, frame)`` in one order.

    Clusters get the ids -1, -2, ... of their group, in the order of frames, then of their own; of equal frames the inserted boundary comes first, then the lesser key.
    Numbers run from 1. Masters with a null frame are left out.
    """
    made = ranked(clusters.where("frame IS NOT NULL").select(*group, "cluster", "frame"), group, "frame", ["cluster"], "__no", width)
    made = made.select(*group, (-F.col("__no")).alias("key"), F.lit("fused").alias("source"), "frame")
    own = masters.where("frame IS NOT NULL").select(*group, F.col("key").cast("long").alias("key"), F.lit("master").alias("source"), "frame")
    rows = own.unionByName(made).withColumn("__late", F.col("source") == "master")
    return ranked(rows, group, "frame", ["__late", "key"], "number", width).select(*group, "number", "key", "source", "frame")


_LABEL, _BOUNDARY, _END = 0, 1, 2


def fused_units(boundaries: DataFrame, labels: DataFrame, spans: DataFrame, group: Names) -> DataFrame:
    """``(group, unit, start_frame, end_frame, label, how, leading, leading_source, trailing, trailing_source)`` between the boundaries of ``insert_boundaries``.

    ``labels`` is ``(group, start, end, label)``, both ends inside; ``spans`` is ``(group, total_frames)``. One sweep over all three by frame, which carries the last boundary
    and the labels that may still count. Boundaries are pulled into the footage; several at one frame, and those at its first, cut once or not at all. A unit takes the label at its middle: of the
    first span that holds it (``inside``), else of the nearest end (``nearest``, the earlier span of equals), else UNKNOWN (``none``). Leading is the last boundary up to
    its first frame, trailing the first after its last one; null at the ends of the footage. A group without footage gives no units.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen: list[tuple] = []  # spans (start, end, label) that the middle of a unit may still lie in
        past: tuple | None = None  # (end, label) of the last to end among the others, the earliest span of equals
        pending: list[tuple] = []  # units whose middle no span has begun after yet
        begin, number, lead = 0, 0, (None, None)

        def settled(upto: int | None, ahead: tuple | None) -> Iterator[tuple]:
            while pending and (upto is None or (pending[0][1] + pending[0][2]) // 2 < upto):
                no, start, end, *sides = pending.pop(0)
                middle, near = (start + end) // 2, past
                label, how = next(((s[2], "inside") for s in seen if s[0] <= middle <= s[1]), (None, None))
                if how is None:
                    for s in seen:
                        if s[1] < middle and (near is None or s[1] > near[0]):
                            near = s[1:]
                    next_ = next((s for s in seen if s[0] > middle), ahead)
                    if next_ and (near is None or next_[0] - middle < middle - near[0]):
                        near = (next_[0], next_[2])
                    label, how = (near[1], "nearest") if near else ("UNKNOWN", "none")
                yield no, start, end, label, how, *sides[0], *sides[1]

        for frame, kind, key, source, stop, label in rows:
            if kind == _LABEL:
                yield from settled(frame, (frame, stop, label))
                floor = (pending[0][1] + pending[0][2]) // 2 if pending else begin
                for s in seen:
                    if s[1] < floor and (past is None or s[1] > past[0]):
                        past = s[1:]
                seen = [s for s in seen if s[1] >= floor]
                seen.append((frame, stop, label))
                continue
            if frame > begin:
                number += 1
                pending.append((number, begin, frame - 1, lead, (key, source)))
                begin = frame
            lead = (key, source)
        yield from settled(None, None)

    footage = spans.where("total_frames > 0").select(*group, "total_frames")
    long, text = F.lit(None).cast("long"), F.lit(None).cast("string")
    cuts = boundaries.join(footage, list(group)).select(*group, F.least(F.greatest("frame", F.lit(0)), F.col("total_frames") - 1).cast("long").alias("frame"), F.lit(_BOUNDARY).alias("kind"), "key", "source", long.alias("stop"), text.alias("label"), "number")
    named = labels.join(footage, list(group)).select(*group, F.col("start").cast("long").alias("frame"), F.lit(_LABEL).alias("kind"), long.alias("key"), text.alias("source"), F.col("end").cast("long").alias("stop"), "label", long.alias("number"))
    ends = footage.select(*group, F.col("total_frames").cast("long").alias("frame"), F.lit(_END).alias("kind"), long.alias("key"), text.alias("source"), long.alias("stop"), text.alias("label"), long.alias("number"))
    kinds = {"unit": "bigint", "start_frame": "bigint", "end_frame": "bigint", "label": "string", "how": "string", "leading": "bigint", "leading_source": "string", "trailing": "bigint", "trailing_source": "string"}
    return _fold(cuts.unionByName(named).unionByName(ends), group, ["frame", "kind", "number", "stop", "label"], ["frame", "kind", "key", "source", "stop", "label"], kinds, work)
