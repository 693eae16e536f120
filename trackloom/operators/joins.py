"""Interval, band, as-of and authority joins.

Overlap and band joins cut the axis into buckets and join on group and bucket: an equi join that Spark can shuffle, skew-split or
broadcast as it likes. A pair that shares several buckets is kept in the first of them only, so no distinct is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.windows import median_of

Names = Sequence[str]


def _bucketed(df: DataFrame, start: Column, end: Column, width: float) -> DataFrame:
    first, last = F.floor(start / width), F.floor(end / width)
    return df.withColumn("__first", first).withColumn("__bucket", F.explode(F.sequence(first, F.greatest(first, last))))


def overlap_pairs(left: DataFrame, right: DataFrame, group: Names, left_span: tuple[str, str], right_span: tuple[str, str], width: float, inclusive: bool = False) -> DataFrame:
    """All pairs of a group whose spans overlap; half-open unless ``inclusive``. Column names of both sides must differ outside ``group``.

    ``width`` should be about the typical span: rows are copied once a bucket that they touch.
    """
    (ls, le), (rs, re_) = left_span, right_span
    a = _bucketed(left, F.col(ls), F.col(le), width).withColumnRenamed("__first", "__first_a")
    b = _bucketed(right, F.col(rs), F.col(re_), width).withColumnRenamed("__first", "__first_b")
    pairs = a.join(b, [*group, "__bucket"])
    meet = ((F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le))) if inclusive else ((F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)))
    return pairs.where(meet & (F.col("__bucket") == F.greatest("__first_a", "__first_b"))).drop("__bucket", "__first_a", "__first_b")


def overlap_length(ls: Column, le: Column, rs: Column, re_: Column) -> Column:
    return F.greatest(F.least(le, re_) - F.greatest(ls, rs), F.lit(0))


def overlap_mapping(local: DataFrame, units: DataFrame, group: Names, width: float, least_share: float = 0.10, resolved: Column | None = None) -> DataFrame:
    """Each local segment's unit of most overlap, and how clear that is.

    ``local(group, local_id, start, end)`` and ``units(group, unit_id, unit_start, unit_end)`` on one clock; spans are half-open. Ties
    go to the lesser unit id as a string. Kinds: UNRESOLVED_OFFSET where ``resolved`` is false, ONE_TO_MANY with several units of at least
    ``least_share`` of the segment, MANY_TO_ONE where several otherwise EXACT segments share a unit, UNMATCHED without any. Repeated rows of a segment are one,
    segments without a start or an end UNMATCHED. Equal spans meet the units once. Pairs are met twice and never held: first for the most overlap and the counts, numbers that are
    kept by hashing, then for those that share the most.
    """
    spans = local.select(*group, "local_id", "start", "end", (F.lit(True) if resolved is None else resolved).alias("resolved")).distinct()
    span = [*group, "start", "end"]
    shared = overlap_length(F.col("start"), F.col("end"), F.col("unit_start"), F.col("unit_end"))

    def shares(rows: DataFrame) -> DataFrame:
        return overlap_pairs(rows, units, group, ("start", "end"), ("unit_start", "unit_end"), width).withColumn("overlap", shared).withColumn("fraction", shared / F.greatest(F.col("end") - F.col("start"), F.lit(1e-9)))

    most = shares(spans.select(*span).distinct()).groupBy(*span).agg(F.max("overlap").alias("__most"), F.count("*").alias("candidates"), F.count_if(F.col("fraction") >= least_share).alias("significant"))
    # Of the units that share the most, the least id.
    tops = shares(most).where("overlap = __most").groupBy(*span, "overlap", "fraction", "candidates", "significant").agg(F.min(F.col("unit_id").cast("string")).alias("unit_id"))
    out = spans.join(tops, span, "left")
    kind = F.when(F.col("candidates").isNull(), "UNMATCHED").when(~F.col("resolved"), "UNRESOLVED_OFFSET").when(F.col("significant") > 1, "ONE_TO_MANY").otherwise("EXACT")
    out = out.select(*group, "local_id", "start", "end", "unit_id", "overlap", "fraction", F.coalesce("candidates", F.lit(0)).alias("candidates"), kind.alias("kind"))
    sharing = F.count("unit_id").over(Window.partitionBy(*group, "unit_id"))
    return out.withColumn("kind", F.when((F.col("kind") == "EXACT") & (sharing > 1), "MANY_TO_ONE").otherwise(F.col("kind")))


def assign_frames(frames: DataFrame, units: DataFrame, group: Names, frame: str, width: float, keep: str = "last") -> DataFrame:
    """Frames of each unit's inclusive range ``(unit_start, unit_end)``; a frame of several units goes to the first or last of them."""
    pairs = overlap_pairs(frames.withColumn("__f", F.col(frame)), units, group, (frame, "__f"), ("unit_start", "unit_end"), width, inclusive=True).drop("__f")
    order = [F.asc("unit_start"), F.asc("unit_id")] if keep == "first" else [F.desc("unit_start"), F.desc("unit_id")]
    keys = [*group, frame, *[c for c in frames.columns if c not in group and c != frame]]
    return pairs.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def nearest_match(support: DataFrame, master: DataFrame, group: Names, window: float = 1.0, least_iou: float = 0.2) -> DataFrame:
    """Each support interval's best master ``(group, support_id, master_id, score)``; null where none qualifies. A master may be used again.

    A pair qualifies by an intersection over union of at least ``least_iou`` or by centres within ``window``; its score is the greater of
    the union ratio and the closeness ``1 - dt / window``. Ties go to the earlier master, then the lesser id. Inputs hold
    ``support_id, s_start, s_end`` and ``master_id, m_start, m_end``.

    Equal spans are asked once. Pairs are met twice and never held: first for the best score, a number that is kept by hashing, then for those that reach it.
    """
    center = lambda p: (F.col(f"{p}_start") + F.col(f"{p}_end")) / 2
    span = [*group, "s_start", "s_end"]
    asked = support.select(*span).distinct()
    known = master.groupBy(*group, "m_start", "m_end").agg(F.min("master_id").alias("master_id"))
    inter = overlap_length(F.col("s_start"), F.col("s_end"), F.col("m_start"), F.col("m_end"))
    union = F.greatest("s_end", "m_end") - F.least("s_start", "m_start")
    iou = F.when((F.col("s_end") > F.col("s_start")) & (F.col("m_end") > F.col("m_start")) & (union > 0), inter / union).otherwise(0.0)
    dt = F.abs(center("s") - center("m"))
    score = F.greatest(F.col("iou"), F.greatest(F.lit(0.0), 1 - F.col("dt") / max(window, 1e-3)))

    def scored(spans: DataFrame) -> DataFrame:
        # Any pair that qualifies overlaps once the support interval is widened by the window.
        wide = spans.withColumn("__lo", F.col("s_start") - window).withColumn("__hi", F.col("s_end") + window)
        pairs = overlap_pairs(wide, known, group, ("__lo", "__hi"), ("m_start", "m_end"), max(window * 4, 1), inclusive=True)
        return pairs.withColumn("iou", iou).withColumn("dt", dt).where((F.col("iou") >= least_iou) | (F.col("dt") <= window)).withColumn("score", score)

    best = scored(asked).groupBy(*span).agg(F.max("score").alias("__best"))
    tied = scored(best).where("score = __best")
    top = tied.groupBy(*span).agg(F.max("__best").alias("score"), F.min(F.struct("m_start", "master_id")).alias("top"))
    return support.select(*span, "support_id").join(top, span, "left").select(*group, "support_id", F.col("top.master_id").alias("master_id"), "score")


def asof_neighbours(points: DataFrame, known: DataFrame, group: Names, time: str, key: str) -> DataFrame:
    """``(group, key, time, previous, next)``: the last known time strictly before each point and the first at or after it."""
    rows = points.select(*group, key, time, F.lit(1).alias("__ask")).unionByName(known.select(*group, F.lit(None).cast(points.schema[key].dataType).alias(key), time, F.lit(0).alias("__ask")))
    value = F.when(F.col("__ask") == 0, F.col(time))
    before = Window.partitionBy(*group).orderBy(time).rangeBetween(Window.unboundedPreceding, -1)
    # Looking ahead is looking back in falling order: a frame that grows costs one step a row, one that shrinks all that is left.
    after = Window.partitionBy(*group).orderBy(F.desc(time)).rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("previous", F.max(value).over(before)).withColumn("next", F.min(value).over(after))
    return rows.where("__ask = 1").select(*group, key, time, "previous", "next")


def label_at(points: DataFrame, spans: DataFrame, group: Names, time: str, key: str, width: float | None = None, default: str = "UNKNOWN") -> DataFrame:
    """Each point's label: of the first half-open span that holds it, else of the span with the nearest end, else the default.

    The span that holds it, the last end before and the first start after the point are found by as-of lookups instead of products, so ``width``, that of
    the buckets of an earlier form, has no effect.
    """
    none = F.lit(None).cast(points.schema[key].dataType).alias(key)
    at = points.select(*group, key, F.col(time).alias("__t"), F.lit(2).alias("__ask"), F.lit(None).cast("string").alias("label"))
    ends = spans.select(*group, none, F.col("end").alias("__t"), F.lit(0).alias("__ask"), "label")
    starts = spans.select(*group, none, F.col("start").alias("__t"), F.lit(1).alias("__ask"), "label")
    # In order of start, end and label a span is the first to hold a point only beyond the ends of all before it, and what is left of the spans is disjoint.
    before = Window.partitionBy(*group).orderBy("start", "end", "label").rowsBetween(Window.unboundedPreceding, -1)
    first = spans.where("start < end").select(*group, "start", "end", "label", F.max("end").over(before).alias("__m")).where("__m IS NULL OR end > __m")
    first = first.select(*group, none, F.greatest("start", "__m").alias("__t"), F.lit(3).alias("__ask"), "label", F.col("end").alias("__end"))
    rows = at.unionByName(ends).unionByName(starts).unionByName(first, allowMissingColumns=True)
    back = Window.partitionBy(*group).orderBy("__t").rangeBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*group).orderBy(F.desc("__t")).rangeBetween(Window.unboundedPreceding, 0)
    edge = F.struct(F.col("__t").alias("t"), "label")
    rows = rows.withColumn("__h", F.max(F.when(F.col("__ask") == 3, F.struct(F.col("__t").alias("t"), F.col("__end").alias("end"), "label"))).over(back))
    rows = rows.withColumn("__a", F.max(F.when(F.col("__ask") == 0, edge)).over(back)).withColumn("__b", F.min(F.when(F.col("__ask") == 1, edge)).over(ahead)).where("__ask = 2")
    held = F.when(F.col("__h.end") > F.col("__t"), F.col("__h.label"))
    to_a, to_b = F.col("__t") - F.col("__a.t"), F.col("__b.t") - F.col("__t")
    near = F.when(F.col("__b").isNull() | (to_a <= to_b), F.col("__a.label")).otherwise(F.col("__b.label"))
    return rows.select(*group, key, F.coalesce(held, near, F.lit(default)).alias("label"), F.when(held.isNotNull(), "inside").when(near.isNotNull(), "nearest").otherwise("none").alias("how"))


def authority_merge(roster: DataFrame, key: str, features: dict[str, DataFrame]) -> DataFrame:
    """Left joins of feature tables onto the roster, each as a struct named for the feature; absence stays null until the edge.

    A key that repeats in a feature table keeps its first row by all columns, so the roster's rows never multiply.
    """
    out = roster
    for name, table in features.items():
        others = [c for c in table.columns if c != key]
        one = table.groupBy(key).agg(F.min(F.struct(*others)).alias(name))
        out = out.join(one, key, "left")
    return out


def roster_grid(roster: DataFrame, key: str, cameras: Sequence[str]) -> DataFrame:
    """Every unit with every camera: the cameras are a literal list, so the product is an explode."""
    return roster.withColumn("camera", F.explode(F.array(*[F.lit(c) for c in cameras])))


def missing_and_unexpected(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Ids of one side only, with the side they lack: ``missing`` or ``unexpected``."""
    missing = expected.select(key).distinct().join(found.select(key), key, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(found.select(key).distinct().join(expected.select(key), key, "left_anti").withColumn("problem", F.lit("unexpected")))


def _together(rows: DataFrame, group: Names, start: str, end: str, counted: Column) -> tuple[DataFrame, Column]:
    """Rows once for each edge of a counted span, and the aggregate over a span's edges that tells how many spans it meets, itself included.

    They are counted, not paired: those that have started up to a span's end, less those that had ended before its start. Spans that are not
    counted pass through as one row.
    """
    edge = lambda at, kind: F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"))
    edges = rows.withColumn("__e", F.explode(F.when(counted, F.array(edge(start, 0), edge(end, 1))).otherwise(F.array(edge(start, 2)))))
    w = Window.partitionBy(*group).orderBy("__e.at")
    kind = F.col("__e.kind")
    edges = edges.withColumn("__started", F.count_if(kind == 0).over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("__ended", F.coalesce(F.count_if(kind == 1).over(w.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return edges, F.max(F.when(kind == 1, F.col("__started"))) - F.max(F.when(kind == 0, F.col("__ended")))


def stalled_together(tracks: DataFrame, group: Names, start: str, end: str, key: str, least: int = 2) -> DataFrame:
    """Tracks whose inclusive frame ranges overlap those of at least ``least - 1`` others: ``(group, key, together)``."""
    edges, together = _together(tracks.select(*group, key, start, end), group, start, end, F.lit(True))
    return edges.groupBy(*group, key).agg(together.alias("together")).where(F.col("together") >= least)


def with_company(tracks: DataFrame, group: Names, start: str, end: str, key: str, counted: str, flag: str, least: int = 2) -> DataFrame:
    """Adds ``flag``: whether a track is counted and overlaps at least ``least - 1`` other counted ones. Keys are unique in their group.

    All columns travel along with a track's edges, so nothing is joined and the one shuffle is that of the group.
    """
    edges, together = _together(tracks, group, start, end, F.col(counted))
    rest = [c for c in tracks.columns if c not in group and c != key]
    out = edges.groupBy(*group, key).agg(*[F.any_value(c).alias(c) for c in rest], F.coalesce(together >= least, F.lit(False)).alias(flag))
    return out.select(*tracks.columns, flag)


def local_advance(fragments: DataFrame, seams: DataFrame, group: Names, at: str, seam: str, nearest: int = 5, least: int = 3) -> DataFrame:
    """Median advance per frame of the ``nearest`` reference fragments to each seam, null with fewer than ``least``.

    The nearest in frame distance are among the ``nearest`` before and after, so neighbours are taken by rank, not by a product.
    """
    known = F.struct(F.col("center").cast("double").alias("t"), F.col("track_id").cast("long").alias("id"), F.col("advance").cast("double").alias("v"))
    order = Window.partitionBy(*group).orderBy("center", "track_id")
    held = fragments.select(*group, F.lit(None).cast(seams.schema[seam].dataType).alias(seam), F.col("center").cast("double").alias("__t"), F.col("track_id").cast("long").alias("__id"), F.collect_list(known).over(order.rowsBetween(1 - nearest, 0)).alias("__back"), F.collect_list(known).over(order.rowsBetween(0, nearest - 1)).alias("__ahead"))
    asked = seams.select(*group, seam, F.col(at).cast("double").alias("__t"))
    rows = held.unionByName(asked, allowMissingColumns=True)
    is_seam = F.col(seam).isNotNull()
    back = Window.partitionBy(*group).orderBy("__t", is_seam, "__id").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*group).orderBy(F.desc("__t"), is_seam, F.desc("__id")).rowsBetween(Window.unboundedPreceding, 0)
    none = F.array().cast(held.schema["__back"].dataType)
    near = F.array_union(F.coalesce(F.last("__back", True).over(back), none), F.coalesce(F.last("__ahead", True).over(ahead), none))
    rows = rows.withColumn("__near", near).where(is_seam)
    ranked = F.slice(F.array_sort(F.transform("__near", lambda s: F.struct(F.abs(s["t"] - F.col("__t")).alias("d"), s["id"].alias("id"), s["v"].alias("v")))), 1, nearest)
    values = F.transform(ranked, lambda s: s["v"])
    return rows.select(*group, seam, F.when(F.size(values) >= least, median_of(values)).alias("reference"))
