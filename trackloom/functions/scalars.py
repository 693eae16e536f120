"""Column functions over boxes, spans, times, labels and identifiers. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strengths of the evidence against a state (fixed values).
VERIFIER = {"reflection": 0.30, "gap_trend": 0.25, "consistency": 0.20, "motion": 0.25}
Box = tuple[Column, Column, Column, Column]


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def iou(a: Box, b: Box, floor: float = 0.0) -> Column:
    """Intersection over union of two boxes; 0 where the union is empty. ``floor`` is a least value of the union."""
    inter = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    union = F.greatest(area(a) + area(b) - inter, F.lit(floor))
    return F.when(union > 0, inter / union).otherwise(0.0)


def temporal_iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Of half-open spans; 0 if either is empty."""
    inter = F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))
    union = F.greatest(e1, e2) - F.least(s1, s2)
    return F.when((e1 <= s1) | (e2 <= s2) | (union <= 0), 0.0).otherwise(inter / union)


def overlap_of_shorter(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared frames of inclusive spans, relative to the shorter."""
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))
    return shared / F.greatest(F.least(e1 - s1, e2 - s2) + 1, F.lit(1))


def seconds(frame: Column, fps: Column) -> Column:
    return F.when(fps > 0, frame / fps).otherwise(0.0)


def sigma(start: Column, end: Column, fps: Column) -> Column:
    """Half the span in seconds, between 0.1 and 1."""
    return F.least(F.greatest(F.when(fps > 0, (end - start) / 2 / fps).otherwise(0.0), F.lit(0.1)), F.lit(1.0))


def match_cost(dt: Column, c1: Column, c2: Column, gate: float, tolerance: float, weight: float = 0.25) -> Column:
    """Null beyond the gate; dearer for less confident pairs."""
    return F.when(dt <= gate, dt / max(tolerance, 1e-9) * (1 + weight * F.greatest(F.lit(0.0), 1 - (c1 + c2) / 2)))


def match_cost_by_sigma(dt: Column, s1: Column, s2: Column, c1: Column, c2: Column, gate: float = 3.0, weight: float = 0.25) -> Column:
    """The same with the distance in units of both spreads; null beyond so many of them, or without any spread."""
    spread = F.sqrt(s1 * s1 + s2 * s2)
    far = F.when(spread > 0, dt / spread)
    return F.when(far <= gate, far / gate * (1 + weight * F.greatest(F.lit(0.0), 1 - (c1 + c2) / 2)))


def local_frame(time: Column, offset: Column, fps: Column, total: Column) -> Column:
    """The camera's frame at a global instant; null outside its footage, never clamped."""
    f = F.bround((time - offset) * fps).cast("long")
    return F.when((f >= 0) & (f < total), f)


def local_range(t0: Column, t1: Column, offset: Column, fps: Column, total: Column) -> tuple[Column, Column]:
    """Inclusive frames of a global span, clamped to the footage; nulls where fully outside."""
    a, b = F.bround((t0 - offset) * fps).cast("long"), F.bround((t1 - offset) * fps).cast("long") - 1
    inside = (b >= 0) & (a < total) & (b >= a)
    return F.when(inside, F.greatest(a, F.lit(0))), F.when(inside, F.least(b, total - 1))


def canonical(value: Column, names: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact lookup of the trimmed, upper-cased value; else the default, or the value itself."""
    key = F.upper(F.trim(value))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(table[key], value if default is None else default)


def by_substring(value: Column, rules: list[tuple[str, str]], default: str = "UNKNOWN") -> Column:
    """The first rule whose token occurs, in order."""
    low, out = F.lower(F.coalesce(value, F.lit(""))), F.lit(default)
    for token, name in reversed(rules):
        out = F.when(low.contains(token), name).otherwise(out)
    return out


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def corrected_number(number: Column, similar: tuple[str, str] = ("4569780", "1113111")) -> Column:
    """If the first two digits are no valid type (10 to 39), a misread first digit is replaced by the one it looks like."""
    kind = F.substring(number, 1, 2).cast("int")
    return F.when(kind.between(10, 39) | kind.isNull(), number).otherwise(F.concat(F.translate(F.substring(number, 1, 1), *similar), F.substring(number, 2, 1000)))


def number_errors(number: Column) -> Column:
    """What invalidates an identifier: its length, other characters, its type."""
    return F.array_compact(F.array(F.when(F.length(number) != 11, "length"), F.when(~number.rlike("^[0-9]+$"), "not numeric"), F.when(~F.coalesce(F.substring(number, 1, 2).try_cast("int").between(10, 39), F.lit(False)), "type")))


def number_fields(number: Column) -> Column:
    """Type, owner, year, serial and check digit: 2, 2, 2, 4 and 1 digits."""
    cuts = (("type", 1, 2), ("owner", 3, 2), ("year", 5, 2), ("serial", 7, 4), ("check", 11, 1))
    return F.struct(*[F.substring(number, a, n).alias(name) for name, a, n in cuts])


def formatted_number(number: Column) -> Column:
    f = number_fields(number)
    return F.concat_ws(" ", f["type"], f["owner"], f["year"], f["serial"], f["check"])


def slot(track: Column, camera: Column) -> Column:
    return F.concat(F.lit("track_"), track.cast("string"), F.lit("__"), camera)


def slot_track(name: Column) -> Column:
    return F.regexp_extract(name, r"^track_(\d+)(?:__.*)?$", 1).try_cast("long")


def slot_camera(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^track_\d+__(.+)$", 1), F.lit(""))


def local_id(camera: Column, n: Column) -> Column:
    return F.concat(F.lit("L_"), camera, F.lit("_"), n.cast("string"))


def natural_key(name: Column) -> Column:
    """The numeric suffix of an id, for sorting ``GW_2`` before ``GW_10``."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("long")


def batch_time(name: Column) -> Column:
    """The first ``YYYYMMDD_HHMMSS`` in a name as a timestamp, null if there is none."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"(\d{8}_\d{6})", 1), F.lit("")), F.lit("yyyyMMdd_HHmmss"))


def age_seconds(name: Column, now: Column) -> Column:
    """Whole seconds from the time in a name to ``now``; null without one."""
    return F.unix_timestamp(now) - F.unix_timestamp(batch_time(name))


def door_status(state: Column) -> Column:
    s = F.regexp_replace(F.upper(F.trim(state)), "_", " ")
    return F.when(state.isNull() | (F.trim(state) == ""), "UNKNOWN").when(s.isin("OPENED", "DOOR OPEN"), "OPEN").when(s.isin("SHUT", "DOOR CLOSED"), "CLOSED").otherwise(s)


def damage_status(status: Column, damaged: Column) -> Column:
    return F.when(status == "DISABLED_BY_USER", "DISABLED").when(status.isNull() | status.isin("NO_FRAMES", "FAILED", "NO_DATA"), "NO_DATA").when(damaged, "DAMAGE").otherwise("OK")


def expanded(b: Box, factor: float, width: float, height: float) -> Box:
    """A box grown about its centre and clipped to the image."""
    cx, cy, w, h = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2, (b[2] - b[0]) * factor / 2, (b[3] - b[1]) * factor / 2
    clip = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), F.lit(float(top)))
    return clip(cx - w, width), clip(cy - h, height), clip(cx + w, width), clip(cy + h, height)


def at_edge(b: Box, width: float, height: float, margin: float) -> Column:
    return (b[0] <= margin) | (b[1] <= margin) | (b[2] >= width - margin) | (b[3] >= height - margin)


def snapshot_score(b: Box, confidence: Column, quality: Column, width: float, height: float, weights: tuple[float, float, float, float] = (0.35, 0.25, 0.25, 0.15), penalty: float = 0.5) -> Column:
    """Weighted area, centring, confidence and quality; boxes at the edge count less."""
    off = (F.abs((b[0] + b[2]) / 2 / width - 0.5) + F.abs((b[1] + b[3]) / 2 / height - 0.5))
    parts = (F.least(area(b) / (width * height) * 4, F.lit(1.0)), F.greatest(1 - off, F.lit(0.0)), confidence, quality)
    total = weights[0] * parts[0] + weights[1] * parts[1] + weights[2] * parts[2] + weights[3] * parts[3]
    return total * F.when(at_edge(b, width, height, 0.02 * width), penalty).otherwise(1.0)


def spatial_cell(x: Column, y: Column, size: float = 50.0) -> Column:
    return F.concat_ws(":", (x / size).cast("int").cast("string"), (y / size).cast("int").cast("string"))


def spatial_similarity(distance: Column, reach: Column) -> Column:
    """1 at the same place, falling evenly to 0 at ``reach``."""
    return F.greatest(1 - distance / reach, F.lit(0.0))


def temporal_similarity(s1: Column, e1: Column, s2: Column, e2: Column, max_gap: float) -> Column:
    """Of inclusive spans: from 0.7 up to 1 by how much of the longer they share, or from 0.7 down to 0 by the gap between them."""
    shared = (F.least(e1, e2) - F.greatest(s1, s2) + 1) / (F.greatest(e1 - s1, e2 - s2) + 1)
    apart = F.greatest(1 - (F.greatest(s1, s2) - F.least(e1, e2)) / F.lit(float(max_gap)), F.lit(0.0))
    return F.when((s1 <= e2) & (s2 <= e1), 0.7 + 0.3 * shared).otherwise(0.7 * apart)


def verified(current: Column, evidence: Mapping[str, Column], confirms: Column, least: float = 0.7) -> Column:
    """The state after a verifier: overridden where the strengths of the evidence against it sum to ``least``, unless something confirms it.

    ``evidence`` holds booleans by the names of ``VERIFIER``.
    """
    strength = sum((F.when(evidence[k], w).otherwise(0.0) for k, w in VERIFIER.items() if k in evidence), F.lit(0.0))
    return F.when(confirms, current).when(F.round(strength, 6) >= least, "REJECTED").otherwise(current)


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def _dot(x: Column, y: Column) -> Column:
    return _sum(F.zip_with(x, y, lambda s, t: s * t))


def _let(value: Column, then) -> Column:
    """Names a value, so that it is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def look_of(a: Column) -> Column:
    """A histogram as ``alike_looks`` takes it: its values less their mean, so that sums of products of like values lose no digits, and the sum of their squares."""
    centred = _let(F.transform(a, lambda v: v.cast("double")), lambda p: _let(_sum(p) / F.size(p), lambda m: F.transform(p, lambda v: v - m)))
    return F.when(F.size(a) > 0, _let(centred, lambda c: F.struct(c.alias("c"), _dot(c, c).alias("q"))))


def alike_looks(a: Column, b: Column) -> Column:
    """``alike`` of histograms that were prepared by ``look_of``, once each and not once a pair."""
    spread = a["q"] * b["q"]
    near = (F.when(spread > 2.0**-52, _dot(a["c"], b["c"]) / F.sqrt(spread)).otherwise(1.0) + 1) / 2
    return F.when(F.coalesce(F.size(a["c"]) == F.size(b["c"]), F.lit(False)) & a.isNotNull() & b.isNotNull(), near).otherwise(0.5)


def alike(a: Column, b: Column) -> Column:
    """Correlation of two histograms (arrays of numbers) from 0 to 1; 0.5 where one is null or empty or their sizes differ, 1 where one does not vary."""
    return _let(look_of(a), lambda x: _let(look_of(b), lambda y: alike_looks(x, y)))
