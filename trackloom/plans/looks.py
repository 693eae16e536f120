"""Named queries over windows of looks: the vectors of a label stand for the pictures of a track, a hundred ids for its window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.operators import looks as L
from trackloom.plans.stage import query, table

WINDOW = ["label", "part"]
SLICES = 3
LIMITS = L.LookLimits(bright=0.28, tolerance=2, persistence=0.4, uniform_texture=0.72, moving_edges=3.0, edge_strength=0.15, least_gap=8.5, widening=0.3, narrowing=-0.3, slack=0.3, dark=1.0, least_change=0.08, structured=0.76, moving_share=0.45, directed_share=0.6, steady=0.92)


def looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each look that has a vector: its profile, and by the operators' functions its texture, the centre of its edges (and whether that went on), the widths of its slices and its darkness."""
    v = table(spark, sf_dir, "embeddings").where("size(embedding) > 0")
    p = F.transform("embedding", lambda x: x.cast("double"))
    rows = v.select(F.coalesce("label", F.lit(-1)).alias("label"), F.floor(F.col("vec_id") / 100).alias("part"), "vec_id", p.alias("profile"))
    size = F.transform("profile", F.abs)
    wide = F.floor(F.size("profile") / SLICES).cast("int")
    widths = F.array(*[L.gap_width(F.slice(size, 1 + k * wide, wide), LIMITS.edge_strength) for k in range(SLICES)])
    rows = rows.withColumns({"texture": L.texture_of(F.col("profile")), "centre": L.centre_of(F.col("profile")), "widths": widths, "darkness": L.darkness_of(size)})
    return rows.withColumn("along", F.col("centre") > F.lag("centre").over(Window.partitionBy(*WINDOW).orderBy("vec_id")))


_LOOK = f"""lk AS (SELECT coalesce(label, -1) AS label, vec_id // 100 AS part, vec_id, embedding::DOUBLE[] AS p, list_transform(embedding::DOUBLE[], lambda x: abs(x)) AS a, len(embedding) // {SLICES} AS w FROM embeddings WHERE len(embedding) > 0),
l1 AS (SELECT *, list_avg(a) AS m, list_sum(list_transform(a, lambda x, i: x * (i - 1))) / list_sum(a) AS centre, list_avg(a[len(a) // 3 + 1 : 2 * (len(a) // 3)]) AS inner_, (list_avg(a[1 : len(a) // 3]) + list_avg(a[2 * (len(a) // 3) + 1 :])) / 2 AS outer_, row_number() OVER w - 1 AS i, lag(p) OVER w AS q, count(*) OVER (PARTITION BY label, part) AS n FROM lk WINDOW w AS (PARTITION BY label, part ORDER BY vec_id)),
l2 AS (SELECT *, CASE WHEN m >= 1e-6 THEN sqrt(list_avg(list_transform(a, lambda x: (x - m) * (x - m)))) / m ELSE 0 END AS texture, CASE WHEN len(a) < 6 OR outer_ < 1e-6 THEN 1 ELSE inner_ / outer_ END AS darkness, CASE WHEN len(p) = len(q) THEN list_transform(list_zip(p, q), lambda z: abs(z[1] - z[2])) END AS d FROM l1)"""

_LINES = _LOOK + f""", br AS (SELECT label, part, i, n, unnest(range(len(p))) AS c, unnest(p) AS v FROM l2),
bc AS (SELECT * FROM br WHERE v > {LIMITS.bright}),
cand AS (SELECT a.label, a.part, a.c, any_value(a.n) AS n, count(DISTINCT b.i) AS k FROM (SELECT DISTINCT label, part, c, n FROM bc) a JOIN bc b ON a.label = b.label AND a.part = b.part AND abs(a.c - b.c) <= {LIMITS.tolerance} GROUP BY ALL),
li AS (SELECT label, part, count(*) AS lines, count(*) FILTER (k / n >= {LIMITS.persistence}) AS still FROM cand GROUP BY ALL),
fr AS (SELECT label, part, count(*) AS frames, avg(texture) AS texture, coalesce(avg(s), 0) AS displacement FROM (SELECT *, abs(centre - lag(centre) OVER (PARTITION BY label, part ORDER BY vec_id)) AS s FROM l2) GROUP BY ALL),
r0 AS (SELECT fr.*, coalesce(lines, 0) AS lines, coalesce(still, 0) AS still, CASE WHEN lines > 0 THEN still / lines ELSE 0 END AS line_ratio FROM fr LEFT JOIN li USING (label, part)),
rfl AS (SELECT label, part, frames, lines, still, line_ratio, displacement, frames >= 3 AND displacement <= {LIMITS.moving_edges} AND CASE WHEN texture < {LIMITS.uniform_texture} THEN still >= 1 ELSE line_ratio >= 0.8 AND still >= 1 AND (still >= 2 OR line_ratio > 0.7) END AS reflection,
  CASE WHEN frames >= 3 THEN least(1, line_ratio * still / greatest(lines, 1)) ELSE 0 END AS line_strength FROM r0)"""

_GAPS = f""", sl AS (SELECT *, unnest(range({SLICES})) AS s FROM l2),
ed AS (SELECT label, part, vec_id, i, s, list_sort(list_filter(list_transform(a[1 + s * w : (s + 1) * w], lambda x, k: {{'v': -x, 'k': -k}}), lambda e: -e.v > {LIMITS.edge_strength})) AS e FROM sl),
wd AS (SELECT *, CASE WHEN len(e) > 1 THEN abs(e[1].k - e[2].k) ELSE 0 END::DOUBLE AS g FROM ed),
sb AS (SELECT label, part, s, regr_slope(g, i) * count(*) / (count(*) - 1) AS b FROM wd GROUP BY ALL),
ss AS (SELECT label, part, stddev_pop(b) AS slice_spread FROM sb GROUP BY ALL),
wh AS (SELECT label, part, count(*) AS n, max(g) AS most, regr_slope(g, i) * count(*) / (count(*) - 1) AS b, avg(darkness) AS gap_darkness FROM (SELECT label, part, i, avg(g) AS g, any_value(darkness) AS darkness FROM wd JOIN l2 USING (label, part, vec_id, i) GROUP BY ALL) GROUP BY ALL),
w2 AS (SELECT label, part, n, slice_spread, gap_darkness, n >= 3 AND most >= {LIMITS.least_gap} AS ok, CASE WHEN n >= 3 AND most >= {LIMITS.least_gap} THEN b ELSE 0 END AS gap_slope FROM wh JOIN ss USING (label, part)),
gap AS (SELECT label, part, CASE WHEN n < 3 THEN 'STABLE' WHEN NOT ok THEN 'NO_GAP' WHEN gap_slope > {LIMITS.widening} AND slice_spread < abs(gap_slope) + {LIMITS.slack} THEN 'WIDENING' WHEN gap_darkness >= {LIMITS.dark} THEN 'NO_GAP' WHEN gap_slope < {LIMITS.narrowing} THEN 'NARROWING' ELSE 'STABLE' END AS gap_trend, gap_slope, slice_spread, gap_darkness FROM w2)"""

_MOVES = f""", dm AS (SELECT *, list_avg(d) AS dmean FROM l2),
dv AS (SELECT *, sqrt(list_avg(list_transform(d, lambda x: (x - dmean) * (x - dmean)))) / (dmean + 1e-6) AS cv FROM dm),
m0 AS (SELECT label, part, count(*) FILTER (dmean > {LIMITS.least_change}) AS changes, count(*) FILTER (dmean > {LIMITS.least_change} AND cv > {LIMITS.structured}) AS s, count(*) FILTER (dmean > {LIMITS.least_change} AND along) AS al FROM (SELECT *, centre > lag(centre) OVER (PARTITION BY label, part ORDER BY vec_id) AS along FROM dv) GROUP BY ALL),
mot AS (SELECT label, part, changes, CASE WHEN changes > 0 THEN s / changes ELSE 0 END AS structured_ratio, CASE WHEN changes > 0 THEN al / changes ELSE 0 END AS directed_ratio, changes >= 2 AND (s / greatest(changes, 1) > {LIMITS.moving_share} OR al / greatest(changes, 1) > {LIMITS.directed_share}) AS motion FROM m0)"""

_STEADY = f""", dr AS (SELECT label, part, any_value(n) AS n, coalesce(avg(CASE WHEN d IS NOT NULL THEN sqrt(list_sum(list_transform(d, lambda x: x * x))) END), 0) AS drift FROM l2 GROUP BY ALL),
cl AS (SELECT label, part, pow({LIMITS.decay}::DOUBLE, n - 1 - i) AS wt, unnest(range(len(p))) AS k, unnest(p) AS v FROM l2),
cm AS (SELECT *, sum(wt * v) OVER (PARTITION BY label, part, k) / sum(wt) OVER (PARTITION BY label, part, k) AS mu FROM cl),
cv AS (SELECT label, part, k, sum(wt * (v - mu) * (v - mu)) / sum(wt) AS s FROM cm GROUP BY ALL),
std AS (SELECT label, part, CASE WHEN any_value(n) < 3 THEN 0.5 ELSE 1 - least(1, sqrt(avg(s)) / (0.3::DOUBLE * sqrt(count(*)))) END AS steadiness, any_value(drift) AS drift FROM cv JOIN dr USING (label, part) GROUP BY ALL)"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"WITH {_LINES} SELECT label, part, frames, lines, still, round(line_ratio, 6) AS line_ratio, round(displacement, 6) AS displacement, reflection, round(line_strength, 6) AS line_strength FROM rfl")
def static_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bright columns that stay where they are through a window: are they a reflection?"""
    return _rounded(L.reflections(looks(spark, sf_dir), WINDOW, ["vec_id"], "profile", "texture", "centre", LIMITS), "line_ratio", "displacement", "line_strength")


@query(f"WITH {_LOOK}{_GAPS} SELECT label, part, gap_trend, round(gap_slope, 6) AS gap_slope, round(slice_spread, 6) AS slice_spread, round(gap_darkness, 6) AS gap_darkness FROM gap")
def gap_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gap between the strongest edges widens over a window, slice by slice."""
    out = L.gap_evolution(looks(spark, sf_dir), WINDOW, ["vec_id"], "widths", "darkness", LIMITS)
    # The slices of a single look have no slopes and no spread, which SQL shows as not a number.
    return _rounded(out.withColumn("slice_spread", F.coalesce("slice_spread", F.lit(float("nan")))), "gap_slope", "slice_spread", "gap_darkness")


@query(f"WITH {_LOOK}{_MOVES} SELECT label, part, changes, round(structured_ratio, 6) AS structured_ratio, round(directed_ratio, 6) AS directed_ratio, motion FROM mot")
def structured_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a window's looks change in places rather than all over."""
    return _rounded(L.structured_motion(looks(spark, sf_dir), WINDOW, ["vec_id"], "profile", "along", LIMITS), "structured_ratio", "directed_ratio")


@query(f"WITH {_LOOK}{_STEADY} SELECT label, part, round(steadiness, 6) AS steadiness, round(drift, 6) AS drift FROM std")
def look_steadiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How steady a window's looks are, later ones weighing more."""
    return _rounded(L.steadiness(looks(spark, sf_dir), WINDOW, ["vec_id"], "profile", LIMITS), "steadiness", "drift")


@query(f"""WITH {_LINES}{_GAPS}{_MOVES}{_STEADY},
ev AS (SELECT *, 0.5 + label / 20.0::DOUBLE AS conf, gap_trend = 'NO_GAP' AS gone, round(CASE WHEN reflection THEN 0.3 ELSE 0 END + CASE WHEN gap_trend IN ('NO_GAP', 'STABLE') THEN 0.25 ELSE 0 END + CASE WHEN NOT motion THEN 0.2 ELSE 0 END + CASE WHEN steadiness > {1 - LIMITS.steady} THEN 0.25 ELSE 0 END, 6)::DOUBLE AS s FROM rfl JOIN gap USING (label, part) JOIN mot USING (label, part) JOIN std USING (label, part)),
e2 AS (SELECT *, CASE WHEN s >= 0.7 THEN s WHEN reflection AND gone THEN greatest(s, 0.6) WHEN gone AND NOT motion THEN greatest(s, 0.5) ELSE s END AS strength, CASE WHEN frames < {LIMITS.least_frames} THEN 'NOT_READY' WHEN gap_trend = 'WIDENING' OR (motion AND NOT gone) OR steadiness < {LIMITS.steady} THEN 'CONFIRMED' WHEN s >= 0.7 OR (gone AND (reflection OR NOT motion)) THEN 'OVERRIDDEN' ELSE 'PASS_THROUGH' END AS decision FROM ev)
SELECT label, part, frames, reflection, gap_trend, motion, round(steadiness, 6) AS steadiness, strength, decision, round(CASE decision WHEN 'OVERRIDDEN' THEN greatest(0.1, conf - {LIMITS.most_reduction} * least(1, strength)) WHEN 'CONFIRMED' THEN least(1, conf + {LIMITS.boost}) ELSE conf END, 6) AS adjusted FROM e2""")
def look_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four analyses of a window, and what they make of the state that it was taken for."""
    rows, at = looks(spark, sf_dir), ["vec_id"]
    evidence = L.reflections(rows, WINDOW, at, "profile", "texture", "centre", LIMITS)
    for other in (L.gap_evolution(rows, WINDOW, at, "widths", "darkness", LIMITS), L.structured_motion(rows, WINDOW, at, "profile", "along", LIMITS), L.steadiness(rows, WINDOW, at, "profile", LIMITS)):
        evidence = evidence.join(other, WINDOW)
    judged = L.verify(evidence.withColumn("confidence", 0.5 + F.col("label") / 20), "confidence", LIMITS)
    return _rounded(judged.select(*WINDOW, "frames", "reflection", "gap_trend", "motion", "steadiness", "strength", "decision", "adjusted"), "steadiness", "adjusted")
