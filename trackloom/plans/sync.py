"""Named queries: order-preserving alignment, clock offsets, and the evidence of support cameras.

Times are seconds and tolerances powers of two, confidences 1024ths: costs are exact, so equal costs are ties in Spark and in SQL alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.operators import aggregates as A
from trackloom.operators import evidence, stateful
from trackloom.operators import reports as R
from trackloom.plans.stage import EV, events, query

ALIGN = stateful.AlignConfig(gate=32768.0, tolerance=32768.0)


def _roles(spark: SparkSession, sf_dir: str, *labels: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("label").isin(*labels)).select("sensor", "label", F.col("t").cast("double").alias("time"), (F.col("conf") / 1024).alias("confidence"), F.col("event_id").alias("key"))


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each sensor its purchases as the master sequence and its signups as the support."""
    return _roles(spark, sf_dir, "purchase", "signup").withColumn("side", F.when(F.col("label") == "purchase", "M").otherwise("S")).drop("label")


def align_sql(source: str, x: str = "") -> str:
    """CTEs of the alignment of ``source(g, side, tm, conf, key)``, cell by cell: ``cost{x}(g, cost)`` and ``pair{x}(g, mk, sk, mt, st)``.

    ``c`` walks the matrix of each group row by row with the row above; ``b`` walks back from the last cell.
    """
    return f"""src{x} AS MATERIALIZED (SELECT g, list({{'tm': tm::DOUBLE, 'c': conf::DOUBLE, 'k': key}} ORDER BY tm, key) FILTER (side = 'M') AS ms, list({{'tm': tm::DOUBLE, 'c': conf::DOUBLE, 'k': key}} ORDER BY tm, key) FILTER (side = 'S') AS ss FROM {source} GROUP BY g),
dim{x} AS MATERIALIZED (SELECT g, coalesce(ms, []) AS ms, coalesce(ss, []) AS ss, coalesce(len(ms), 0) AS n, coalesce(len(ss), 0) AS m FROM src{x}),
c{x}(g, k, above, row, v, op) AS (SELECT g, 0::BIGINT, list_transform(range(0, m + 1), lambda j: j::DOUBLE), [1.0::DOUBLE], NULL::DOUBLE, NULL::INT FROM dim{x} WHERE n > 0 AND m > 0
  UNION ALL SELECT g, k + 1, CASE WHEN j = m THEN list_append(row, least(a, b, p)) ELSE above END, CASE WHEN j = m THEN [(i + 1)::DOUBLE] ELSE list_append(row, least(a, b, p)) END, least(a, b, p), CASE WHEN p < a AND p < b THEN 2 WHEN b < a THEN 1 ELSE 0 END
  FROM (SELECT g, k, above, row, m, i, j, above[j + 1] + 1 AS a, row[j] + 1 AS b, CASE WHEN d <= {ALIGN.gate} THEN above[j] + d / {ALIGN.tolerance} * (1 + 0.25::DOUBLE * greatest(0, 1 - (ms[i].c + ss[j].c) / 2)) ELSE 'infinity'::DOUBLE END AS p
    FROM (SELECT c.*, dim.ms, dim.ss, dim.m, c.k // dim.m + 1 AS i, c.k % dim.m + 1 AS j, abs(dim.ms[c.k // dim.m + 1].tm - dim.ss[c.k % dim.m + 1].tm) AS d FROM c{x} c JOIN dim{x} dim ON dim.g = c.g WHERE c.k < dim.n * dim.m))),
cell{x} AS MATERIALIZED (SELECT g, k, v, op FROM c{x} WHERE k > 0),
b{x}(g, i, j, op) AS (SELECT g, n, m, NULL::INT FROM dim{x} WHERE n > 0 AND m > 0
  UNION ALL SELECT b.g, b.i - (cell.op <> 1)::INT, b.j - (cell.op <> 0)::INT, cell.op FROM b{x} b JOIN dim{x} dim ON dim.g = b.g JOIN cell{x} cell ON cell.g = b.g AND cell.k = (b.i - 1) * dim.m + b.j WHERE b.i > 0 AND b.j > 0),
pair{x} AS MATERIALIZED (SELECT b.g, ms[i + 1].k AS mk, ss[j + 1].k AS sk, ms[i + 1].tm AS mt, ss[j + 1].tm AS st FROM b{x} b JOIN dim{x} dim ON dim.g = b.g WHERE op = 2),
cost{x} AS (SELECT g, n, m, coalesce(v, n + m)::DOUBLE AS cost FROM dim{x} LEFT JOIN cell{x} cell USING (g) WHERE v IS NULL OR k = n * m)"""


_SIDES = EV + ", sides AS (SELECT sensor AS g, CASE label WHEN 'purchase' THEN 'M' ELSE 'S' END AS side, t AS tm, conf / 1024::DOUBLE AS conf, event_id AS key FROM ev WHERE label IN ('purchase', 'signup'))"


@query(f"""WITH RECURSIVE {_SIDES}, {align_sql("sides")}
SELECT g AS sensor, 'MATCH' AS op, mk AS master_key, sk AS support_key, st - mt AS residual FROM pair
UNION ALL SELECT g, CASE side WHEN 'M' THEN 'MISSING' ELSE 'EXTRA' END, CASE side WHEN 'M' THEN key END, CASE side WHEN 'S' THEN key END, NULL FROM sides WHERE key NOT IN (SELECT mk FROM pair UNION ALL SELECT sk FROM pair)""")
def sequence_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.align(_sides(spark, sf_dir), ["sensor"], ALIGN)


def _curve_sql(x: str) -> str:
    """``curve{x}(g, score, n_match, ...)`` of a source whose ``g`` is (sensor, offset); the supports' own spacings do not depend on the shift."""
    return f"""step{x} AS (SELECT g, mt - lag(mt) OVER w AS dm, st - lag(st) OVER w AS ds FROM pair{x} WINDOW w AS (PARTITION BY g ORDER BY mt, mk)),
pen{x} AS (SELECT g, count(*) AS n_match, coalesce(sum(CASE WHEN dm > 0 AND ds > 0 THEN abs(dm - ds) / greatest(dm, ds) END), 0) AS pen FROM step{x} GROUP BY g),
curve{x} AS (SELECT g, g.sensor AS sensor, g.offset AS "offset", round(cost + coalesce(pen, 0), 6) AS score, coalesce(n_match, 0) AS n_match, n - coalesce(n_match, 0) AS n_missing, m - coalesce(n_match, 0) AS n_extra FROM cost{x} LEFT JOIN pen{x} USING (g))"""


_SHIFTED = "{{'sensor': g, 'offset': {o}}} AS g, side, tm + CASE side WHEN 'S' THEN {o} ELSE 0 END AS tm, conf, key"
_SWEEP = f"""{_SIDES}, swept AS (SELECT {_SHIFTED.format(o="(h * 3600)::DOUBLE")} FROM sides, (SELECT unnest(range(-8, 9)) AS h)), {align_sql("swept", "_s")}, {_curve_sql("_s")},
best AS (SELECT sensor, "offset", score, n_match, n_missing, n_extra, lead(score) OVER w - score AS margin FROM curve_s WINDOW w AS (PARTITION BY sensor ORDER BY score, abs("offset"), "offset") QUALIFY row_number() OVER w = 1)"""


def _scored(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


@query(f"WITH RECURSIVE {_SWEEP} SELECT * REPLACE (round(margin, 6) AS margin) FROM best")
def offset_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of 17 candidate offsets of each sensor, by score and then by the least shift, and the runner-up's margin."""
    rows = _sides(spark, sf_dir).withColumn("offset", F.explode(F.sequence(F.lit(-8), F.lit(8)))).withColumn("offset", F.col("offset") * 3600.0)
    curve = _scored(stateful.offset_curve(rows, ["sensor"], "offset", ALIGN))
    by = Window.partitionBy("sensor").orderBy("score", F.abs("offset"), "offset")
    return curve.withColumn("rank", F.row_number().over(by)).withColumn("margin", F.round(F.lead("score").over(by) - F.col("score"), 6)).where("rank = 1").drop("rank")


@query(f"""WITH RECURSIVE {_SWEEP},
spacing AS (SELECT g AS sensor, median(d) AS spacing FROM (SELECT g, tm - lag(tm) OVER (PARTITION BY g ORDER BY tm) AS d FROM sides WHERE side = 'M') WHERE d > 0 GROUP BY g),
shift AS (SELECT sensor, k, "offset" + k * spacing AS o FROM best JOIN spacing USING (sensor), (SELECT unnest([-1, 0, 1]) AS k)),
moved AS (SELECT {_SHIFTED.format(o="o")} FROM sides JOIN shift ON shift.sensor = sides.g), {align_sql("moved", "_a")}, {_curve_sql("_a")}
SELECT sensor, k, "offset", score, n_match, row_number() OVER (PARTITION BY sensor ORDER BY score, abs(k), k) AS place FROM curve_a JOIN shift ON shift.sensor = curve_a.sensor AND o = "offset\"""".replace("SELECT sensor, k, \"offset\", score", "SELECT curve_a.sensor, k, \"offset\", score").replace("PARTITION BY sensor ORDER BY score, abs(k), k", "PARTITION BY curve_a.sensor ORDER BY score, abs(k), k"))
def alias_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best offset of the sweep against itself shifted by one unit's spacing either way: a camera may be off by exactly one."""
    sides, best = _sides(spark, sf_dir), offset_sweep(spark, sf_dir).select("sensor", F.col("offset").alias("base"))
    period = A.median_spacing(sides.where("side = 'M'"), ["sensor"], "time").where("spacing > 0")
    shifts = best.join(period, "sensor").select("sensor", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("k"), (F.col("base") + F.col("k") * F.col("spacing")).alias("offset"))
    curve = _scored(stateful.offset_curve(sides.join(shifts.select("sensor", "offset").distinct(), "sensor"), ["sensor"], "offset", ALIGN)).join(shifts, ["sensor", "offset"])
    place = F.row_number().over(Window.partitionBy("sensor").orderBy("score", F.abs("k"), "k"))
    return curve.select("sensor", "k", "offset", "score", "n_match", place.alias("place"))


@query(f"""WITH RECURSIVE {_SWEEP} SELECT sensor, CASE WHEN margin / greatest(abs(score), abs(score + margin), 1) >= 0.03 AND n_match >= ceil(0.3::DOUBLE * (n_match + least(n_missing, n_extra))) THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS status,
  CASE WHEN margin / greatest(abs(score), abs(score + margin), 1) >= 0.03 AND n_match >= ceil(0.3::DOUBLE * (n_match + least(n_missing, n_extra))) THEN "offset" ELSE 0 END AS delta FROM best""")
def usable_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's offsets where they are decided: enough matches, and by three hundredths better than the runner-up. Others are 0, never guessed."""
    rival = F.col("score") + F.col("margin")
    sure = (F.col("margin") / F.greatest(F.abs("score"), F.abs(rival), F.lit(1.0)) >= 0.03) & (F.col("n_match") >= F.ceil(0.3 * (F.col("n_match") + F.least("n_missing", "n_extra"))))
    status = F.when(sure, "RESOLVED").otherwise("UNRESOLVED")
    return offset_sweep(spark, sf_dir).select("sensor", status.alias("status"), R.usable_offset(F.col("offset"), status).alias("delta"))


#: The support cameras of a sensor and how far their clocks are behind the master's, in seconds.
DELTAS = {"signup": 7200.0, "click": -3600.0, "view": 0.0}


def _cameras(supports: DataFrame) -> DataFrame:
    """A camera's footage reaches from its first to its last row, in frames of 64 seconds. With under ten rows its clock is not trusted, with
    under six its rate is not known."""
    c = supports.groupBy("sensor", "camera").agg(F.count("*").alias("n"), F.min("time").alias("t0"), (F.floor((F.max("time") - F.min("time")) / 64) + 1).alias("total_frames"))
    delta = F.element_at(F.create_map(*[F.lit(v) for pair in DELTAS.items() for v in pair]), F.col("camera"))
    return c.select("sensor", "camera", delta.alias("delta"), F.when(F.col("n") >= 10, "RESOLVED").otherwise("UNRESOLVED").alias("status"), F.when(F.col("n") >= 6, 1 / 64).otherwise(0.0).alias("fps"), "t0", "total_frames")


def _attached(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    masters = _roles(spark, sf_dir, "purchase").drop("label")
    supports = _roles(spark, sf_dir, *DELTAS).withColumnRenamed("label", "camera")
    return masters, supports, evidence.attach(masters, supports, _cameras(supports), ["sensor"], "camera", ALIGN)


_ATTACH = EV + f""",
ma AS (SELECT sensor, event_id AS key, t, conf / 1024::DOUBLE AS conf FROM ev WHERE label = 'purchase'),
su AS (SELECT sensor, label AS camera, event_id AS key, t, conf / 1024::DOUBLE AS conf FROM ev WHERE label IN ('signup', 'click', 'view')),
cam AS (SELECT sensor, camera, count(*) AS n, CASE camera WHEN 'signup' THEN 7200 WHEN 'click' THEN -3600 ELSE 0 END AS delta, min(t) AS t0, (max(t) - min(t)) // 64 + 1 AS total FROM su GROUP BY ALL),
both_ AS (SELECT {{'sensor': sensor, 'camera': camera}} AS g, 'M' AS side, t AS tm, conf, key FROM ma JOIN cam USING (sensor) WHERE n >= 10 UNION ALL SELECT {{'sensor': sensor, 'camera': camera}}, 'S', t + delta, conf, key FROM su JOIN cam USING (sensor, camera) WHERE n >= 10),
{align_sql("both_", "_e")},
att AS (SELECT g.sensor AS sensor, g.camera AS camera, mk AS master_key, 'MATCH' AS op, NULL AS reason, sk AS support_key, st - mt AS residual FROM pair_e
  UNION ALL SELECT sensor, camera, key, CASE WHEN inside THEN 'MISSING' ELSE 'OUT_OF_RANGE' END, CASE WHEN NOT inside THEN 'OUT_OF_RANGE' END, NULL, NULL FROM (SELECT ma.sensor, cam.camera, ma.key, round((t - delta - t0) / 64.0::DOUBLE) BETWEEN 0 AND total - 1 AS inside FROM ma JOIN cam USING (sensor) WHERE n >= 10 AND NOT EXISTS (SELECT 1 FROM pair_e WHERE mk = ma.key AND pair_e.g.camera = cam.camera))
  UNION ALL SELECT sensor, camera, NULL, 'EXTRA', CASE WHEN n < 6 THEN 'NO_METADATA' WHEN n < 10 THEN 'OFFSET_UNRESOLVED' END, key, NULL FROM su JOIN cam USING (sensor, camera) WHERE key NOT IN (SELECT sk FROM pair_e)
  UNION ALL SELECT ma.sensor, cam.camera, ma.key, 'UNAVAILABLE', CASE WHEN n < 6 THEN 'NO_METADATA' ELSE 'OFFSET_UNRESOLVED' END, NULL, NULL FROM ma JOIN cam USING (sensor) WHERE n < 10)"""


@query(f"WITH RECURSIVE {_ATTACH} SELECT * FROM att")
def evidence_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each support camera of a sensor says about every purchase, and the sightings that belong to none."""
    return _attached(spark, sf_dir)[2]


@query(f"""WITH RECURSIVE {_ATTACH}, w AS (SELECT key, 0.0::DOUBLE AS r, conf, 0 AS s FROM ma UNION ALL SELECT master_key, residual, su.conf, 1 FROM att JOIN su ON su.key = support_key AND op = 'MATCH')
SELECT ma.sensor, ma.key, sum(s)::BIGINT AS n_support, round(any_value(t) + sum(r * w.conf) / nullif(sum(w.conf), 0), 3) AS weighted_time FROM ma JOIN w ON w.key = ma.key GROUP BY ALL""")
def evidence_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.evidence_times(*_attached(spark, sf_dir), ["sensor"]).withColumn("weighted_time", F.round("weighted_time", 3))


@query(f"WITH RECURSIVE {_ATTACH} SELECT camera, count(*) FILTER (op = 'MATCH') AS matched, count(*) FILTER (op = 'MISSING') AS missing, count(*) FILTER (op = 'OUT_OF_RANGE') AS out_of_range, count(*) FILTER (op = 'UNAVAILABLE') AS unavailable, count(*) FILTER (op = 'EXTRA') AS extra, max(abs(residual)) AS worst FROM att GROUP BY camera")
def evidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = {"MATCH": "matched", "MISSING": "missing", "OUT_OF_RANGE": "out_of_range", "UNAVAILABLE": "unavailable", "EXTRA": "extra"}
    return _attached(spark, sf_dir)[2].groupBy("camera").agg(*[F.count_if(F.col("op") == k).alias(v) for k, v in ops.items()], F.max(F.abs("residual")).alias("worst"))


#: A unit of the search is three hours, so that a sensor's next purchase is within its reach.
UNIT = 10_800


@query()
def camera_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the clock of a second camera is off, whether that is certain, and what may be used.

    The second camera sees the confident purchases of each sensor, some minutes late and on a clock of its own, and takes some signups for purchases.
    """
    e = events(spark, sf_dir).select("sensor", "label", F.col("event_id").alias("key"), (F.col("t") / UNIT).alias("time"), (F.col("conf") / 1000).alias("confidence"), "conf")
    clock = F.col("sensor") * 7 % 41 - 20 + (F.col("conf") % 7 - 3) / 10
    supports = e.where("(label = 'purchase' AND conf >= sensor % 8 * 120) OR (label = 'signup' AND conf < sensor % 8 * 60)").select("sensor", F.lit("second").alias("camera"), "key", (F.col("time") + clock).alias("time"), "confidence")
    return evidence.estimate_offsets(e.where("label = 'purchase'").drop("label", "conf"), supports, ["sensor"], cfg=evidence.OffsetConfig(fine_step=1 / 16)).drop("camera")
