"""Named queries: boundaries that supports alone have seen go into the master's order, and the units and invariants of the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators import fusion, invariants
from trackloom.plans.relational import _QUORUM, cluster_quorum
from trackloom.plans.stage import BATCH, EV, SESS, events, query, tracks

_FUSED = _QUORUM + f""", mm AS (SELECT DISTINCT batch, t AS m FROM ev WHERE label = 'purchase'),
cen AS (SELECT batch, cluster, avg(t) AS center FROM cl GROUP BY ALL HAVING count(DISTINCT camera) >= 2 AND max(t) - min(t) <= 1200 AND avg(conf) >= 150),
qu AS (SELECT batch, cluster, floor(center / 60)::BIGINT - batch * {BATCH} AS frame FROM cen WHERE NOT EXISTS (SELECT 1 FROM mm WHERE mm.batch = cen.batch AND abs(center - mm.m) < 120)),
bd AS (SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY frame, late, key) AS number, key, source, frame FROM (
  SELECT batch, event_id AS key, 'master' AS source, frame - batch * {BATCH} AS frame, 1 AS late FROM ev WHERE label = 'purchase'
  UNION ALL SELECT batch, -row_number() OVER (PARTITION BY batch ORDER BY frame, cluster), 'fused', frame, 0 FROM qu))"""


def fused_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchases of a batch and the clusters that enough cameras saw beside them, in minutes of the batch."""
    masters = events(spark, sf_dir).where("label = 'purchase'").select("batch", F.col("event_id").alias("key"), (F.col("frame") - F.col("batch") * BATCH).alias("frame"))
    clusters = cluster_quorum(spark, sf_dir).select("batch", "cluster", (F.floor(F.col("center") / 60) - F.col("batch") * BATCH).alias("frame"))
    return fusion.insert_boundaries(masters, clusters, ["batch"], 240)


@query(f"WITH RECURSIVE {_FUSED} SELECT * FROM bd")
def inserted_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fused_boundaries(spark, sf_dir)


#: The sessions without the events, which are there already.
_SESS = SESS.removeprefix(EV).lstrip(", \n")
_LABELS = f"""trk AS (SELECT camera, sensor, track_id, min(frame) AS s, max(frame) AS e, count(*) AS hits FROM sess GROUP BY ALL),
lab AS (SELECT batch, greatest(s - batch * {BATCH}, 0) AS s, least(e - batch * {BATCH}, {BATCH - 1}) AS e, 'L' || sensor AS label, track_id FROM (SELECT *, unnest(range(s // {BATCH}, e // {BATCH} + 1)) AS batch FROM trk WHERE hits >= 9))"""


@query(f"""WITH RECURSIVE {_FUSED}, {_SESS}, {_LABELS},
cutp AS (SELECT batch, least(greatest(frame, 0), {BATCH - 1}) AS frame, number, key, source FROM bd),
edge AS (SELECT DISTINCT batch, frame FROM cutp WHERE frame > 0 UNION SELECT DISTINCT batch, 0 FROM ev),
un AS (SELECT batch, row_number() OVER w AS unit, frame AS start_frame, coalesce(lead(frame) OVER w, {BATCH}) - 1 AS end_frame FROM edge WINDOW w AS (PARTITION BY batch ORDER BY frame)),
mid AS (SELECT *, (start_frame + end_frame) // 2 AS m FROM un),
ins AS (SELECT mid.batch, unit, arg_min(label, (s, e, label)) AS label FROM mid JOIN lab ON lab.batch = mid.batch AND m BETWEEN s AND e GROUP BY ALL),
bef AS (SELECT mid.batch, unit, max(e) AS e, arg_max(label, (e, -s, label)) AS label FROM mid JOIN lab ON lab.batch = mid.batch AND e < m GROUP BY ALL),
aft AS (SELECT mid.batch, unit, min(s) AS s, arg_min(label, (s, e, label)) AS label FROM mid JOIN lab ON lab.batch = mid.batch AND s > m GROUP BY ALL),
le AS (SELECT un.batch, unit, arg_max(key, number) AS "leading", arg_max(source, number) AS leading_source FROM un JOIN cutp ON cutp.batch = un.batch AND frame <= start_frame GROUP BY ALL),
tr AS (SELECT un.batch, unit, arg_min(key, number) AS "trailing", arg_min(source, number) AS trailing_source FROM un JOIN cutp ON cutp.batch = un.batch AND frame > end_frame GROUP BY ALL)
SELECT batch, unit, start_frame, end_frame, coalesce(ins.label, CASE WHEN aft.s - m < m - bef.e OR bef.e IS NULL THEN aft.label ELSE bef.label END, 'UNKNOWN') AS label,
  CASE WHEN ins.label IS NOT NULL THEN 'inside' WHEN bef.e IS NULL AND aft.s IS NULL THEN 'none' ELSE 'nearest' END AS how, "leading", leading_source, "trailing", trailing_source
FROM mid LEFT JOIN ins USING (batch, unit) LEFT JOIN bef USING (batch, unit) LEFT JOIN aft USING (batch, unit) LEFT JOIN le USING (batch, unit) LEFT JOIN tr USING (batch, unit)""")
def fused_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's units between all boundaries, named by the long track that is seen at their middle, or nearest to it."""
    t = tracks(spark, sf_dir).where("hits >= 9").withColumn("batch", F.explode(F.sequence(F.floor(F.col("start_frame") / BATCH), F.floor(F.col("end_frame") / BATCH))))
    inside = lambda c: F.col(c) - F.col("batch") * BATCH
    labels = t.select("batch", F.greatest(inside("start_frame"), F.lit(0)).alias("start"), F.least(inside("end_frame"), F.lit(BATCH - 1)).alias("end"), F.concat(F.lit("L"), F.col("sensor").cast("string")).alias("label"))
    spans = events(spark, sf_dir).select("batch").distinct().withColumn("total_frames", F.lit(BATCH))
    return fusion.fused_units(fused_boundaries(spark, sf_dir), labels, spans, ["batch"])


@query(f"""WITH RECURSIVE {_FUSED}, g AS (SELECT bd.*, row_number() OVER (PARTITION BY batch ORDER BY number) AS no, count(*) OVER (PARTITION BY batch) AS n, lag(frame) OVER (PARTITION BY batch ORDER BY number) AS f0 FROM bd),
ma AS (SELECT batch, count(*) AS masters FROM ev WHERE label = 'purchase' AND conf >= 20 GROUP BY batch), j AS (SELECT g.*, coalesce(masters, 0) AS masters, batch || ':' || number AS name FROM g LEFT JOIN ma USING (batch)),
b AS (SELECT name, no = 1 AND n <> masters AS GAP_COUNT, key < 0 AS GAP_WITHOUT_MASTER, key >= 0 AND source <> 'master' AS GAP_OF_ANOTHER_CAMERA, source = 'fused' AS SUPPORT_AS_MASTER, number <> no AS GAP_IDS, frame < f0 AS GAP_ORDER FROM j)
SELECT 'gaps' AS "table", c AS "check", count(*) FILTER (v) AS broken, min(name) FILTER (v) AS example FROM (SELECT name, unnest(['GAP_COUNT', 'GAP_WITHOUT_MASTER', 'GAP_OF_ANOTHER_CAMERA', 'SUPPORT_AS_MASTER', 'GAP_IDS', 'GAP_ORDER']) AS c, unnest([GAP_COUNT, GAP_WITHOUT_MASTER, GAP_OF_ANOTHER_CAMERA, SUPPORT_AS_MASTER, GAP_IDS, coalesce(GAP_ORDER, false)]) AS v FROM b) GROUP BY c""")
def fusion_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fixed-master rule says about the boundaries with the inserted ones among them: these have no master, and the counts differ."""
    masters = events(spark, sf_dir).where("label = 'purchase' AND conf >= 20").select("batch", F.col("event_id").alias("key"))
    gaps = fused_boundaries(spark, sf_dir).select("batch", F.col("number").alias("gap_id"), F.col("source").alias("camera"), F.when(F.col("key") >= 0, F.col("key")).alias("key"), "frame")
    return invariants.gap_checks(gaps, masters, ["batch"], "master", ["fused"]).report()
