"""Named queries: operators over ordered rows, and grouped folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.operators import aggregates as A
from trackloom.operators import fuse, graph, joins, stateful, validate
from trackloom.operators import windows as W
from trackloom.plans.stage import BATCH, EV, SESS, SPANS, TRK, events, query, sessions, tracks

#: A camera's rows are judged batch by batch.
GROUP = ["batch", "camera"]
ROLES = {"view": "WAGON", "click": "WAGON", "signup": "ENGINE", "purchase": "BRAKE_VAN"}
_ROLE = "CASE label WHEN 'view' THEN 'WAGON' WHEN 'click' THEN 'WAGON' WHEN 'signup' THEN 'ENGINE' WHEN 'purchase' THEN 'BRAKE_VAN' ELSE 'UNKNOWN' END"


def role(label: str = "label"):
    out = F.lit("UNKNOWN")
    for k, v in ROLES.items():
        out = F.when(F.col(label) == k, v).otherwise(out)
    return out


def placed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sensor's segments between its purchases, with the frame ``f0`` in which its footage begins."""
    return W.footage_segments(events(spark, sf_dir), "sensor", "frame", F.col("label") == "purchase")


def boundary_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_segments(spark, sf_dir).drop("f0")


SEG = EV + ", " + SPANS + """,
cut AS (SELECT DISTINCT sensor, least(greatest(frame - f0, 0), total_frames - 1) AS start_frame, total_frames FROM ev JOIN spans USING (sensor) WHERE label = 'purchase'),
st AS (SELECT * FROM cut WHERE start_frame > 0 UNION SELECT sensor, 0, total_frames FROM spans),
seg AS (SELECT sensor, row_number() OVER (PARTITION BY sensor ORDER BY start_frame) - 1 AS segment_index, start_frame, coalesce(lead(start_frame) OVER (PARTITION BY sensor ORDER BY start_frame), total_frames) - 1 AS end_frame FROM st)"""


@query(f"WITH {SEG} SELECT * FROM seg")
def segments_from_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary_segments(spark, sf_dir)


@query(f"""WITH {EV}, o AS (SELECT sensor, {_ROLE} AS role, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS n FROM ev),
f AS (SELECT *, min(CASE WHEN role = 'WAGON' THEN n END) OVER (PARTITION BY sensor) AS a, max(CASE WHEN role = 'WAGON' THEN n END) OVER (PARTITION BY sensor) AS b FROM o)
SELECT sensor, count(*) AS total, count(*) FILTER (n < a) AS leading, count(*) FILTER (n > b) AS trailing, count(*) FILTER (n BETWEEN a AND b) AS units, count(*) FILTER (n BETWEEN a AND b AND role <> 'WAGON') AS interior_other, count(*) FILTER (role = 'ENGINE') AS engines FROM f GROUP BY sensor""")
def wagon_window_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("sensor").orderBy("t", "event_id")
    rows = events(spark, sf_dir).select("sensor", role().alias("role"), F.row_number().over(w).alias("n"))
    at = F.col("position")
    tests = {"leading": at == "LEADING", "trailing": at == "TRAILING", "units": at == "INTERIOR", "interior_other": (at == "INTERIOR") & (F.col("role") != "WAGON"), "engines": F.col("role") == "ENGINE"}
    return fuse.conditional_counts(W.active_window(rows, ["sensor"], "n", "role"), ["sensor"], tests)


_ISL = EV + """, c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR label IS DISTINCT FROM lag(label) OVER w THEN 1 ELSE 0 END AS ch FROM ev WINDOW w AS (PARTITION BY sensor ORDER BY t, event_id)),
isl AS (SELECT *, sum(ch) OVER (PARTITION BY sensor ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM c)"""


@query(f"WITH {_ISL} SELECT sensor, island, label, min(t) AS first_t, max(t) AS last_t, count(*) AS n, avg(conf) AS mean_conf FROM isl GROUP BY ALL")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.islands(events(spark, sf_dir), ["sensor"], ["t", "event_id"], "label")
    return rows.groupBy("sensor", "island", "label").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("n"), F.avg("conf").alias("mean_conf"))


@query(f"WITH {_ISL} SELECT event_id, island, sum(conf) OVER (PARTITION BY sensor, island ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run_duration FROM isl")
def stable_run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.stable_run(events(spark, sf_dir), ["sensor"], ["t", "event_id"], "label", "conf").select("event_id", "island", "run_duration")


@query(f"WITH {SESS}, g AS (SELECT track_id, frame - lag(frame) OVER (PARTITION BY track_id ORDER BY frame) - 1 AS d FROM sess) SELECT track_id, greatest(coalesce(max(d), 0), 0) AS max_missed FROM g GROUP BY track_id")
def missed_run_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.missed_run_max(sessions(spark, sf_dir), ["track_id"], "frame")


@query(f"WITH {TRK} SELECT batch, camera, track_id AS original_id, row_number() OVER (PARTITION BY batch, camera ORDER BY start_frame + end_frame, track_id) AS new_id FROM trk")
def rank_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tracks(spark, sf_dir).withColumn("centre", F.col("start_frame") + F.col("end_frame"))
    return W.renumber(rows, GROUP, ["centre", "track_id"], "new_id").select(*GROUP, F.col("track_id").alias("original_id"), "new_id")


@query(f"""WITH {TRK}, p AS (SELECT track_id, start_frame, end_frame, unnest([0.2, 0.4, 0.6, 0.8])::DOUBLE AS percent FROM trk),
q AS (SELECT track_id, percent, least(greatest(start_frame + round_even(percent * (end_frame - start_frame), 0)::BIGINT, start_frame), end_frame) AS frame FROM p)
SELECT track_id, percent, frame, row_number() OVER (PARTITION BY track_id, frame ORDER BY percent) = 1 AS available FROM q""")
def percent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.percent_positions(tracks(spark, sf_dir), ["track_id"], "start_frame", "end_frame")


@query(f"WITH {TRK}, p AS (SELECT track_id, start_frame, end_frame, unnest([0.125, 0.375, 0.625, 0.875])::DOUBLE AS percent FROM trk), q AS (SELECT track_id, percent, least(greatest(start_frame + round_even(percent * (end_frame - start_frame), 0)::BIGINT, start_frame), end_frame) AS frame FROM p) SELECT track_id, percent, frame, row_number() OVER (PARTITION BY track_id, frame ORDER BY percent) = 1 AS available FROM q")
def quartile_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.percent_positions(tracks(spark, sf_dir), ["track_id"], "start_frame", "end_frame", (0.125, 0.375, 0.625, 0.875))


@query(f"""WITH {EV}, r AS (SELECT event_id, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY sensor) AS n FROM ev),
k AS (SELECT *, least(greatest(floor(n * 0.05::DOUBLE), 3), 12)::BIGINT AS k0 FROM r), q AS (SELECT event_id, i, n, CASE WHEN n <= 2 * k0 THEN 0 ELSE k0 END AS k FROM k)
SELECT event_id FROM q WHERE i >= k AND i < n - k AND (i - k) % 3 = 0""")
def every_nth_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.stable_interior(events(spark, sf_dir), ["sensor"], ["t", "event_id"], nth=3).select("event_id")


@query(f"""WITH {EV}, r AS (SELECT event_id, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY sensor) AS n FROM ev)
SELECT event_id FROM r WHERE n <= 7 OR list_contains(list_transform(range(0, 7), lambda j: round_even(j * (n - 1)::DOUBLE / 6, 0)::BIGINT), i)""")
def even_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.even_subsample(events(spark, sf_dir), ["sensor"], ["t", "event_id"], 7).select("event_id")


@query(f"""WITH {TRK}, v AS (SELECT batch, camera, track_id, start_frame, abs(x_end - x_start) AS v FROM trk),
m AS (SELECT *, CASE WHEN v > 0 THEN v::DOUBLE END AS pv FROM v),
l AS (SELECT *, median(pv) OVER w AS med, count(pv) OVER w AS c, median(pv) OVER (PARTITION BY batch, camera) AS allv FROM m WINDOW w AS (PARTITION BY batch, camera ORDER BY start_frame, track_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING EXCLUDE CURRENT ROW))
SELECT batch, camera, track_id, CASE WHEN c >= 2 THEN med ELSE allv END AS reference, CASE WHEN c >= 2 THEN 'local' ELSE 'global' END AS reference_kind FROM l""")
def local_median_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tracks(spark, sf_dir).withColumn("v", F.abs(F.col("x_end") - F.col("x_start")))
    return W.local_median(rows, GROUP, ["start_frame", "track_id"], "v").select(*GROUP, "track_id", "reference", "reference_kind")


@query(f"""WITH {EV}, d AS (SELECT DISTINCT sensor, t FROM ev), i AS (SELECT sensor, t AS s, lead(t) OVER (PARTITION BY sensor ORDER BY t) AS e FROM d),
j AS (SELECT *, e - s AS len, median(e - s) OVER (PARTITION BY sensor ORDER BY s ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS base FROM i WHERE e IS NOT NULL), k AS (SELECT *, len / base AS ratio FROM j)
SELECT sensor, s AS "start", e AS "end", len AS "interval", base, ratio, CASE WHEN ratio <= 0.5 THEN 'SUSPICIOUSLY_SHORT' ELSE 'POSSIBLE_MISSING_GAP' END AS flag, CASE WHEN ratio >= 1.6 THEN greatest(1, round_even(ratio, 0)::BIGINT - 1) ELSE 0 END AS implied_missing FROM k WHERE ratio <= 0.5 OR ratio >= 1.6""")
def interval_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.interval_diagnostics(events(spark, sf_dir).select("sensor", "t").distinct(), ["sensor"], "t")


_HITS = SESS + """,
hit AS (SELECT camera, track_id, frame, min(x) AS x, max(conf) AS conf FROM sess GROUP BY ALL)"""
_FEAT = _HITS + """,
step AS (SELECT *, frame - lag(frame) OVER w AS df, x - lag(x) OVER w AS dx FROM hit WINDOW w AS (PARTITION BY camera, track_id ORDER BY frame)),
agg AS (SELECT camera, track_id, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS hits, greatest(coalesce(max(df - 1), 0), 0) AS max_missed, arg_min(x, frame) AS x_start, arg_max(x, frame) AS x_end, coalesce(sum(abs(dx)), 0)::BIGINT AS path,
  count(df) AS n_steps, count(*) FILTER (dx > 0) AS n_pos, count(*) FILTER (dx < 0) AS n_neg, median(dx / (df / 1.0::DOUBLE)) AS step_speed, avg(conf) AS confidence FROM step GROUP BY ALL HAVING count(*) >= 2),
feat AS (SELECT camera, start_frame // 1440 AS batch, track_id, start_frame, end_frame, hits, end_frame - start_frame + 1 AS track_frames, max_missed, least(1.0, hits::DOUBLE / (end_frame - start_frame + 1)) AS coverage, x_start, x_end - x_start AS displacement,
  CASE WHEN path > 0 THEN abs(x_end - x_start)::DOUBLE / path ELSE 0 END AS path_efficiency, abs(x_end - x_start) / ((end_frame - start_frame + 1) / 1.0::DOUBLE) AS speed, n_steps, CASE WHEN n_pos > n_neg THEN 1 WHEN n_neg > n_pos THEN -1 ELSE 0 END AS direction,
  CASE WHEN n_steps > 0 THEN greatest(n_pos, n_neg)::DOUBLE / n_steps ELSE 0 END AS monotonic, step_speed, confidence FROM agg)"""


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a frame of a track. The sensor, which a track has one of, stays in the key: sessions are parted by it already."""
    return sessions(spark, sf_dir).groupBy("sensor", "camera", "track_id", "frame").agg(F.min("x").alias("x"), F.max("conf").alias("conf"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).drop("sensor")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.motion_features(_hits(spark, sf_dir), ["sensor", "camera", "track_id"], "frame", "x", 1.0, confidence=F.avg("conf"), min_confidence=F.min("conf"))
    return rows.drop("sensor").withColumn("batch", F.floor(F.col("start_frame") / BATCH))


@query(f"WITH {_FEAT} SELECT * FROM feat")
def motion_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).drop("min_confidence")


LIMITS = validate.Limits(min_track_frames=30, min_hits=3, max_missed=600, min_coverage=0.001, min_confidence=180.0, static_motion=20.0, min_motion=60.0, min_speed=0.05, max_speed=20.0, min_monotonic=0.55, stopped_fraction=0.2, speed_band=4.0, recover_confidence=150.0)
_PAUSE = _FEAT + """,
med AS (SELECT *, median(CASE WHEN speed > 0 THEN speed END) OVER (PARTITION BY batch, camera) AS m FROM feat),
stall AS (SELECT batch, camera, track_id, start_frame, end_frame FROM med WHERE speed <= m * 0.2),
tog AS (SELECT a.batch, a.camera, a.track_id, count(*) AS together FROM stall a JOIN stall b ON a.batch = b.batch AND a.camera = b.camera AND a.start_frame <= b.end_frame AND b.start_frame <= a.end_frame GROUP BY ALL HAVING count(*) >= 2)"""
_CASC = _PAUSE + """,
r1 AS (SELECT f.*, tog.track_id IS NOT NULL AS paused, CASE WHEN track_frames < 30 OR hits < 3 THEN 'TOO_SHORT' WHEN max_missed > 600 OR coverage < 0.001 THEN 'DETECTION_GAP' WHEN confidence < 180 THEN 'LOW_CONFIDENCE' WHEN tog.track_id IS NOT NULL THEN NULL
  WHEN abs(displacement) <= 20 THEN 'STATIC' WHEN abs(displacement) < 60 THEN 'LOW_MOTION' WHEN speed < 0.05 OR speed > 20 THEN 'IMPLAUSIBLE_SPEED' WHEN n_steps >= 3 AND monotonic < 0.55 THEN 'INCONSISTENT_TRAJECTORY' END AS reason FROM feat f LEFT JOIN tog USING (batch, camera, track_id)),
r2 AS (SELECT *, count(*) FILTER (reason IS NULL) OVER (PARTITION BY batch, camera) AS alive, sign(sum(CASE WHEN reason IS NULL THEN direction ELSE 0 END) OVER (PARTITION BY batch, camera)) AS flow FROM r1),
r3 AS (SELECT * EXCLUDE (reason, alive, flow), CASE WHEN reason IS NULL AND alive >= 5 AND flow <> 0 AND direction <> 0 AND direction <> flow THEN 'WRONG_DIRECTION' ELSE reason END AS reason FROM r2),
pv AS (SELECT *, CASE WHEN speed > 0 THEN speed END AS p FROM r3 WHERE reason IS NULL),
lm AS (SELECT *, median(p) OVER w AS ml, count(p) OVER w AS c, median(p) OVER (PARTITION BY batch, camera) AS mg, count(*) OVER (PARTITION BY batch, camera) AS n FROM pv WINDOW w AS (PARTITION BY batch, camera ORDER BY start_frame, track_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING EXCLUDE CURRENT ROW)),
rf AS (SELECT *, CASE WHEN c >= 2 THEN ml ELSE mg END AS ref FROM lm),
casc0 AS (SELECT batch, camera, track_id, start_frame, end_frame, hits, x_start, displacement, path_efficiency, direction, monotonic, n_steps, confidence, paused, CASE WHEN n >= 5 AND ref IS NOT NULL AND NOT (speed BETWEEN ref / 4.0 AND ref * 4.0) AND NOT paused THEN 'TRAIN_MOTION_MISMATCH' END AS reason FROM rf
  UNION ALL SELECT batch, camera, track_id, start_frame, end_frame, hits, x_start, displacement, path_efficiency, direction, monotonic, n_steps, confidence, paused, reason FROM r3 WHERE reason IS NOT NULL),
casc AS (SELECT *, CASE WHEN reason IN ('TOO_SHORT', 'DETECTION_GAP', 'STATIC', 'WRONG_DIRECTION') THEN 'HARD' WHEN reason IS NOT NULL THEN 'SOFT' END AS severity FROM casc0)"""


def cascaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.cascade(features(spark, sf_dir), GROUP, "track_id", LIMITS)


@query(f"WITH {_PAUSE} SELECT * FROM tog")
def stop_corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir)
    median = F.median(F.when(F.col("speed") > 0, F.col("speed"))).over(Window.partitionBy(*GROUP))
    stalled = rows.withColumn("m", median).where(F.col("speed") <= F.col("m") * 0.2)
    return joins.stalled_together(stalled, GROUP, "start_frame", "end_frame", "track_id", 2)


@query(f"WITH {_CASC} SELECT batch, camera, track_id, paused, reason, severity FROM casc")
def validation_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascaded(spark, sf_dir).select(*GROUP, "track_id", "paused", "reason", "severity")


@query(f"WITH {_CASC} SELECT batch, camera, coalesce(reason, 'ACCEPTED') AS reason, count(*) AS n FROM casc GROUP BY ALL")
def rejection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascaded(spark, sf_dir).groupBy(*GROUP, F.coalesce("reason", F.lit("ACCEPTED")).alias("reason")).agg(F.count("*").alias("n"))


_REC = _CASC + """, act AS (SELECT batch, camera, min(start_frame) + 200 AS lo, max(end_frame) - 200 AS hi FROM feat GROUP BY ALL),
rec AS (SELECT c.*, lo, hi, CASE WHEN NOT (round_even((start_frame + end_frame) / 2, 0) BETWEEN lo AND hi) THEN 'OUTSIDE' WHEN severity = 'HARD' OR abs(displacement) <= 20 OR (n_steps >= 3 AND path_efficiency < 0.4) OR (n_steps >= 3 AND monotonic < 0.45) OR confidence < 150 OR direction = 0 THEN 'BLOCKED' ELSE 'CANDIDATE' END AS outcome
  FROM casc c JOIN act USING (batch, camera) WHERE reason IS NOT NULL)"""


def with_spans(judged: DataFrame) -> DataFrame:
    """Adds the span ``(lo, hi)`` in which a camera's batch is active; it has a row for each track, so a window finds the ends."""
    w = Window.partitionBy(*GROUP)
    return judged.withColumn("lo", F.min("start_frame").over(w) + 200).withColumn("hi", F.max("end_frame").over(w) - 200)


@query(f"WITH {_REC} SELECT batch, camera, track_id, reason, outcome FROM rec")
def recovery_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = with_spans(cascaded(spark, sf_dir)).where("reason IS NOT NULL")
    return validate.recoverable(rejected, None, GROUP, LIMITS).select(*GROUP, "track_id", "reason", "outcome")


@query(f"""WITH {_REC}, p AS (SELECT camera, CASE WHEN start_frame < lo THEN 'PRE' WHEN start_frame > hi THEN 'POST' ELSE 'ACTIVE' END AS position, severity FROM rec)
SELECT camera, position, severity, count(*) AS n, grouping_id(camera, position, severity)::BIGINT AS level FROM p GROUP BY CUBE (camera, position, severity)""")
def rejection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_spans(cascaded(spark, sf_dir)).where("reason IS NOT NULL")
    rows = rows.withColumn("position", validate.position_of(F.col("start_frame"), F.col("lo"), F.col("hi")))
    return fuse.rejection_summary(rows, "camera", "position", "severity")


_ROW = "{'k': track_id, 's': start_frame, 'e': end_frame, 'x': x_start, 'h': hits, 'c': confidence, 'm': round_even((start_frame + end_frame) / 2, 0)}"


def _dup_sql(source: str, overlap: float, near: float) -> str:
    """The fold of duplicates over ``source(g, i, row)``: the kept tracks travel along as a list; ``dup`` has what each step lost to what."""
    meets = f"least(n.r.e, k.e) - greatest(n.r.s, k.s) + 1 > 0 AND (least(n.r.e, k.e) - greatest(n.r.s, k.s) + 1)::DOUBLE / greatest(1, least(n.r.e - n.r.s, k.e - k.s) + 1) >= {overlap} AND abs(n.r.x - k.x) <= {near}"
    return f"""dupf(g, i, kept, lost, winner) AS (SELECT g, i, [r], NULL::BIGINT, NULL::BIGINT FROM {source} WHERE i = 1
  UNION ALL SELECT g, i, CASE WHEN q IS NULL THEN list_append(kept, r) WHEN (r.h, r.c) > (q.h, q.c) THEN list_append(list_filter(kept, lambda k: k.k <> q.k), r) ELSE kept END,
    CASE WHEN q IS NOT NULL THEN CASE WHEN (r.h, r.c) > (q.h, q.c) THEN q.k ELSE r.k END END, CASE WHEN q IS NOT NULL THEN CASE WHEN (r.h, r.c) > (q.h, q.c) THEN r.k ELSE q.k END END
  FROM (SELECT n.g, n.i, n.r, list_filter(f.kept, lambda k: k.e >= n.r.s) AS kept, list_filter(f.kept, lambda k: k.e >= n.r.s AND {meets})[1] AS q FROM dupf f JOIN {source} n ON n.g = f.g AND n.i = f.i + 1)),
dup AS (SELECT lost, arg_max(winner, i) AS winner FROM dupf WHERE lost IS NOT NULL GROUP BY lost)"""


_TAIL = _CASC + f""",
alive AS (SELECT (batch, camera) AS g, row_number() OVER (PARTITION BY batch, camera ORDER BY start_frame, track_id) AS i, {_ROW} AS r FROM casc WHERE reason IS NULL),
{_dup_sql("alive", 0.3, 120)},
apart AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY r.m, r.k) AS i, r FROM alive WHERE r.k NOT IN (SELECT lost FROM dup)),
sepf(g, i, kept, lost) AS (SELECT g, i, r, NULL::BIGINT FROM apart WHERE i = 1
  UNION ALL SELECT n.g, n.i, CASE WHEN n.r.m - f.kept.m < 10 AND abs(n.r.x - f.kept.x) <= 120 AND NOT (f.kept.h, f.kept.c) < (n.r.h, n.r.c) THEN f.kept ELSE n.r END,
    CASE WHEN n.r.m - f.kept.m < 10 AND abs(n.r.x - f.kept.x) <= 120 THEN CASE WHEN (f.kept.h, f.kept.c) < (n.r.h, n.r.c) THEN f.kept.k ELSE n.r.k END END FROM sepf f JOIN apart n ON n.g = f.g AND n.i = f.i + 1),
sep AS (SELECT lost FROM sepf WHERE lost IS NOT NULL),
tail AS (SELECT c.* EXCLUDE (reason, severity), dup.winner AS lost_to, CASE WHEN reason IS NULL AND dup.lost IS NOT NULL THEN 'DUPLICATE' WHEN reason IS NULL AND sep.lost IS NOT NULL THEN 'MIN_SEPARATION' ELSE reason END AS reason,
  CASE WHEN reason IS NULL AND (dup.lost IS NOT NULL OR sep.lost IS NOT NULL) THEN 'HARD' ELSE severity END AS severity FROM casc c LEFT JOIN dup ON dup.lost = c.track_id LEFT JOIN sep ON sep.lost = c.track_id)"""


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.cascade_tail(cascaded(spark, sf_dir), GROUP, "track_id", LIMITS)


@query(f"WITH RECURSIVE {_TAIL} SELECT batch, camera, track_id, reason, severity, lost_to FROM tail UNION ALL SELECT batch, camera, track_id, 'NO_TRAJECTORY', 'HARD', NULL FROM (SELECT camera, track_id, min(frame) // 1440 AS batch FROM hit GROUP BY ALL HAVING count(*) < 2)")
def cascade_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every track with the reason of the whole cascade: those of a single hit, duplicates and crowded ones included."""
    h = hits(spark, sf_dir).groupBy("camera", "track_id").agg(F.floor(F.min("frame") / BATCH).alias("batch"))
    lone = validate.no_trajectory(h, features(spark, sf_dir), GROUP, "track_id").withColumn("lost_to", F.lit(None).cast("long"))
    fields = [*GROUP, "track_id", "reason", "severity", "lost_to"]
    return finished(spark, sf_dir).select(*fields).unionByName(lone.select(*fields))


_LIVE = _TAIL + f""",
act2 AS (SELECT batch, camera, min(start_frame) + 200 AS lo, max(end_frame) - 200 AS hi FROM feat GROUP BY ALL),
cand AS (SELECT t.* FROM tail t JOIN act2 USING (batch, camera) WHERE severity = 'SOFT' AND round_even((start_frame + end_frame) / 2, 0) BETWEEN lo AND hi AND NOT (abs(displacement) <= 20 OR (n_steps >= 3 AND path_efficiency < 0.4) OR (n_steps >= 3 AND monotonic < 0.45) OR confidence < 150 OR direction = 0)),
seed AS (SELECT (batch, camera) AS g, list({_ROW}) AS live FROM tail WHERE reason IS NULL GROUP BY ALL),
ask AS (SELECT (batch, camera) AS g, row_number() OVER (PARTITION BY batch, camera ORDER BY start_frame, track_id) AS i, {_ROW} AS r FROM cand),
recf(g, i, live, k, recovered) AS (SELECT g, 0::BIGINT, coalesce(live, []), NULL::BIGINT, NULL::BOOLEAN FROM (SELECT DISTINCT g FROM ask) LEFT JOIN seed USING (g)
  UNION ALL SELECT g, i, CASE WHEN clash THEN live ELSE list_append(live, r) END, r.k, NOT clash FROM (SELECT n.g, n.i, n.r, f.live, len(list_filter(f.live, lambda a: abs(a.x - n.r.x) <= 120 AND ((a.s <= n.r.e AND n.r.s <= a.e) OR abs(a.m - n.r.m) < 10))) > 0 AS clash FROM recf f JOIN ask n ON n.g = f.g AND n.i = f.i + 1))"""


def _recovery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All judged tracks, and of the candidates for recovery which come back."""
    judged = graph.cut_lineage(with_spans(finished(spark, sf_dir)))
    candidates = validate.recoverable(judged.where("reason IS NOT NULL"), None, GROUP, LIMITS).where("outcome = 'CANDIDATE'")
    return judged, stateful.recover(judged.where("reason IS NULL"), candidates, GROUP, "track_id", "start_frame", "end_frame", "x_start", LIMITS.separation, LIMITS.duplicate_distance)


@query(f"WITH RECURSIVE {_LIVE} SELECT g[1] AS batch, g[2] AS camera, k AS track_id, recovered FROM recf WHERE i > 0")
def recovery_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for recovery against the accepted tracks and those recovered before them."""
    return _recovery(spark, sf_dir)[1]


@query(f"WITH RECURSIVE {_LIVE} SELECT batch, camera, track_id, 'ACCEPTED' AS origin, NULL AS reason FROM tail WHERE reason IS NULL UNION ALL SELECT batch, camera, track_id, 'RECOVERED', reason FROM tail JOIN recf ON k = track_id AND recovered")
def recovered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final boundaries: accepted tracks, and those that came back with the reason that had ruled them out."""
    judged, back = _recovery(spark, sf_dir)
    accepted = judged.where("reason IS NULL").select(*GROUP, "track_id", F.lit("ACCEPTED").alias("origin"), F.lit(None).cast("string").alias("reason"))
    return accepted.unionByName(judged.join(back.where("recovered").select(*GROUP, "track_id"), [*GROUP, "track_id"]).select(*GROUP, "track_id", F.lit("RECOVERED").alias("origin"), "reason"))


@query(f"""WITH RECURSIVE {_LIVE},
mc AS (SELECT camera, track_id, min(conf) AS min_conf FROM hit GROUP BY ALL), ac AS (SELECT batch, camera, start_frame FROM tail WHERE reason IS NULL),
rj AS (SELECT f.*, t.reason, t.severity, t.lost_to, t.paused, min_conf, rf.ref, CASE WHEN rf.track_id IS NULL THEN '-' WHEN c >= 2 THEN 'local' ELSE 'global' END AS ref_kind, lo, hi, recovered FROM tail t JOIN feat f USING (camera, track_id) JOIN mc USING (camera, track_id) JOIN act2 ON act2.batch = f.batch AND act2.camera = f.camera
  LEFT JOIN rf ON rf.camera = t.camera AND rf.track_id = t.track_id LEFT JOIN recf ON recf.i > 0 AND recf.k = t.track_id WHERE t.reason IS NOT NULL)
SELECT batch, camera, track_id, start_frame || '-' || end_frame AS frames, start_frame AS frame_start, round(start_frame / 60, 2) AS time_s, round(track_frames / 60, 2) AS duration_s, hits, coverage, confidence, min_conf, displacement AS displacement_px, speed * 60 AS speed_px_s, ref * 60 AS ref_speed_px_s, ref_kind, paused AS motion_paused,
  direction, monotonic, path_efficiency, max_missed AS max_det_gap, reason, severity AS "class", CASE WHEN start_frame < lo THEN 'PRE_WAGON' WHEN start_frame > hi THEN 'POST_WAGON' ELSE 'WAGON_ACTIVE' END AS train_state,
  round((SELECT max(a.start_frame) FROM ac a WHERE a.batch = rj.batch AND a.camera = rj.camera AND a.start_frame < rj.start_frame) / 60, 2) AS nearest_prev_s, round((SELECT min(a.start_frame) FROM ac a WHERE a.batch = rj.batch AND a.camera = rj.camera AND a.start_frame >= rj.start_frame) / 60, 2) AS nearest_next_s,
  CASE WHEN NOT (round_even((start_frame + end_frame) / 2, 0) BETWEEN lo AND hi) THEN '-' WHEN severity = 'HARD' THEN 'blocked: hard reason' WHEN recovered IS NULL THEN 'blocked: safety floor' WHEN recovered THEN 'recovered' ELSE 'blocked: near an accepted track' END AS recovery,
  CASE reason WHEN 'TOO_SHORT' THEN 'track_frames=' || track_frames WHEN 'DETECTION_GAP' THEN 'max_missed=' || max_missed WHEN 'LOW_CONFIDENCE' THEN 'confidence=' || floor(confidence)::BIGINT WHEN 'STATIC' THEN 'displacement=' || displacement WHEN 'LOW_MOTION' THEN 'displacement=' || displacement WHEN 'IMPLAUSIBLE_SPEED' THEN 'speed=' || floor(speed * 1000)::BIGINT
    WHEN 'INCONSISTENT_TRAJECTORY' THEN 'monotonic=' || floor(monotonic * 1000)::BIGINT WHEN 'WRONG_DIRECTION' THEN 'direction=' || direction WHEN 'TRAIN_MOTION_MISMATCH' THEN 'reference=' || floor(ref * 1000)::BIGINT WHEN 'DUPLICATE' THEN 'lost_to=' || lost_to ELSE '' END AS detail FROM rj""")
def rejection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected track of the whole cascade as one flat row; a frame is a sixtieth."""
    return validate.rejection_report(*_recovery(spark, sf_dir), GROUP, "track_id", 60.0, LIMITS)


@query(f"""WITH {TRK}, r AS (SELECT batch, camera, abs(x_end - x_start)::DOUBLE AS v, row_number() OVER (PARTITION BY batch, camera ORDER BY start_frame, track_id) - 1 AS i, count(*) OVER (PARTITION BY batch, camera) AS n FROM trk),
h AS (SELECT batch, camera, median(CASE WHEN i < n // 2 THEN v END) AS early, median(CASE WHEN i >= n - n // 2 THEN v END) AS late FROM r GROUP BY ALL)
SELECT batch, camera, early, late, CASE WHEN early IS NULL OR early <= 0 THEN 'UNKNOWN' WHEN late > early * (1 + 0.15) THEN 'ACCELERATING' WHEN late < early * (1 - 0.15) THEN 'DECELERATING' ELSE 'CONSTANT' END AS state FROM h""")
def motion_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tracks(spark, sf_dir).withColumn("v", F.abs(F.col("x_end") - F.col("x_start")))
    return W.motion_state(rows, GROUP, ["start_frame", "track_id"], "v")


@query(f"""WITH {EV}, r AS (SELECT event_id, sensor, label, conf, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS i FROM ev),
b AS (SELECT a.event_id, c.label, sum(c.conf) AS total, min(c.i) AS first FROM r a JOIN r c ON a.sensor = c.sensor AND c.i BETWEEN a.i - 29 AND a.i GROUP BY ALL)
SELECT event_id, arg_max(label, (total, -first)) AS voted FROM b GROUP BY event_id""")
def bounded_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.bounded_vote(events(spark, sf_dir), ["sensor"], ["t", "event_id"], "label", "conf").select("event_id", "voted")


@query(f"""WITH {_HITS}, ask AS (SELECT track_id, unnest(range(s, e + 1, 97)) AS frame FROM (SELECT track_id, min(frame) - 50 AS s, max(frame) + 50 AS e FROM hit GROUP BY track_id)),
n AS (SELECT a.track_id, a.frame, max(h.frame) FILTER (h.frame <= a.frame) AS fa, min(h.frame) FILTER (h.frame >= a.frame) AS fb FROM ask a JOIN hit h USING (track_id) GROUP BY ALL)
SELECT n.track_id, n.frame, CASE WHEN fa IS NULL THEN hb.x::DOUBLE WHEN fb IS NULL OR fa = fb THEN ha.x::DOUBLE ELSE ha.x::DOUBLE + (hb.x::DOUBLE - ha.x::DOUBLE) * (n.frame - fa) / (fb - fa) END AS x
FROM n LEFT JOIN hit ha ON ha.track_id = n.track_id AND ha.frame = fa LEFT JOIN hit hb ON hb.track_id = n.track_id AND hb.frame = fb""")
def track_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hits(spark, sf_dir)
    ask = h.groupBy("track_id").agg(F.min("frame").alias("s"), F.max("frame").alias("e")).select("track_id", F.explode(F.sequence(F.col("s") - 50, F.col("e") + 50, F.lit(97).cast("long"))).alias("frame"))
    return W.interpolate(h, ask, ["track_id"], "frame", "x")


_HYS = EV + """, r AS (SELECT sensor, t, event_id, label, conf / 200.0::DOUBLE AS d, least(1.0, conf / 250.0::DOUBLE) AS c, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS i FROM ev),
f(sensor, i, stable, pending, settled) AS (SELECT sensor, i, label, []::STRUCT(l VARCHAR, d DOUBLE, c DOUBLE, i BIGINT)[], [{'i': i, 's': label, 'l': label}] FROM r WHERE i = 1
  UNION ALL SELECT sensor, i, CASE WHEN takes THEN label ELSE stable END, CASE WHEN label = stable OR takes THEN [] ELSE open END,
    CASE WHEN label = stable THEN list_append(list_transform(pending, lambda p: {'i': p.i, 's': stable, 'l': p.l}), {'i': i, 's': stable, 'l': label}) WHEN takes THEN list_transform(open, lambda p: {'i': p.i, 's': label, 'l': p.l}) ELSE [] END
  FROM (SELECT *, label <> stable AND len(list_distinct(list_transform(open, lambda p: p.l))) = 1 AND list_min(list_transform(open, lambda p: p.c)) >= 0.5 AND list_sum(list_transform(open, lambda p: p.c)) / len(open) >= 0.75 AND (list_sum(list_transform(open, lambda p: p.d)) >= 1.0 OR len(open) >= 3) AS takes
    FROM (SELECT n.sensor, n.i, n.label, f.stable, f.pending, list_append(f.pending, {'l': n.label, 'd': n.d, 'c': n.c, 'i': n.i}) AS open FROM f JOIN r n ON n.sensor = f.sensor AND n.i = f.i + 1))),
done AS (SELECT sensor, unnest(settled) AS s FROM f UNION ALL SELECT sensor, unnest(list_transform(pending, lambda p: {'i': p.i, 's': stable, 'l': p.l})) FROM f QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY i DESC) = 1)"""


# What is open at the end was tested when its last row came, so it stays with the stable label.
@query(f"WITH RECURSIVE {_HYS} SELECT r.sensor, r.t, r.event_id, r.label AS raw_label, s.s AS stable_label, s.s <> r.label AS held FROM done JOIN r ON r.sensor = done.sensor AND r.i = done.s.i")
def hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("duration", F.col("conf") / 200).withColumn("confidence", F.least(F.lit(1.0), F.col("conf") / 250))
    return stateful.hysteresis(rows, ["sensor"], ["t", "event_id"], "label", "duration", "confidence")


@query(f"""WITH RECURSIVE {EV}, r AS (SELECT sensor, event_id, t, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS i FROM ev),
c(sensor, i, event_id, cluster, total, n) AS (SELECT sensor, i, event_id, 1, t, 1 FROM r WHERE i = 1
  UNION ALL SELECT r.sensor, r.i, r.event_id, CASE WHEN abs(r.t - c.total / c.n) <= 36000 THEN c.cluster ELSE c.cluster + 1 END, CASE WHEN abs(r.t - c.total / c.n) <= 36000 THEN c.total + r.t ELSE r.t END, CASE WHEN abs(r.t - c.total / c.n) <= 36000 THEN c.n + 1 ELSE 1 END FROM c JOIN r ON r.sensor = c.sensor AND r.i = c.i + 1)
SELECT sensor, event_id, cluster::BIGINT AS cluster FROM c""")
def running_mean_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.running_mean_clusters(events(spark, sf_dir), ["sensor"], ["t", "event_id"], "t", "event_id", 36_000)


@query(f"""WITH RECURSIVE {TRK}, r AS (SELECT sensor, track_id, start_frame AS f, x_start AS x, hits, conf_sum, row_number() OVER (PARTITION BY sensor ORDER BY start_frame, track_id) AS i FROM trk),
c(sensor, i, kid, kf, kx, kh, kc, lost) AS (SELECT sensor, i, track_id, f, x, hits, conf_sum, NULL::BIGINT FROM r WHERE i = 1
  UNION ALL SELECT sensor, i, CASE WHEN clash AND NOT better THEN kid ELSE track_id END, CASE WHEN clash AND NOT better THEN kf ELSE f END, CASE WHEN clash AND NOT better THEN kx ELSE x END, CASE WHEN clash AND NOT better THEN kh ELSE hits END, CASE WHEN clash AND NOT better THEN kc ELSE conf_sum END, CASE WHEN clash THEN CASE WHEN better THEN kid ELSE track_id END END
  FROM (SELECT r.*, c.kid, c.kf, c.kx, c.kh, c.kc, r.f - c.kf < 2880 AND abs(r.x - c.kx) <= 300 AS clash, (c.kh, c.kc) < (r.hits, r.conf_sum) AS better FROM c JOIN r ON r.sensor = c.sensor AND r.i = c.i + 1))
SELECT r.sensor, r.track_id, r.track_id NOT IN (SELECT lost FROM c WHERE lost IS NOT NULL) AS kept FROM r""")
def min_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.min_separation(tracks(spark, sf_dir), ["sensor"], "track_id", "start_frame", "x_start", "hits", "conf_sum", 2880, 300)


_DUP_ROWS = TRK + ", dr AS (SELECT camera AS g, row_number() OVER (PARTITION BY camera ORDER BY start_frame, track_id) AS i, {'k': track_id, 's': start_frame, 'e': end_frame, 'x': x_start, 'h': hits, 'c': conf_sum} AS r FROM trk)"


@query(f"WITH RECURSIVE {_DUP_ROWS}, {_dup_sql('dr', 0.3, 120)} SELECT g AS camera, r.k AS track_id, dup.winner AS duplicate_of FROM dr LEFT JOIN dup ON dup.lost = r.k")
def pair_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per camera, cut only where no track goes on."""
    rows = W.time_islands(tracks(spark, sf_dir), ["camera"], "start_frame", "end_frame", width=BATCH)
    return stateful.suppress_duplicates(rows, ["camera", "day", "island"], "track_id", "start_frame", "end_frame", "x_start", "hits", "conf_sum", 0.30, 120).drop("day", "island")


@query()
def greedy_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("sensor", "frame", "x", F.col("conf").alias("confidence"), "event_id")
    return stateful.track(rows, ["sensor"], stateful.TrackerConfig(400.0, 1440, 3))


_STREAK = EV + """, r AS (SELECT sensor, t, event_id, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS i, CASE WHEN conf >= 125 THEN CASE label WHEN 'view' THEN 'o' WHEN 'click' THEN 'c' WHEN 'signup' THEN 'p' WHEN 'error' THEN 'd' ELSE 'c' END END AS k FROM ev),
f(sensor, i, o, c, p, state, event, opened) AS (SELECT sensor, 0::BIGINT, 0, 0, 0, 'UNKNOWN', NULL::VARCHAR, false FROM r WHERE i = 1
  UNION ALL SELECT sensor, i, o, c, p, to_, CASE WHEN to_ = 'OPEN' AND state <> 'OPEN' AND NOT opened THEN 'DOOR_OPEN' END, opened OR to_ = 'OPEN'
  FROM (SELECT *, CASE state WHEN 'UNKNOWN' THEN CASE WHEN o >= 2 THEN 'OPEN' WHEN p >= 2 THEN 'PARTIAL_CLOSED' WHEN c >= 2 THEN 'CLOSED' ELSE state END WHEN 'CLOSED' THEN CASE WHEN o >= 2 THEN 'OPEN' WHEN p >= 2 THEN 'PARTIAL_CLOSED' ELSE state END
    WHEN 'PARTIAL_CLOSED' THEN CASE WHEN o >= 2 THEN 'OPEN' WHEN c >= 2 THEN 'CLOSED' ELSE state END ELSE CASE WHEN c >= 4 THEN 'CLOSED' WHEN p >= 4 THEN 'PARTIAL_CLOSED' ELSE state END END AS to_
    FROM (SELECT n.sensor, n.i, f.state, f.opened, CASE WHEN n.k = 'o' THEN f.o + 1 WHEN n.k IS NULL THEN greatest(f.o - 1, 0) ELSE 0 END AS o, CASE WHEN n.k = 'c' THEN f.c + 1 WHEN n.k IS NULL THEN greatest(f.c - 1, 0) ELSE 0 END AS c,
      CASE WHEN n.k = 'p' THEN f.p + 1 WHEN n.k IS NULL THEN greatest(f.p - 1, 0) ELSE 0 END AS p FROM f JOIN r n ON n.sensor = f.sensor AND n.i = f.i + 1)))"""


@query(f"WITH RECURSIVE {_STREAK} SELECT r.sensor, r.t, r.event_id, f.state, f.event FROM f JOIN r USING (sensor, i)")
def streak_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(v) for v in ("view", "open", "click", "closed", "signup", "partial_closed", "error", "damage", "purchase", "other")])
    rows = events(spark, sf_dir).select("sensor", "t", "event_id", names[F.col("label")].alias("seen"), F.least(F.lit(1.0), F.col("conf") / 250).alias("confidence"))
    return stateful.streak_states(rows, ["sensor"], ["t", "event_id"], "seen", "confidence", stateful.StreakConfig(open_rows=2, closed_rows=2))


@query()
def optimal_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per camera, cut only at pauses that end every track; a track is named by the day and number of its stretch, and its number in it."""
    rows = events(spark, sf_dir).select("camera", F.floor(F.col("frame") / 60).alias("frame"), "x", F.col("conf").alias("y"), F.col("event_id").alias("key"))
    return stateful.track_optimal(W.time_islands(rows, ["camera"], "frame", "frame", 6, width=24), ["camera", "day", "island"], 200.0, 6, 2)


@query()
def evidence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    rows = e.select("sensor", F.floor(F.col("frame") / 360).alias("frame"), F.col("conf").alias("confidence"), (F.col("x") % 848).cast("double").alias("x1"), F.lit(100.0).alias("y1"), (F.col("x") % 848 + 40).cast("double").alias("x2"), F.lit(300.0).alias("y2"), F.col("event_id").alias("key"))
    return stateful.group_evidence(rows, ["sensor"])


SEAMS = stateful.SeamConfig(max_seam=2880, tolerance=3.5, floor=50.0, cap=2000.0)


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).withColumn("direction", F.signum((F.col("x_end") - F.col("x_start")).cast("double")))


@query()
def fragment_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.link_fragments(_fragments(spark, sf_dir), ["sensor"], SEAMS)


@query()
def refused_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs of fragments were looked at and refused, by reason."""
    return stateful.refused_seams(_fragments(spark, sf_dir), ["sensor"], SEAMS).groupBy("sensor", "reason").agg(F.count("*").alias("n"))
