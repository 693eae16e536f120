"""Named queries: joins, votes, scalar functions, fusion and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import scalars as S
from trackloom.operators import aggregates as A
from trackloom.operators import fuse, graph, joins, stateful, validate
from trackloom.operators import reports as R
from trackloom.plans.ordered import _HITS, GROUP, SEG, boundary_segments, hits, placed_segments
from trackloom.plans.stage import BATCH, EV, READ, SESS, SESSIONS, TRK, events, query, readings, sessions, table, tracks

STATES = ("error", "purchase", "signup", "click", "view")


@query(f"WITH {EV}, c AS (SELECT sensor, label, count(*) AS n, avg(conf) AS mean_weight FROM ev GROUP BY ALL) SELECT sensor, label, mean_weight, n FROM c QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY n DESC, mean_weight DESC, label) = 1")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.majority_vote(events(spark, sf_dir), ["sensor"], "label", "conf")


@query(f"WITH {EV}, c AS (SELECT sensor, label, sum(conf)::BIGINT AS total_weight, avg(conf) AS m, count(*) AS n FROM ev GROUP BY ALL) SELECT sensor, label, total_weight, n FROM c QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY total_weight DESC, m DESC, substr(label, 1, 1), label) = 1")
def weighted_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.weighted_vote(events(spark, sf_dir), ["sensor"], "label", "conf")


@query(f"WITH {EV}, c AS (SELECT sensor, label, count(*) AS n, avg(conf) AS m FROM ev WHERE conf > 900 GROUP BY ALL), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY n DESC, substr(label, 1, 1), label) = 1) SELECT u.sensor, coalesce(label, 'wagon') AS label, coalesce(m, 0) AS mean_weight, coalesce(n, 0) AS n FROM (SELECT DISTINCT sensor FROM ev) u LEFT JOIN b USING (sensor)")
def segment_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return A.segment_vote(e.select("sensor").distinct(), e.where("conf > 900"), "sensor", "label", "conf")


@query(f"""WITH {EV}, c AS (SELECT sensor, batch, count(*) AS used, count(*) FILTER (label = 'view') AS positive, count(*) FILTER (label = 'click') AS negative, avg(conf) FILTER (label = 'view') AS pw, avg(conf) FILTER (label = 'click') AS nw FROM ev GROUP BY ALL),
s AS (SELECT *, CASE WHEN positive::DOUBLE / used > 0.35 THEN 'LOADED' WHEN negative > 0 THEN 'EMPTY' ELSE 'NO_DATA' END AS state FROM c)
SELECT sensor, batch, state, CASE state WHEN 'LOADED' THEN pw WHEN 'EMPTY' THEN nw ELSE 0 END AS mean_weight, used, positive, negative FROM s""")
def ratio_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.ratio_vote(events(spark, sf_dir), ["sensor", "batch"], F.col("label") == "view", F.col("label") == "click", "conf")


@query(f"WITH {SESS} SELECT track_id, label, count(DISTINCT frame) AS frames, avg(conf) AS mean_weight, max(conf) AS max_weight FROM sess GROUP BY ALL")
def state_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.state_evidence(sessions(spark, sf_dir), ["track_id"], "label", "frame", "conf")


@query(f"""WITH {SESS}, c AS (SELECT track_id, label, count(DISTINCT frame) AS frames, avg(conf) AS m FROM sess GROUP BY ALL), n AS (SELECT track_id, count(DISTINCT frame) AS total_frames FROM sess GROUP BY track_id),
b AS (SELECT * FROM c JOIN n USING (track_id) QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY frames DESC, m DESC, label) = 1)
SELECT track_id, CASE WHEN frames >= 2 AND frames::DOUBLE / total_frames >= 0.34 THEN label END AS state, CASE WHEN frames >= 2 AND frames::DOUBLE / total_frames >= 0.34 THEN m ELSE 0 END AS mean_weight, frames, total_frames, CASE WHEN frames < 2 THEN 'insufficient_frame_support' WHEN frames::DOUBLE / total_frames < 0.34 THEN 'insufficient_support_fraction' END AS reason FROM b""")
def distinct_support_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.resolve_state(sessions(spark, sf_dir), ["track_id"], "label", "frame", "conf")


@query(f"WITH {SESS} SELECT track_id, event_id, label, conf, x, frame FROM sess QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY x DESC, conf DESC, frame, event_id) = 1")
def best_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.best_observation(sessions(spark, sf_dir), ["track_id"], "x", "conf", "frame", "event_id").select("track_id", "event_id", "label", "conf", "x", "frame")


@query(f"WITH {EV} SELECT sensor, batch, label, event_id, conf FROM ev QUALIFY row_number() OVER (PARTITION BY sensor, batch ORDER BY list_position(['error', 'purchase', 'signup', 'click', 'view'], label), conf DESC, event_id) = 1")
def priority_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.priority_pick(events(spark, sf_dir), ["sensor", "batch"], "label", STATES, [F.desc("conf"), F.asc("event_id")]).select("sensor", "batch", "label", "event_id", "conf")


@query(f"WITH {EV} SELECT sensor, count(*) FILTER (conf > 500)::DOUBLE / count(*) AS fraction, count(*) AS n FROM ev GROUP BY sensor")
def fraction_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.fraction_with(events(spark, sf_dir), ["sensor"], F.col("conf") > 500)


@query(f"WITH {SESS} SELECT track_id, count(DISTINCT frame) AS support, max(frame) - min(frame) + 1 AS span, min(frame) AS first_frame, max(frame) AS last_frame, count(DISTINCT frame) >= 2 AS accepted, avg(conf) AS mean_conf, least(1.0, count(*)::DOUBLE / (max(frame) - min(frame) + 1)) AS consistency FROM sess GROUP BY track_id")
def track_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.max("frame") - F.min("frame") + 1
    n = F.countDistinct("frame")
    return sessions(spark, sf_dir).groupBy("track_id").agg(n.alias("support"), span.alias("span"), F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), (n >= 2).alias("accepted"), F.avg("conf").alias("mean_conf"), F.least(F.lit(1.0), F.count("*") / span).alias("consistency"))


@query(f"WITH {TRK}, d AS (SELECT camera, hits, sign(x_end - x_start) AS s FROM trk) SELECT camera, CASE WHEN count(*) >= 3 THEN sign(sum(s * hits)) ELSE 0 END::INT AS by_hits, sign(sum(s))::INT AS by_count FROM d GROUP BY camera")
def dominant_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tracks(spark, sf_dir).withColumn("d", F.col("x_end") - F.col("x_start"))
    return A.dominant_direction(rows, ["camera"], "d", "hits")


@query(f"WITH {EV}, s AS (SELECT sensor, t - lag(t) OVER (PARTITION BY sensor ORDER BY t) AS d FROM ev) SELECT sensor, coalesce(median(d) FILTER (d > 0), 0)::DOUBLE AS spacing FROM s GROUP BY sensor")
def median_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.median_spacing(events(spark, sf_dir), ["sensor"], "t")


@query(f"WITH {EV} SELECT sensor, sum(t * conf)::DOUBLE / sum(conf) AS weighted_time FROM ev GROUP BY sensor")
def weighted_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.weighted_time(events(spark, sf_dir), ["sensor"], "t", "conf")


_CHAIN = _HITS + f""", ch AS (SELECT h.*, (h.track_id // {SESSIONS}) * {SESSIONS} + (h.track_id % {SESSIONS}) // 3 AS chain, n.hits, n.w FROM hit h JOIN (SELECT track_id, count(*) AS hits, max(conf) AS w FROM hit GROUP BY track_id) n USING (track_id))"""


@query(f"""WITH {_CHAIN}, f AS (SELECT chain, frame, arg_min(x, track_id) AS x FROM ch GROUP BY ALL), p AS (SELECT DISTINCT chain, track_id, hits, w FROM ch),
m AS (SELECT chain, min(track_id) AS track_id, sum(hits * w)::DOUBLE / sum(hits) AS confidence, count(*) AS fragments FROM p GROUP BY chain)
SELECT m.*, (SELECT string_agg(frame::VARCHAR || ':' || x::VARCHAR, ',' ORDER BY frame) FROM f WHERE f.chain = m.chain) AS path FROM m""")
def fragment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hits(spark, sf_dir)
    n = h.groupBy("track_id").agg(F.count("*").alias("hits"), F.max("conf").alias("w"))
    rows = h.join(n, "track_id").withColumn("chain", F.floor(F.col("track_id") / SESSIONS) * SESSIONS + F.floor(F.col("track_id") % SESSIONS / 3))
    merged = A.merge_fragments(rows, "chain", "track_id", "frame", "x", "w", "hits")
    return merged.select("chain", "track_id", "confidence", "fragments", F.array_join(F.zip_with("frames", "trajectory", lambda f, x: F.concat_ws(":", f, x)), ",").alias("path"))


@query(f"WITH {READ}, c AS (SELECT unit, number, count(*) AS n, avg(weight) AS mean_weight, min(o_orderkey) AS first_frame, max(o_orderkey) AS last_frame FROM rd GROUP BY ALL HAVING count(*) >= 2) SELECT *, row_number() OVER (PARTITION BY unit ORDER BY first_frame, number) AS ordinal FROM c")
def number_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.number_candidates(readings(spark, sf_dir), ["unit"], "number", "weight", "o_orderkey")


@query(f"""WITH {READ}, s AS (SELECT unit, min(length(number)) = max(length(number)) AS same FROM rd GROUP BY unit),
d AS (SELECT unit, i, substr(number, i::INT, 1) AS digit, count(*) AS n FROM rd JOIN s USING (unit), (SELECT unnest(range(1, 12)) AS i) WHERE same AND i <= length(number) GROUP BY ALL),
t AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY unit, i ORDER BY n DESC, digit) = 1), w AS (SELECT unit, number, count(*) AS n FROM rd JOIN s USING (unit) WHERE NOT same GROUP BY ALL)
SELECT unit, string_agg(digit, '' ORDER BY i) AS number FROM t GROUP BY unit UNION ALL SELECT unit, number FROM (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY unit ORDER BY n DESC, number) = 1)""")
def digit_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.digit_vote(readings(spark, sf_dir), ["unit"], "number")


@query(f"""WITH {READ}, c AS (SELECT unit, number, count(*) AS n, avg(weight) AS w FROM rd GROUP BY ALL), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY unit ORDER BY (length(number) = 11) DESC, n DESC, w DESC, number) = 1)
SELECT unit, CASE WHEN length(number) = 11 THEN number END AS identifier, CASE WHEN length(number) = 11 THEN w ELSE 0 END AS confidence FROM b""")
def identifier_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).groupBy("unit", "number").agg(F.count("*").alias("n"), F.avg("weight").alias("w"))
    return A.identifier_pick(rows, ["unit"], "number", "n", "w")


@query(f"""WITH {READ} SELECT o_orderkey, array_to_string(list_filter([CASE WHEN length(number) <> 11 THEN 'length' END, CASE WHEN NOT regexp_full_match(number, '[0-9]+') THEN 'not numeric' END, CASE WHEN NOT (substr(number, 1, 2)::INT BETWEEN 10 AND 39) THEN 'type' END], lambda e: e IS NOT NULL), ',') AS errors,
  CASE WHEN substr(number, 1, 2)::INT BETWEEN 10 AND 39 THEN number ELSE translate(substr(number, 1, 1), '4569780', '1113111') || substr(number, 2) END AS corrected,
  substr(number, 1, 2) || ' ' || substr(number, 3, 2) || ' ' || substr(number, 5, 2) || ' ' || substr(number, 7, 4) || ' ' || substr(number, 11, 1) AS formatted FROM rd""")
def number_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("number")
    return readings(spark, sf_dir).select("o_orderkey", F.array_join(S.number_errors(n), ",").alias("errors"), S.corrected_number(n).alias("corrected"), S.formatted_number(n).alias("formatted"))


@query(f"""WITH {SESS}, s AS (SELECT track_id, string_agg(DISTINCT label, ',' ORDER BY label) AS supporting, list(DISTINCT label) AS l FROM sess GROUP BY track_id)
SELECT track_id, supporting, array_to_string(list_filter(['click', 'error', 'purchase', 'signup', 'view'], lambda u: NOT list_contains(l, u)), ',') AS missing FROM s""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.provenance(sessions(spark, sf_dir), "track_id", "label", sorted(STATES))
    return out.select("track_id", F.array_join("supporting", ",").alias("supporting"), F.array_join("missing", ",").alias("missing"))


@query("SELECT o_orderkey, CASE WHEN n > 0 THEN (a + b + c)::DOUBLE / n ELSE 0 END AS confidence FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey % 100 END AS a, o_orderkey % 7 AS b, o_custkey % 2 AS c, (CASE WHEN o_custkey % 3 <> 0 AND o_custkey % 100 > 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 7 > 0 THEN 1 ELSE 0 END) + (o_custkey % 2) AS n FROM orders)")
def combined_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    o = o.select("o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 100).alias("a"), (F.col("o_orderkey") % 7).alias("b"), (F.col("o_custkey") % 2).alias("c"))
    return o.select("o_orderkey", A.combined_confidence("a", "b", "c").alias("confidence"))


@query(f"WITH {TRK} SELECT camera, sensor, string_agg(track_id::VARCHAR, ',' ORDER BY conf_sum DESC, track_id) AS tracks FROM trk GROUP BY ALL")
def observations_by_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct((-F.col("conf_sum")).alias("c"), "track_id")))
    return tracks(spark, sf_dir).groupBy("camera", "sensor").agg(F.array_join(F.transform(rows, lambda s: s["track_id"].cast("string")), ",").alias("tracks"))


@query(f"WITH {EV} SELECT camera, count(*) AS visible, count(*) FILTER (label = 'error') AS anomalies, count(*) FILTER (label = 'error') * 100.0::DOUBLE / count(*) AS coverage, avg(conf) FILTER (conf > 0) AS mean_conf FROM ev GROUP BY camera")
def camera_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.count_if(F.col("label") == "error")
    return events(spark, sf_dir).groupBy("camera").agg(F.count("*").alias("visible"), bad.alias("anomalies"), (bad * 100.0 / F.count("*")).alias("coverage"), F.avg(F.when(F.col("conf") > 0, F.col("conf"))).alias("mean_conf"))


@query(f"WITH {SEG} SELECT sensor, sha256(string_agg(concat_ws('|', segment_index, start_frame, end_frame), chr(10) ORDER BY segment_index)) AS fingerprint, count(*) AS n FROM seg GROUP BY sensor")
def ordered_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.ordered_fingerprint(boundary_segments(spark, sf_dir), ["sensor"], "segment_index", [F.col(c).cast("string") for c in ("segment_index", "start_frame", "end_frame")])


_QUORUM = EV + """, r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY t, event_id) AS i FROM ev WHERE label <> 'purchase'),
cf(batch, i, cluster, total, n) AS (SELECT batch, i, 1, t, 1 FROM r WHERE i = 1
  UNION ALL SELECT r.batch, r.i, CASE WHEN abs(r.t - c.total / c.n) <= 600 THEN c.cluster ELSE c.cluster + 1 END, CASE WHEN abs(r.t - c.total / c.n) <= 600 THEN c.total + r.t ELSE r.t END, CASE WHEN abs(r.t - c.total / c.n) <= 600 THEN c.n + 1 ELSE 1 END FROM cf c JOIN r ON r.batch = c.batch AND r.i = c.i + 1),
cl AS (SELECT r.*, cf.cluster::BIGINT AS cluster FROM r JOIN cf USING (batch, i))"""


@query(f"""WITH RECURSIVE {_QUORUM}, m AS (SELECT DISTINCT batch, t AS m FROM ev WHERE label = 'purchase'),
q AS (SELECT batch, cluster, count(DISTINCT camera) AS cameras, max(t) - min(t) AS spread, avg(conf) AS mean_weight, avg(t) AS center FROM cl GROUP BY ALL HAVING count(DISTINCT camera) >= 2 AND max(t) - min(t) <= 1200 AND avg(conf) >= 150)
SELECT * FROM q WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.batch = q.batch AND abs(q.center - m.m) < 120)""")
def cluster_quorum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweep clusters of what all cameras of a batch saw beside its masters, if enough of them saw it and no master is near."""
    e = events(spark, sf_dir)
    seen = e.where("label <> 'purchase'")
    clusters = stateful.running_mean_clusters(seen, ["batch"], ["t", "event_id"], "t", "event_id", 600)
    masters = e.where("label = 'purchase'").select("batch", "t").distinct()
    return A.cluster_quorum(seen.join(clusters, ["batch", "event_id"]), ["batch", "cluster"], "camera", "t", "conf", masters, ["batch"], "t", 2, 1200, 150, 120)


_UNITS = SEG + f""",
lw AS (SELECT sensor, sensor % 4 AS camera, 'L_' || sensor || '_' || segment_index AS local_id, start_frame + f0 AS s, end_frame + f0 + 1 AS e FROM seg JOIN spans USING (sensor)),
loc AS (SELECT batch, camera, local_id, greatest(s, batch * {BATCH}) AS s, least(e, (batch + 1) * {BATCH}) AS e FROM (SELECT *, unnest(range(s // {BATCH}, (e - 1) // {BATCH} + 1)) AS batch FROM lw)),
mas AS (SELECT DISTINCT batch, camera, frame FROM ev WHERE label = 'purchase'), uni AS (SELECT batch, camera, 'GW_' || row_number() OVER (PARTITION BY batch, camera ORDER BY frame) AS unit_id, frame AS us, lead(frame) OVER (PARTITION BY batch, camera ORDER BY frame) AS ue FROM mas),
units AS (SELECT * FROM uni WHERE ue IS NOT NULL)"""


def local_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of every sensor on its camera's clock, cut where a batch ends, as its footage is."""
    seg = placed_segments(spark, sf_dir).select((F.col("sensor") % 4).alias("camera"), S.local_id(F.col("sensor").cast("string"), F.col("segment_index")).alias("local_id"), (F.col("start_frame") + F.col("f0")).alias("s"), (F.col("end_frame") + F.col("f0") + 1).alias("e"))
    seg = seg.withColumn("batch", F.explode(F.sequence(F.floor(F.col("s") / BATCH), F.floor((F.col("e") - 1) / BATCH))))
    return seg.select(*GROUP, "local_id", F.greatest(F.col("s"), F.col("batch") * BATCH).alias("start"), F.least(F.col("e"), (F.col("batch") + 1) * BATCH).alias("end"))


def master_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A camera's units in a batch: the spans between its purchases, all sensors' together."""
    w = Window.partitionBy(*GROUP).orderBy("frame")
    m = events(spark, sf_dir).where("label = 'purchase'").select(*GROUP, "frame").distinct()
    return m.select(*GROUP, F.concat(F.lit("GW_"), F.row_number().over(w).cast("string")).alias("unit_id"), F.col("frame").alias("unit_start"), F.lead("frame").over(w).alias("unit_end")).where("unit_end IS NOT NULL")


_MAP = _UNITS + """,
pr AS (SELECT l.batch, l.camera, local_id, unit_id, least(e, ue) - greatest(s, us) AS ov, (least(e, ue) - greatest(s, us))::DOUBLE / (e - s) AS fr FROM loc l JOIN units u ON u.batch = l.batch AND u.camera = l.camera AND s < ue AND us < e),
tp AS (SELECT batch, camera, local_id, arg_min(unit_id, (-ov, unit_id)) AS unit_id, arg_min(ov, (-ov, unit_id)) AS overlap, arg_min(fr, (-ov, unit_id)) AS fraction, count(*) AS candidates, count(*) FILTER (fr >= 0.1) AS sig FROM pr GROUP BY ALL),
mp AS (SELECT l.batch, l.camera, l.local_id, s AS "start", e AS "end", unit_id, overlap, fraction, coalesce(candidates, 0) AS candidates, CASE WHEN unit_id IS NULL THEN 'UNMATCHED' WHEN sig > 1 THEN 'ONE_TO_MANY' ELSE 'EXACT' END AS k FROM loc l LEFT JOIN tp USING (batch, camera, local_id)),
mapped AS (SELECT * EXCLUDE (k), CASE WHEN k = 'EXACT' AND count(unit_id) OVER (PARTITION BY batch, camera, unit_id) > 1 THEN 'MANY_TO_ONE' ELSE k END AS kind FROM mp)"""


@query(f"WITH {_MAP} SELECT * FROM mapped")
def overlap_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.overlap_mapping(local_segments(spark, sf_dir), master_units(spark, sf_dir), GROUP, 720)


@query(f"WITH {_MAP} SELECT camera, kind, count(*) AS n, coalesce(sum(overlap), 0)::BIGINT AS overlap FROM mapped GROUP BY ALL")
def overlap_mapping_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_best_match(spark, sf_dir).groupBy("camera", "kind").agg(F.count("*").alias("n"), F.coalesce(F.sum("overlap"), F.lit(0)).alias("overlap"))


@query(f"WITH {_UNITS} SELECT event_id, ev.batch, ev.camera, frame, unit_id FROM ev JOIN units u ON u.batch = ev.batch AND u.camera = ev.camera AND frame BETWEEN us AND ue QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY us DESC, unit_id DESC) = 1")
def range_bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.assign_frames(events(spark, sf_dir).select("event_id", *GROUP, "frame"), master_units(spark, sf_dir), GROUP, "frame", 720).select("event_id", *GROUP, "frame", "unit_id")


@query(f"WITH {_UNITS} SELECT event_id, ev.batch, ev.camera, frame, unit_id FROM ev JOIN units u ON u.batch = ev.batch AND u.camera = ev.camera AND frame BETWEEN us AND ue QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY us, unit_id) = 1")
def frame_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.assign_frames(events(spark, sf_dir).select("event_id", *GROUP, "frame"), master_units(spark, sf_dir), GROUP, "frame", 720, keep="first").select("event_id", *GROUP, "frame", "unit_id")


_NEAR = TRK + """,
su AS (SELECT batch, camera, track_id AS support_id, start_frame AS s0, end_frame AS s1 FROM trk WHERE sensor % 3 <> 0), ma AS (SELECT batch, camera, track_id AS master_id, start_frame AS m0, end_frame AS m1 FROM trk WHERE sensor % 3 = 0),
pq AS (SELECT su.batch, su.camera, support_id, master_id, m0, CASE WHEN s1 > s0 AND m1 > m0 THEN greatest(least(s1, m1) - greatest(s0, m0), 0)::DOUBLE / (greatest(s1, m1) - least(s0, m0)) ELSE 0 END AS iou, abs((s0 + s1) / 2 - (m0 + m1) / 2) AS dt FROM su JOIN ma ON su.batch = ma.batch AND su.camera = ma.camera),
sc AS (SELECT *, greatest(iou, greatest(0.0, 1 - dt / 120)) AS score FROM pq WHERE iou >= 0.2 OR dt <= 120),
nr AS (SELECT batch, camera, support_id, arg_min(master_id, (-score, m0, master_id)) AS master_id, max(score) AS score FROM sc GROUP BY ALL)"""


def _support_and_master(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = tracks(spark, sf_dir)
    support = t.where("sensor % 3 <> 0").select(*GROUP, F.col("track_id").alias("support_id"), F.col("start_frame").alias("s_start"), F.col("end_frame").alias("s_end"))
    return support, t.where("sensor % 3 = 0").select(*GROUP, F.col("track_id").alias("master_id"), F.col("start_frame").alias("m_start"), F.col("end_frame").alias("m_end"))


@query(f"WITH {_NEAR} SELECT su.batch, su.camera, su.support_id, master_id, score FROM su LEFT JOIN nr USING (batch, camera, support_id)")
def nearest_match_with_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.nearest_match(*_support_and_master(spark, sf_dir), GROUP, 120.0)


@query(f"WITH {_NEAR} SELECT camera, count(*) FILTER (master_id IS NOT NULL) AS matched, count(*) FILTER (master_id IS NULL) AS leftover FROM (SELECT su.camera, master_id FROM su LEFT JOIN nr USING (batch, camera, support_id)) GROUP BY camera")
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("master_id")
    return nearest_match_with_leftovers(spark, sf_dir).groupBy("camera").agg(F.count_if(m.isNotNull()).alias("matched"), F.count_if(m.isNull()).alias("leftover"))


@query(f"""WITH {_NEAR}, pp AS (SELECT batch, camera, s0, m0, s0 - lag(s0) OVER w AS ds, m0 - lag(m0) OVER w AS dm FROM (SELECT n.batch, n.camera, su.s0, ma.m0 FROM nr n JOIN su USING (batch, camera, support_id) JOIN ma USING (batch, camera, master_id)) WINDOW w AS (PARTITION BY batch, camera ORDER BY m0, s0))
SELECT batch, camera, round(coalesce(sum(CASE WHEN ds > 0 AND dm > 0 THEN abs(dm - ds)::DOUBLE / greatest(dm, ds) END), 0), 4) AS penalty FROM pp GROUP BY ALL""")
def pattern_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    support, master = _support_and_master(spark, sf_dir)
    pairs = joins.nearest_match(support, master, GROUP, 120.0).where("master_id IS NOT NULL").join(support, [*GROUP, "support_id"]).join(master, [*GROUP, "master_id"])
    w = Window.partitionBy(*GROUP).orderBy("m_start", "s_start")
    pairs = pairs.withColumn("dm", F.col("m_start") - F.lag("m_start").over(w)).withColumn("ds", F.col("s_start") - F.lag("s_start").over(w))
    part = F.when((F.col("dm") > 0) & (F.col("ds") > 0), F.abs(F.col("dm") - F.col("ds")) / F.greatest("dm", "ds"))
    return pairs.groupBy(*GROUP).agg(F.round(F.coalesce(F.sum(part), F.lit(0.0)), 4).alias("penalty"))


@query(f"WITH {EV}, k AS (SELECT DISTINCT batch, camera, t FROM ev WHERE label = 'purchase') SELECT e.batch, e.camera, e.event_id, e.t, (SELECT max(k.t) FROM k WHERE k.batch = e.batch AND k.camera = e.camera AND k.t < e.t) AS previous, (SELECT min(k.t) FROM k WHERE k.batch = e.batch AND k.camera = e.camera AND k.t >= e.t) AS next FROM ev e WHERE label = 'error'")
def asof_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return joins.asof_neighbours(e.where("label = 'error'"), e.where("label = 'purchase'").select(*GROUP, "t"), GROUP, "t", "event_id")


_SPANS_L = TRK + f""", sl AS (SELECT batch, camera, greatest(start_frame, batch * {BATCH}) AS s, least(end_frame, (batch + 1) * {BATCH}) AS e, label FROM (SELECT camera, start_frame, end_frame, CASE track_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS label, unnest(range(start_frame // {BATCH}, end_frame // {BATCH} + 1)) AS batch FROM trk WHERE hits >= 4))"""


@query(f"""WITH {_SPANS_L}, p AS (SELECT batch, camera, event_id, frame FROM ev WHERE label = 'signup'), j AS (SELECT p.event_id, p.frame, s, e, label FROM p JOIN sl ON sl.batch = p.batch AND sl.camera = p.camera),
ins AS (SELECT event_id, arg_min(label, (s, e, label)) AS held FROM j WHERE s <= frame AND frame < e GROUP BY event_id),
bf AS (SELECT event_id, max((e, label)) AS a FROM j WHERE e <= frame GROUP BY event_id), af AS (SELECT event_id, min((s, label)) AS b FROM j WHERE s >= frame GROUP BY event_id)
SELECT p.batch, p.camera, p.event_id, coalesce(held, CASE WHEN b IS NULL OR frame - a[1] <= b[1] - frame THEN a[2] ELSE b[2] END, 'UNKNOWN') AS label, CASE WHEN held IS NOT NULL THEN 'inside' WHEN a IS NOT NULL OR b IS NOT NULL THEN 'nearest' ELSE 'none' END AS how
FROM p LEFT JOIN ins USING (event_id) LEFT JOIN bf USING (event_id) LEFT JOIN af USING (event_id)""")
def point_in_interval_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups by the tracks of their camera and batch; a track is cut where a batch ends."""
    name = F.when(F.col("track_id") % 3 == 0, "A").when(F.col("track_id") % 3 == 1, "B").otherwise("C")
    held = tracks(spark, sf_dir).where("hits >= 4").select("camera", "start_frame", "end_frame", name.alias("label"), F.explode(F.sequence(F.floor(F.col("start_frame") / BATCH), F.floor(F.col("end_frame") / BATCH))).alias("batch"))
    held = held.select(*GROUP, F.greatest(F.col("start_frame"), F.col("batch") * BATCH).alias("start"), F.least(F.col("end_frame"), (F.col("batch") + 1) * BATCH).alias("end"), "label")
    return joins.label_at(events(spark, sf_dir).where("label = 'signup'"), held, GROUP, "frame", "event_id")


@query("""WITH q AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id), u AS (SELECT d.doc_id, d.source, l.quality, l.toxic, b.item_id FROM documents d LEFT JOIN (SELECT doc_id, (min((quality, toxic)))[1] AS quality, (min((quality, toxic)))[2] AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id)
SELECT doc_id, CASE WHEN quality = 1 THEN 'GOOD' WHEN quality = 0 THEN 'BAD' ELSE 'NO_DATA' END AS state, coalesce(toxic = 1, false) AS anomalous, item_id IS NOT NULL AS listed FROM u""")
def authority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    merged = joins.authority_merge(docs, "doc_id", {"labels": table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "bench": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit(True).alias("listed"))})
    state = fuse.by_authority((F.col("labels.quality") == 1, F.lit("GOOD")), (F.col("labels.quality") == 0, F.lit("BAD")))
    return merged.select("doc_id", state.alias("state"), F.coalesce(F.col("labels.toxic") == 1, F.lit(False)).alias("anomalous"), F.col("bench").isNotNull().alias("listed"))


@query(f"WITH {SESS}, s AS (SELECT DISTINCT track_id FROM sess), h AS (SELECT track_id, label, count(*) AS n FROM sess GROUP BY ALL) SELECT s.track_id, c.camera, coalesce(h.n, 0) AS n, CASE WHEN h.n IS NULL THEN 'no footage' END AS reason FROM s CROSS JOIN (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS camera) c LEFT JOIN h ON h.track_id = s.track_id AND h.label = c.camera")
def roster_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = sessions(spark, sf_dir)
    grid = joins.roster_grid(e.select("track_id").distinct(), "track_id", sorted(STATES))
    seen = e.groupBy("track_id", F.col("label").alias("camera")).agg(F.count("*").alias("n"))
    return grid.join(seen, ["track_id", "camera"], "left").select("track_id", "camera", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "no footage").alias("reason"))


@query("SELECT c_custkey AS id, 'missing' AS problem FROM (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT o_custkey, 'unexpected' FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def missing_and_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit should have finished orders, and no one else."""
    expected = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    return joins.missing_and_unexpected(expected, table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")), "id")


@query(f"WITH {EV}, k AS (SELECT DISTINCT sensor, t FROM ev WHERE label = 'purchase') SELECT e.event_id, (SELECT max(k.t) FROM k WHERE k.sensor = e.sensor AND k.t <= e.t) AS leading, (SELECT min(k.t) FROM k WHERE k.sensor = e.sensor AND k.t > e.t) AS trailing FROM ev e")
def boundary_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("sensor").orderBy("t")
    back = Window.partitionBy("sensor").orderBy(F.desc("t"))
    mark = F.when(F.col("label") == "purchase", F.col("t"))
    return events(spark, sf_dir).select("event_id", F.max(mark).over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("leading"), F.min(mark).over(back.rangeBetween(Window.unboundedPreceding, -1)).alias("trailing"))


_SAME = TRK + """, p AS (SELECT a.track_id AS a, b.track_id AS b FROM trk a JOIN trk b ON a.camera = b.camera AND a.track_id < b.track_id AND abs(a.start_frame - b.start_frame) < 60 AND abs(a.x_start - b.x_start) <= 80
  WHERE 0.5::DOUBLE * (1 - abs(a.x_start - b.x_start) / 80.0::DOUBLE) + 0.5::DOUBLE * CASE WHEN a.start_frame <= b.end_frame AND b.start_frame <= a.end_frame THEN 0.7::DOUBLE + 0.3::DOUBLE * (least(a.end_frame, b.end_frame) - greatest(a.start_frame, b.start_frame) + 1) / (greatest(a.end_frame - a.start_frame, b.end_frame - b.start_frame) + 1)
    ELSE 0.7::DOUBLE * greatest(0, 1 - (greatest(a.start_frame, b.start_frame) - least(a.end_frame, b.end_frame)) / 60.0::DOUBLE) END >= 0.6),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), r(node, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.root), comp AS (SELECT node, min(root) AS root FROM r GROUP BY node)"""


def identity_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).select("camera", "track_id", "start_frame", "end_frame", "x_start", F.floor(F.col("start_frame") / 60).alias("hour"))


def identity_pairs(t: DataFrame, key: str = "track_id") -> DataFrame:
    """Rows of a camera that begin within an hour of each other and are similar enough in place and time, the lesser key first; hours meet their neighbours.

    All columns come along, those of the other row with ``_b``, so nothing has to be joined to the pairs.
    """
    other = t.withColumn("hour", F.explode(F.array(F.col("hour") - 1, F.col("hour"), F.col("hour") + 1))).withColumnsRenamed({c: f"{c}_b" for c in t.columns if c not in ("camera", "hour")})
    near = (F.col(key) < F.col(f"{key}_b")) & (F.abs(F.col("start_frame") - F.col("start_frame_b")) < 60) & (F.abs(F.col("x_start") - F.col("x_start_b")) <= 80)
    alike = 0.5 * S.spatial_similarity(F.abs(F.col("x_start") - F.col("x_start_b")), F.lit(80.0)) + 0.5 * S.temporal_similarity(F.col("start_frame"), F.col("end_frame"), F.col("start_frame_b"), F.col("end_frame_b"), 60)
    return t.join(other, ["camera", "hour"]).where(near & (alike >= 0.6))


def identity_cores(t: DataFrame) -> DataFrame:
    """Adds ``core``, the least of the tracks that are one for certain, and ``cored``, how many they are.

    Tracks that begin in the same hour and the same 40 of place and share a frame are alike by 0.5 * (1 - 39 / 80) + 0.5 * 0.7 at least. One that shares a frame with
    any before it does so with the one that goes on longest, so a sweep finds them.
    """
    cell = ["camera", "hour", F.floor(F.col("x_start") / 40)]
    w = Window.partitionBy(*cell).orderBy("start_frame", "track_id")
    before = F.max("end_frame").over(w.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("__new", F.when(F.col("start_frame") <= before, 0).otherwise(1))
    t = t.withColumn("__n", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    core = Window.partitionBy(*cell, "__n")
    return t.withColumn("core", F.min("track_id").over(core)).withColumn("cored", F.count("*").over(core)).drop("__new", "__n")


@query(f"WITH RECURSIVE {_SAME} SELECT * FROM comp")
def identity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cores of tracks are nodes, so that pairs of equal tracks are not met, and pairs of cores that have several pairs of tracks are one by hashing."""
    t = identity_cores(identity_tracks(spark, sf_dir))
    spans = t.select("camera", "hour", "start_frame", "end_frame", "x_start", "core").distinct()
    roots = graph.least_member(identity_pairs(spans, "core").select("core", "core_b").distinct(), "core", "core_b").withColumnRenamed("node", "core")
    return t.join(roots, "core", "left").where("cored > 1 OR root IS NOT NULL").select(F.col("track_id").alias("node"), F.coalesce("root", "core").alias("root"))


@query(f"""WITH RECURSIVE {_SAME}, st AS (SELECT trk.*, coalesce(root, track_id) AS root, CASE WHEN x_end > 500 THEN 'OPEN' ELSE 'CLOSED' END AS state FROM trk LEFT JOIN comp ON node = track_id)
SELECT root, count(*) AS merged, max(conf_sum) AS confidence, arg_min(track_id, (-hits, track_id)) AS snapshot_of, CASE WHEN bool_or(state = 'OPEN') THEN 'OPEN' ELSE arg_min(state, (-conf_sum, track_id)) END AS state FROM st GROUP BY root""")
def merged_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each identity: the least id survives, with the best snapshot, OPEN where any track was, and the highest confidence."""
    state = F.when(F.col("x_end") > 500, "OPEN").otherwise("CLOSED")
    t = tracks(spark, sf_dir).withColumn("state", state).join(identity_components(spark, sf_dir).withColumnRenamed("node", "track_id"), "track_id", "left").withColumn("root", F.coalesce("root", "track_id"))
    return R.merge_identities(t, "root", "track_id", "hits", "conf_sum", "state")


@query(f"WITH {EV} SELECT camera, count(*) AS raw, count(*) FILTER (label <> 'view') AS by_class, count(*) FILTER (label <> 'view' AND conf >= 200) AS by_confidence, count(*) FILTER (label <> 'view' AND conf >= 200 AND x >= 300) AS by_size FROM ev GROUP BY camera")
def detection_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c = F.col("label") != "view", F.col("conf") >= 200, F.col("x") >= 300
    return events(spark, sf_dir).groupBy("camera").agg(F.count("*").alias("raw"), F.count_if(a).alias("by_class"), F.count_if(a & b).alias("by_confidence"), F.count_if(a & b & c).alias("by_size"))


@query(f"WITH {EV}, b AS (SELECT event_id, label, conf, x % 800 AS px, x % 450 AS py, x % 400000 AS area FROM ev) SELECT event_id FROM b WHERE label <> 'view' AND conf >= 100 AND area::DOUBLE / 407040 BETWEEN 0.0005 AND 0.40 AND (conf >= 700 OR (px BETWEEN 848 * 0.12 AND 848 * 0.88 AND py BETWEEN 480 * 0.10 AND 480 * 0.85))")
def damage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("px", F.col("x") % 800).withColumn("py", F.col("x") % 450)
    inside = F.col("px").between(848 * 0.12, 848 * 0.88) & F.col("py").between(480 * 0.10, 480 * 0.85)
    return e.where((F.col("label") != "view") & (F.col("conf") >= 100) & (F.col("x") % 400_000 / 407_040).between(0.0005, 0.40) & ((F.col("conf") >= 700) | inside)).select("event_id")


_BOX = """bx AS (SELECT vec_id, least(e[1], e[2]) AS x1, greatest(e[1], e[2]) AS x2, least(e[3], e[4]) AS y1, greatest(e[3], e[4]) AS y2, least(e[5], e[6]) AS u1, greatest(e[5], e[6]) AS u2, least(e[7], e[8]) AS v1, greatest(e[7], e[8]) AS v2 FROM (SELECT vec_id, list_transform(embedding, lambda v: trunc(v::DOUBLE * 1000)) AS e FROM embeddings))"""


@query(f"""WITH {_BOX}, i AS (SELECT *, greatest(least(x2, u2) - greatest(x1, u1), 0) * greatest(least(y2, v2) - greatest(y1, v1), 0) AS n FROM bx), o AS (SELECT *, (x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1) - n AS u FROM i)
SELECT vec_id, CASE WHEN u > 0 THEN n / u ELSE 0 END AS iou, CASE WHEN x2 <= x1 OR u2 <= u1 THEN 0 ELSE greatest(least(x2, u2) - greatest(x1, u1), 0) / (greatest(x2, u2) - least(x1, u1)) END AS temporal FROM o""")
def box_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda k: (F.col("embedding")[k].cast("double") * 1000).cast("long").cast("double")
    lo, hi = (lambda a, b: F.least(at(a), at(b))), (lambda a, b: F.greatest(at(a), at(b)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", lo(0, 1).alias("x1"), hi(0, 1).alias("x2"), lo(2, 3).alias("y1"), hi(2, 3).alias("y2"), lo(4, 5).alias("u1"), hi(4, 5).alias("u2"), lo(6, 7).alias("v1"), hi(6, 7).alias("v2"))
    c = F.col
    return rows.select("vec_id", S.iou((c("x1"), c("y1"), c("x2"), c("y2")), (c("u1"), c("v1"), c("u2"), c("v2"))).alias("iou"), S.temporal_iou(c("x1"), c("x2"), c("u1"), c("u2")).alias("temporal"))


@query(f"""WITH {TRK} SELECT track_id, start_frame / 15.0::DOUBLE AS start_s, least(greatest((end_frame - start_frame) / 2 / 15.0::DOUBLE, 0.1), 1.0) AS sigma,
  CASE WHEN round_even((start_frame / 15.0::DOUBLE - 3.5) * 15, 0) BETWEEN 0 AND 599999 THEN round_even((start_frame / 15.0::DOUBLE - 3.5) * 15, 0)::BIGINT END AS local_frame FROM trk""")
def time_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps, s, e = F.lit(15.0), F.col("start_frame"), F.col("end_frame")
    return tracks(spark, sf_dir).select("track_id", S.seconds(s, fps).alias("start_s"), S.sigma(s, e, fps).alias("sigma"), S.local_frame(s / fps, F.lit(3.5), fps, F.lit(600_000)).alias("local_frame"))


@query(f"WITH {EV} SELECT event_id, CASE label WHEN 'purchase' THEN 'BUY' WHEN 'signup' THEN 'JOIN' ELSE label END AS canonical, CASE WHEN contains(label, 'e') AND contains(label, 'w') THEN 'VIEWED' WHEN contains(label, 'i') THEN 'ACTED' ELSE 'UNKNOWN' END AS substring, 'track_' || (event_id % 7) || '__' || label AS slot, event_id % 7 AS slot_track, label AS slot_camera FROM ev")
def label_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    name = S.slot(F.col("event_id") % 7, label)
    return events(spark, sf_dir).select("event_id", S.canonical(label, {"PURCHASE": "BUY", "SIGNUP": "JOIN"}).alias("canonical"), S.by_substring(label, [("iew", "VIEWED"), ("i", "ACTED")]).alias("substring"), name.alias("slot"), S.slot_track(name).alias("slot_track"), S.slot_camera(name).alias("slot_camera"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' AS packed FROM events")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("packed"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS total, count(*) FILTER (l_quantity > 25) AS large, count(*) FILTER (l_discount > 0.05) AS discounted, count(*) FILTER (l_shipdate > TIMESTAMP '1998-01-01') AS late, sum(l_quantity)::DOUBLE AS quantity FROM lineitem GROUP BY ALL")
def kpi_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("total"), F.count_if(F.col("l_quantity") > 25).alias("large"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_if(F.col("l_shipdate") > F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'")).alias("late"), F.sum("l_quantity").alias("quantity"))


@query("SELECT l_linestatus, state, count(*) AS n FROM (SELECT l_linestatus, unnest([l_returnflag, CASE WHEN l_quantity > 25 THEN 'BIG' ELSE 'NO_DATA' END]) AS state FROM lineitem) GROUP BY ALL")
def state_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("size", F.when(F.col("l_quantity") > 25, "BIG"))
    return fuse.state_histogram(li, ["l_linestatus"], ["l_returnflag", "size"])


@query("WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS loaded, count(*) FILTER (o_orderstatus = 'O') AS empty FROM orders GROUP BY o_custkey) SELECT o_custkey, loaded, empty, CASE WHEN loaded = 0 AND empty = 0 THEN 'N/A' WHEN loaded >= empty THEN 'LOADED' ELSE 'EMPTY' END AS rake FROM c")
def rake_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("loaded"), F.count_if(F.col("o_orderstatus") == "O").alias("empty"))
    return c.withColumn("rake", fuse.rake_type(F.col("loaded"), F.col("empty")))


_ANOM = """u AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'ENGINE' ELSE 'WAGON' END AS kind, CASE o_orderkey % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'PARTIAL_OPEN' WHEN 2 THEN 'DAMAGED' ELSE 'CLOSED' END AS l, CASE o_custkey % 3 WHEN 0 THEN 'OPEN' ELSE 'CLOSED' END AS r, o_orderstatus = 'F' AS d, CASE WHEN o_custkey % 5 > 0 THEN 'x' END AS id, CASE WHEN o_custkey % 7 > 0 THEN 'LOADED' ELSE 'NO_DATA' END AS ld FROM orders),
an AS (SELECT o_orderkey, kind, list_filter([CASE WHEN l IN ('OPEN', 'DAMAGED') THEN 'LEFT DOOR ' || l END, CASE WHEN r = 'OPEN' THEN 'RIGHT DOOR ' || r END, CASE WHEN l = 'PARTIAL_OPEN' THEN 'PARTIAL DOOR' END, CASE WHEN d THEN 'DAMAGE' END, CASE WHEN kind = 'WAGON' AND id IS NULL THEN 'NO IDENTIFIER' END, CASE WHEN kind = 'WAGON' AND ld = 'NO_DATA' THEN 'NO LOAD DATA' END], lambda x: x IS NOT NULL) AS a FROM u)"""


@query(f"WITH {_ANOM} SELECT o_orderkey, array_to_string(a, '; ') AS anomalies, len(a) > 0 AS anomalous FROM an")
def unit_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    left = F.when(k % 4 == 0, "OPEN").when(k % 4 == 1, "PARTIAL_OPEN").when(k % 4 == 2, "DAMAGED").otherwise("CLOSED")
    a = fuse.unit_anomalies(F.when(k % 9 == 0, "ENGINE").otherwise("WAGON"), left, F.when(c % 3 == 0, "OPEN").otherwise("CLOSED"), F.col("o_orderstatus") == "F", F.when(c % 5 > 0, "x"), F.when(c % 7 > 0, "LOADED").otherwise("NO_DATA"))
    return table(spark, sf_dir, "orders").select("o_orderkey", a.alias("a")).select("o_orderkey", F.array_join("a", "; ").alias("anomalies"), (F.size("a") > 0).alias("anomalous"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))")
def loaded_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    loads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "O", "LOADED").otherwise("EMPTY").alias("state"))
    return fuse.suppress_for_loaded(seen, loads, "l_orderkey", "l_returnflag", "state", "N").select("l_orderkey", "l_linenumber")


@query(f"""WITH {SESS}, s AS (SELECT track_id, list_sort(list_distinct(list(label))) AS seen FROM sess WHERE conf > 200 GROUP BY track_id)
SELECT track_id, array_to_string(list_filter(seen, lambda u: u IN ('click', 'view', 'error')), ',') AS present, array_to_string(list_filter(['click', 'error', 'view'], lambda u: NOT list_contains(seen, u)), ',') AS absent, array_to_string(list_sort(list_distinct(list_concat(seen, ['audit']))), ',') AS together FROM s""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.array(F.lit("click"), F.lit("error"), F.lit("view"))
    s = sessions(spark, sf_dir).where("conf > 200").groupBy("track_id").agg(F.array_sort(F.collect_set("label")).alias("seen"))
    return s.select("track_id", F.array_join(F.array_sort(F.array_intersect("seen", wanted)), ",").alias("present"), F.array_join(F.array_except(wanted, "seen"), ",").alias("absent"), F.array_join(F.array_sort(F.array_union("seen", F.array(F.lit("audit")))), ",").alias("together"))


@query(f"WITH {EV} SELECT camera, event_id, conf, frame, row_number() OVER (PARTITION BY camera ORDER BY conf DESC, frame, event_id) AS rank FROM ev QUALIFY rank <= 5")
def top_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best frames of each camera: a top-k report."""
    w = Window.partitionBy("camera").orderBy(F.desc("conf"), "frame", "event_id")
    return events(spark, sf_dir).select("camera", "event_id", "conf", "frame", F.row_number().over(w).alias("rank")).where("rank <= 5")


@query(f"WITH {_UNITS}, n AS (SELECT batch, camera, unit_id, regexp_extract(unit_id, '(\\d+)$', 1)::BIGINT AS k FROM units) SELECT batch, camera, unit_id, row_number() OVER (PARTITION BY batch, camera ORDER BY k) AS by_number, row_number() OVER (PARTITION BY batch, camera ORDER BY unit_id) AS by_text FROM n")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Window.partitionBy(*GROUP)
    return master_units(spark, sf_dir).select(*GROUP, "unit_id", F.row_number().over(p.orderBy(S.natural_key(F.col("unit_id")))).alias("by_number"), F.row_number().over(p.orderBy("unit_id")).alias("by_text"))


@query(f"""WITH {_UNITS}, r AS (SELECT batch, camera, unit_id, row_number() OVER (PARTITION BY batch, camera ORDER BY us) + CASE WHEN us % 50 = 0 THEN 1 ELSE 0 END AS ix, us AS s, ue AS e FROM units),
c AS (SELECT *, row_number() OVER w AS pos, lag(e) OVER w AS pe FROM r WINDOW w AS (PARTITION BY batch, camera ORDER BY ix, unit_id))
SELECT batch, camera, unit_id, unnest(list_filter([CASE WHEN unit_id <> 'GW_' || ix THEN 'id does not match the index' END, CASE WHEN ix <> pos THEN 'index is not the position' END, CASE WHEN e < s THEN 'span runs backwards' END, CASE WHEN s <= pe THEN 'span overlaps the one before' END], lambda x: x IS NOT NULL)) AS problem FROM c""")
def roster_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy(*GROUP).orderBy("unit_start")
    roster = master_units(spark, sf_dir).withColumn("unit_index", F.row_number().over(w) + F.when(F.col("unit_start") % 50 == 0, 1).otherwise(0))
    roster = roster.withColumnsRenamed({"unit_start": "start_frame", "unit_end": "end_frame"})
    return validate.roster_problems(roster, GROUP)


@query("WITH s AS (SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' GROUP BY ALL) SELECT n.n_name AS nation, c_mktsegment AS segment, count(*) AS customers, sum(s.n)::BIGINT AS orders, count(*) FILTER (s.n = 0) AS idle, bool_or(s.n = 0) AS partial FROM s JOIN nation n ON n.n_nationkey = s.c_nationkey GROUP BY ALL")
def completion_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    units = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment")).join(orders, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return units.join(nation, "c_nationkey").groupBy("nation", "segment").agg(F.count("*").alias("customers"), F.sum("n").alias("orders"), F.count_if(F.col("n") == 0).alias("idle"), F.bool_or(F.col("n") == 0).alias("partial"))


@query("SELECT conv_id, role, count(*) AS turns, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY ALL UNION ALL SELECT conv_id, 'all', count(*), min(turn), max(turn) FROM conversations GROUP BY conv_id")
def union_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    agg = [F.count("*").alias("turns"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn")]
    return c.groupBy("conv_id", "role").agg(*agg).unionByName(c.groupBy("conv_id").agg(*agg).withColumn("role", F.lit("all")))
