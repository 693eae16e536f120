"""Named queries: runs of one camera's features, reports, snapshots, fallbacks and the scalar functions behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import scalars as S
from trackloom.operators import aggregates as A
from trackloom.operators import fuse, joins, stateful, validate
from trackloom.operators import reports as R
from trackloom.plans.ordered import _CASC, _ROLE, GROUP, cascaded, role
from trackloom.plans.relational import _BOX, _UNITS, local_segments, master_units
from trackloom.plans.stage import BATCH, EV, READ, SESS, TRK, events, query, readings, sessions, table, tracks

_UNIT = """un AS (SELECT o_orderkey AS unit, o_custkey % 4 AS camera, o_custkey AS batch, year(o_orderdate) AS year, CASE o_orderkey % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'PARTIAL_OPEN' WHEN 2 THEN 'DAMAGED' ELSE 'CLOSED' END AS l, CASE o_custkey % 3 WHEN 0 THEN 'OPEN' ELSE 'CLOSED' END AS r,
  o_orderstatus = 'F' AS damaged, CASE WHEN o_custkey % 5 > 0 THEN 'x' END AS id, CASE WHEN o_custkey % 7 > 0 THEN 'LOADED' ELSE 'NO_DATA' END AS load FROM orders),
it AS (SELECT unit, camera, batch, unnest(a) AS item, unnest(range(len(a))) AS place FROM (SELECT *, list_filter([CASE WHEN l IN ('OPEN', 'DAMAGED') THEN 'LEFT DOOR ' || l END, CASE WHEN r = 'OPEN' THEN 'RIGHT DOOR OPEN' END, CASE WHEN l = 'PARTIAL_OPEN' THEN 'PARTIAL DOOR' END, CASE WHEN damaged THEN 'DAMAGE' END, CASE WHEN id IS NULL THEN 'NO IDENTIFIER' END, CASE WHEN load = 'NO_DATA' THEN 'NO LOAD DATA' END], lambda x: x IS NOT NULL) AS a FROM un)),
sv AS (SELECT *, CASE WHEN item = 'PARTIAL DOOR' THEN 'MEDIUM' WHEN item LIKE '%DAMAGE%' OR item LIKE '%OPEN%' THEN 'HIGH' ELSE 'LOW' END AS severity FROM it)"""


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as wagons with the states of their doors, damage, identifier and load; a customer's orders are a batch."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    left = F.when(k % 4 == 0, "OPEN").when(k % 4 == 1, "PARTIAL_OPEN").when(k % 4 == 2, "DAMAGED").otherwise("CLOSED")
    rows = table(spark, sf_dir, "orders").select(k.alias("unit"), (c % 4).alias("camera"), c.alias("batch"), F.year("o_orderdate").cast("long").alias("year"), left.alias("l"), F.when(c % 3 == 0, "OPEN").otherwise("CLOSED").alias("r"), (F.col("o_orderstatus") == "F").alias("damaged"), F.when(c % 5 > 0, "x").alias("id"), F.when(c % 7 > 0, "LOADED").otherwise("NO_DATA").alias("load"))
    return rows.withColumn("anomalies", fuse.unit_anomalies(F.lit("WAGON"), F.col("l"), F.col("r"), F.col("damaged"), F.col("id"), F.col("load")))


@query(f"WITH {_UNIT} SELECT unit, place, item, severity FROM sv")
def report_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.report_items(units(spark, sf_dir), ["unit"], "anomalies")


@query(f"WITH {_UNIT} SELECT camera, severity, list_position(['HIGH', 'MEDIUM', 'LOW'], severity) AS rank, count(*) AS n FROM sv GROUP BY ALL")
def anomalies_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.by_severity(R.report_items(units(spark, sf_dir), ["unit", "camera"], "anomalies"), ["camera"])


@query(f"WITH {_UNIT} SELECT batch, year, CASE WHEN bool_or(EXISTS (SELECT 1 FROM it WHERE it.unit = un.unit)) THEN 'NOT OK' ELSE 'OK' END AS status, count(*) AS units FROM un GROUP BY ALL")
def overall_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.overall_status(units(spark, sf_dir), ["batch", "year"], F.size("anomalies") > 0)


@query(f"WITH {_UNIT} SELECT camera, state, count(*) AS n FROM (SELECT camera, unnest([l, r, CASE WHEN damaged THEN 'DAMAGE' ELSE 'OK' END]) AS state FROM un) GROUP BY ALL")
def detection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by camera and state of what a report lists: both doors and damage."""
    states = F.array("l", "r", F.when(F.col("damaged"), "DAMAGE").otherwise("OK"))
    return units(spark, sf_dir).select("camera", F.explode(states).alias("state")).groupBy("camera", "state").agg(F.count("*").alias("n"))


@query(f"WITH {_UNIT} SELECT unit, side, state FROM (SELECT unit, unnest(['left', 'right']) AS side, unnest([l, r]) AS state FROM un) WHERE state LIKE '%DAMAGE%' OR state LIKE '%OPEN%'")
def view_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.view_rows(units(spark, sf_dir), ["unit"], {"left": "l", "right": "r"})


@query(f"WITH {_UNIT} SELECT unit, coalesce(id, '-') AS number, CASE load WHEN 'LOADED' THEN 'LOADED WAGON' WHEN 'EMPTY' THEN 'EMPTY WAGON' ELSE 'WAGON' END AS kind, replace(l, '_', ' ') || ' / ' || replace(r, '_', ' ') AS doors FROM un")
def text_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = F.col("load")
    return units(spark, sf_dir).select("unit", F.coalesce("id", F.lit("-")).alias("number"), F.when(load.isin("LOADED", "EMPTY"), F.concat(load, F.lit(" WAGON"))).otherwise("WAGON").alias("kind"), F.concat_ws(" / ", S.door_status(F.col("l")), S.door_status(F.col("r"))).alias("doors"))


@query(f"WITH {_UNIT} SELECT unit, array_to_string(list_filter([CASE WHEN l IN ('OPEN', 'DAMAGED', 'PARTIAL_OPEN') THEN 'left' END, CASE WHEN r = 'OPEN' THEN 'right' END, CASE WHEN damaged THEN 'top' END], lambda x: x IS NOT NULL), ',') AS cameras FROM un")
def authoritative_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = R.raised_by(("left", F.col("l") != "CLOSED"), ("right", F.col("r") != "CLOSED"), ("top", F.col("damaged")))
    return units(spark, sf_dir).select("unit", F.array_join(raised, ",").alias("cameras"))


@query(f"WITH {_UNIT} SELECT unit, CASE WHEN load <> 'NO_DATA' THEN load WHEN damaged THEN 'LOADED' ELSE 'NO_DATA' END AS load FROM un")
def load_authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right top camera's load, or the left one's where that has none."""
    return units(spark, sf_dir).select("unit", R.first_with_data(F.col("load"), F.when(F.col("damaged"), "LOADED").otherwise("NO_DATA")).alias("load"))


@query("SELECT o_orderkey, coalesce(nullif(o_custkey % 3, 0), o_orderkey % 5, 0) AS engines FROM orders")
def count_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", R.count_or(F.col("o_custkey") % 3, F.col("o_orderkey") % 5).alias("engines"))


@query(f"WITH {TRK} SELECT batch, camera, track_id, row_number() OVER (PARTITION BY batch, camera ORDER BY conf_sum DESC, track_id) AS place FROM trk WHERE hits >= 2")
def camera_damage_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.own_tracks(tracks(spark, sf_dir).where("hits >= 2"), "camera", "conf_sum", "track_id").select(*GROUP, "track_id", "place")


@query(f"WITH {TRK} SELECT start_frame // 60 AS hour, string_agg(DISTINCT camera::VARCHAR, ',' ORDER BY camera::VARCHAR) AS cameras FROM trk WHERE hits >= 3 GROUP BY hour")
def damage_camera_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.array_sort(F.collect_set(F.col("camera").cast("string")))
    return tracks(spark, sf_dir).where("hits >= 3").groupBy(F.floor(F.col("start_frame") / 60).alias("hour")).agg(F.array_join(seen, ",").alias("cameras"))


@query(f"WITH {TRK} SELECT batch, camera, arg_max(track_id, (conf_sum, -track_id)) FILTER (x_end > 300) AS track_id, count(*) FILTER (x_end > 300) AS with_snapshot FROM trk GROUP BY ALL")
def best_own_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.best_snapshot(tracks(spark, sf_dir), GROUP, "conf_sum", "track_id", F.col("x_end") > 300)


_MID = SESS + """, fr AS (SELECT DISTINCT track_id, frame FROM sess), pl AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame) - 1 AS i, count(*) OVER (PARTITION BY track_id) AS n FROM fr),
mid AS (SELECT track_id, max(frame) FILTER (i = n // 2) AS by_place, (min(frame) + max(frame)) // 2 AS by_span FROM pl GROUP BY track_id)"""


@query(f"WITH {_MID} SELECT * FROM mid")
def mid_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mid_frame(sessions(spark, sf_dir), ["track_id"], "frame")


@query(f"WITH {_MID}, ev1 AS (SELECT track_id, min(frame) AS own FROM sess WHERE label = 'error' GROUP BY track_id) SELECT track_id, coalesce(own, by_place) AS frame, CASE WHEN own IS NOT NULL THEN 'evidence' ELSE 'mid frame' END AS source FROM mid LEFT JOIN ev1 USING (track_id)")
def panel_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a panel shows: a track's own evidence, else its middle frame."""
    s = sessions(spark, sf_dir)
    own = s.where("label = 'error'").groupBy("track_id").agg(F.min("frame").alias("own"))
    return R.mid_frame(s, ["track_id"], "frame").join(own, "track_id", "left").select("track_id", F.coalesce("own", "by_place").alias("frame"), F.when(F.col("own").isNotNull(), "evidence").otherwise("mid frame").alias("source"))


_DOOR = SESS + """, ob AS (SELECT camera, track_id, event_id, frame, conf, CASE label WHEN 'view' THEN 'OPEN' WHEN 'click' THEN 'CLOSED' WHEN 'signup' THEN 'PARTIAL' END AS state FROM sess),
c AS (SELECT camera, track_id, state, count(DISTINCT frame) AS frames, avg(conf) AS m FROM ob WHERE state IS NOT NULL GROUP BY ALL), n AS (SELECT camera, track_id, count(DISTINCT frame) AS used FROM ob GROUP BY ALL), sn AS (SELECT camera, track_id, count(DISTINCT frame) AS total FROM ob WHERE state IS NOT NULL GROUP BY ALL),
b AS (SELECT * FROM c JOIN sn USING (camera, track_id) QUALIFY row_number() OVER (PARTITION BY camera, track_id ORDER BY frames DESC, m DESC, state) = 1),
res AS (SELECT n.camera, n.track_id, used, CASE WHEN frames >= 2 AND frames::DOUBLE / total >= 0.34 THEN state END AS state, CASE WHEN frames >= 2 AND frames::DOUBLE / total >= 0.34 THEN m END AS m FROM n LEFT JOIN b USING (camera, track_id)),
door AS (SELECT camera, track_id, used, coalesce(state, 'CLOSED') AS reported, CASE WHEN state IS NULL THEN 0 ELSE m END AS confidence FROM res)"""


@query(f"""WITH {_DOOR}, pk AS (SELECT ob.camera, ob.track_id, event_id, state, state = reported AS matches FROM ob JOIN door USING (camera, track_id) WHERE state IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ob.camera, ob.track_id ORDER BY (state = reported) DESC, conf DESC, event_id) = 1)
SELECT door.camera, door.track_id, used, reported, confidence, event_id, state AS picked_state, coalesce(matches, false) AS matches FROM door LEFT JOIN pk USING (camera, track_id)""")
def door_camera_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a door: its state by repeated evidence, CLOSED without any, and the sighting to show for it."""
    s = sessions(spark, sf_dir)
    names = F.create_map(*[F.lit(v) for v in ("view", "OPEN", "click", "CLOSED", "signup", "PARTIAL")])
    rows = s.select("camera", "track_id", "event_id", "frame", "conf", names[F.col("label")].alias("state"))
    keys = ["camera", "track_id"]
    used = rows.groupBy(*keys).agg(F.countDistinct("frame").alias("used"))
    known = rows.where("state IS NOT NULL")
    resolved = A.resolve_state(known, keys, "state", "frame", "conf").select(*keys, "state", "mean_weight")
    state, confidence = R.door_default(F.col("state"), F.col("mean_weight"), F.col("used"))
    doors = used.join(resolved, keys, "left").select(*keys, "used", state.alias("reported"), confidence.alias("confidence"))
    picks = R.evidence_pick(known.join(doors.select(*keys, "reported"), keys), keys, "state", "reported", "conf", "event_id")
    return doors.join(picks, keys, "left").withColumn("matches", F.coalesce("matches", F.lit(False)))


@query(f"WITH {_DOOR} SELECT camera, reported, count(*) AS doors, count(*) FILTER (reported = 'OPEN') AS open, sum(used)::BIGINT AS frames FROM door GROUP BY ALL")
def door_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doors by state, and the open ones."""
    return door_camera_run(spark, sf_dir).groupBy("camera", "reported").agg(F.count("*").alias("doors"), F.count_if(F.col("reported") == "OPEN").alias("open"), F.sum("used").alias("frames"))


def _damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections that pass the damage filter, as boxes."""
    e = events(spark, sf_dir).where((F.col("label") != "view") & (F.col("conf") >= 100))
    return e.select("sensor", F.floor(F.col("frame") / 360).alias("frame"), F.col("conf").alias("confidence"), (F.col("x") % 848).cast("double").alias("x1"), F.lit(100.0).alias("y1"), (F.col("x") % 848 + 40).cast("double").alias("x2"), F.lit(300.0).alias("y2"), F.col("event_id").alias("key"))


@query()
def damage_run_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a damage track of at least two hits, tracked over every frame."""
    rows = _damage(spark, sf_dir)
    found = stateful.track_optimal(rows.select("sensor", "frame", F.col("x1").alias("x"), F.col("y1").alias("y"), "key"), ["sensor"], 200.0, 6, 2)
    return found.join(rows, ["sensor", "key"]).groupBy("sensor", "track").agg(F.count("*").alias("hits"), F.min("frame").alias("first"), F.max("frame").alias("last"), F.max("confidence").alias("confidence")).where("hits >= 2")


@query()
def damage_run_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns from every second frame only: sightings grouped as evidence, accepted with two different frames."""
    rows = _damage(spark, sf_dir).where("frame % 2 = 0")
    found = stateful.group_evidence(rows, ["sensor"], stateful.EvidenceConfig(stride=2))
    out = found.join(rows, ["sensor", "key"]).groupBy("sensor", F.col("candidate").alias("track")).agg(F.count("*").alias("hits"), F.min("frame").alias("first"), F.max("frame").alias("last"), F.max("confidence").alias("confidence"), F.countDistinct("frame").alias("frames"))
    return out.where("frames >= 2").drop("frames")


@query(f"WITH {READ} SELECT unit, number, CASE WHEN length(number) = 11 THEN 10.0 ELSE 0.0 END::DOUBLE + weight AS score, o_orderkey FROM rd QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, o_orderkey) = 1")
def ocr_unit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.best_reading(readings(spark, sf_dir), ["unit"], "number", "weight", "o_orderkey")


@query(f"WITH {READ} SELECT unit, string_agg(number, '' ORDER BY weight, o_orderkey) AS text, avg(weight) AS confidence FROM rd GROUP BY unit")
def text_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.text_rows(readings(spark, sf_dir), ["unit"], "weight", "number", "weight", "o_orderkey")


@query(f"WITH {EV} SELECT camera, frame, label, conf FROM ev QUALIFY row_number() OVER (PARTITION BY camera, frame ORDER BY conf DESC, event_id) = 1")
def frame_top_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_class(events(spark, sf_dir), ["camera", "frame"], "label", "conf", "event_id")


@query(f"""WITH {_UNITS}, sm AS (SELECT u.batch, u.camera, u.unit_id, {_ROLE} AS role, conf FROM ev JOIN units u ON u.batch = ev.batch AND u.camera = ev.camera AND frame >= us AND frame < ue WHERE label <> 'purchase'),
c AS (SELECT batch, camera, unit_id, role, count(*) AS n, avg(conf) AS m FROM sm GROUP BY ALL), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY batch, camera, unit_id ORDER BY n DESC, m DESC, role) = 1), t AS (SELECT batch, camera, unit_id, sum(n)::BIGINT AS samples FROM c GROUP BY ALL)
SELECT u.batch, u.camera, u.unit_id, coalesce(role, 'WAGON') AS role, coalesce(samples, 0) AS samples FROM units u LEFT JOIN b USING (batch, camera, unit_id) LEFT JOIN t USING (batch, camera, unit_id)""")
def segment_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label for each unit, by the samples that fall into it, with their number."""
    u = master_units(spark, sf_dir)
    e = events(spark, sf_dir).where("label <> 'purchase'").select(*GROUP, "event_id", "frame", "conf", role().alias("role")).withColumn("till", F.col("frame") + 1)
    inside = joins.overlap_pairs(e, u, GROUP, ("frame", "till"), ("unit_start", "unit_end"), 720)
    keys = [*GROUP, "unit_id"]
    votes = A.majority_vote(inside, keys, "role", "conf").select(*keys, "role")
    samples = inside.groupBy(*keys).agg(F.count("*").alias("samples"))
    return u.select(*keys).join(votes, keys, "left").join(samples, keys, "left").select(*keys, F.coalesce("role", F.lit("WAGON")).alias("role"), F.coalesce("samples", F.lit(0)).alias("samples"))


#: Clock offset, frames a second and frames of the cameras on which units are shown (fixed values of the example).
CAMERAS = (("left", 0.0, 15.0, 38_880_000), ("right", 16.5, 15.0, 30_000_000), ("top", -3.5, 10.0, 17_280_000))


@query(f"""WITH {_UNITS}, cams(cam, delta, fps, total) AS (VALUES {', '.join(f"('{n}', {d}::DOUBLE, {f}::DOUBLE, {t})" for n, d, f, t in CAMERAS)}),
fr AS (SELECT batch, camera, unit_id, cam AS on_camera, total, round_even((us * 60.0::DOUBLE - delta) * fps, 0)::BIGINT AS a, round_even((ue * 60.0::DOUBLE - delta) * fps, 0)::BIGINT - 1 AS b FROM units, cams)
SELECT batch, camera, unit_id, on_camera, greatest(a, 0) AS "start", least(b, total - 1) AS "end" FROM fr WHERE b >= 0 AND a < total AND b >= a""")
def camera_window_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units on the clocks of three cameras; those outside a camera's footage are left out."""
    rows = R.window_map(master_units(spark, sf_dir), CAMERAS, F.col("unit_start") * 60.0, F.col("unit_end") * 60.0)
    return rows.select(*GROUP, "unit_id", "on_camera", "start", "end")


@query(f"""WITH {_UNITS}, fu AS (SELECT batch, camera, unit_id FROM units QUALIFY min(us) OVER (PARTITION BY batch, camera) - batch * {BATCH} < 60) SELECT batch, camera, unit_id, false AS fallback FROM fu
UNION ALL SELECT batch, camera, unit_id, true FROM units WHERE NOT EXISTS (SELECT 1 FROM fu WHERE fu.batch = units.batch AND fu.camera = units.camera)""")
def assembled_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A camera's batch whose first unit begins within an hour counts as fused here; others fall back to the master's own."""
    master = master_units(spark, sf_dir)
    fused = master.withColumn("first", F.min("unit_start").over(Window.partitionBy(*GROUP)) - F.col("batch") * BATCH).where("first < 60")
    return R.assembled_or_master(fused.select(*GROUP, "unit_id"), master.select(*GROUP, "unit_id"), GROUP)


@query("SELECT event_id, coalesce(CAST(json_extract(props, '$.window_start') AS BIGINT), CAST(json_extract(props, '$.start') AS BIGINT), CAST(json_extract(props, '$.k') AS BIGINT)) AS window_start FROM events")
def window_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first spelling of a field that has a value."""
    names = ("window_start", "start", "k")
    parsed = F.from_json("props", ", ".join(f"`{n}` long" for n in names))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(*[parsed[n] for n in names]).alias("window_start"))


@query(f"""WITH {_CASC}, ac AS (SELECT batch, camera, start_frame FROM casc WHERE reason IS NULL), sp AS (SELECT batch, camera, min(start_frame) + 200 AS lo, max(end_frame) - 200 AS hi FROM casc GROUP BY ALL)
SELECT c.batch, c.camera, c.track_id, c.reason, c.severity, c.start_frame, c.end_frame, CASE WHEN c.start_frame < lo THEN 'PRE' WHEN c.start_frame > hi THEN 'POST' ELSE 'ACTIVE' END AS position,
  (SELECT max(a.start_frame) FROM ac a WHERE a.batch = c.batch AND a.camera = c.camera AND a.start_frame < c.start_frame) AS previous, (SELECT min(a.start_frame) FROM ac a WHERE a.batch = c.batch AND a.camera = c.camera AND a.start_frame >= c.start_frame) AS next,
  row_number() OVER (PARTITION BY c.batch, c.camera ORDER BY c.start_frame, c.track_id) AS place FROM casc c JOIN sp USING (batch, camera) WHERE c.reason IS NOT NULL""")
def rejection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row for each rejected track, in the order of its camera's report: reason, place in the batch, and the accepted tracks before and after."""
    w = Window.partitionBy(*GROUP)
    judged = cascaded(spark, sf_dir).withColumn("lo", F.min("start_frame").over(w) + 200).withColumn("hi", F.max("end_frame").over(w) - 200)
    accepted = F.when(F.col("reason").isNull(), F.col("start_frame"))
    back, ahead = w.orderBy("start_frame").rangeBetween(Window.unboundedPreceding, -1), w.orderBy(F.desc("start_frame")).rangeBetween(Window.unboundedPreceding, 0)
    rows = judged.withColumn("previous", F.max(accepted).over(back)).withColumn("next", F.min(accepted).over(ahead)).where("reason IS NOT NULL")
    return rows.select(*GROUP, "track_id", "reason", "severity", "start_frame", "end_frame", validate.position_of(F.col("start_frame"), F.col("lo"), F.col("hi")).alias("position"), "previous", "next", F.row_number().over(w.orderBy("start_frame", "track_id")).alias("place"))


@query(f"WITH {TRK} SELECT camera, sum(end_frame - start_frame + 1)::BIGINT AS busy, max(end_frame) - min(start_frame) + 1 AS span, sum(end_frame - start_frame + 1)::DOUBLE / (max(end_frame) - min(start_frame) + 1) AS overlap FROM trk GROUP BY camera")
def timing_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long a camera's parts take together, and how much they overlap."""
    busy, span = F.sum(F.col("end_frame") - F.col("start_frame") + 1), F.max("end_frame") - F.min("start_frame") + 1
    return tracks(spark, sf_dir).groupBy("camera").agg(busy.alias("busy"), span.alias("span"), (busy / span).alias("overlap"))


@query(f"WITH {EV} SELECT event_id, avg(CASE WHEN label = 'view' THEN 1.0::DOUBLE ELSE 0 END) OVER (PARTITION BY sensor ORDER BY t, event_id ROWS 29 PRECEDING) AS open_ratio, avg(conf) OVER (PARTITION BY sensor ORDER BY t, event_id ROWS 4 PRECEDING) AS recent_confidence FROM ev")
def buffer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.buffer_stats(events(spark, sf_dir), ["sensor"], ["t", "event_id"], F.col("label") == "view", "conf").select("event_id", "open_ratio", "recent_confidence")


@query(f"""WITH {EV}, r AS (SELECT sensor, event_id, conf, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS i FROM ev)
SELECT a.event_id, round(sum(b.conf * pow(0.85::DOUBLE, a.i - b.i)) / sum(pow(0.85::DOUBLE, a.i - b.i)), 6) AS decayed FROM r a JOIN r b ON a.sensor = b.sensor AND b.i BETWEEN a.i - 29 AND a.i GROUP BY a.event_id""")
def decayed_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.decayed_mean(events(spark, sf_dir), ["sensor"], ["t", "event_id"], "conf").select("event_id", F.round("decayed", 6).alias("decayed"))


@query(f"WITH {TRK} SELECT track_id, CASE WHEN hits < 3 THEN CASE WHEN conf_sum > 1000 THEN 'OPEN' ELSE 'CLOSED' END WHEN x_end > 500 AND conf_sum / hits::DOUBLE < 500 THEN 'PARTIAL_OPEN' WHEN x_end > 500 THEN 'OPEN' ELSE 'CLOSED' END AS decision FROM trk")
def track_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda open_: F.when(open_, "OPEN").otherwise("CLOSED")
    return tracks(spark, sf_dir).select("track_id", R.track_decision(name(F.col("x_end") > 500), name(F.col("conf_sum") > 1000), F.col("hits"), F.col("conf_sum") / F.col("hits"), sure=500).alias("decision"))


@query(f"WITH {EV} SELECT sensor, round(regr_slope(x, frame), 6) AS slope, count(*) AS n FROM ev GROUP BY sensor HAVING count(DISTINCT frame) > 1")
def gap_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of a width over time, where there are two times at least."""
    return events(spark, sf_dir).groupBy("sensor").agg(F.round(F.regr_slope("x", "frame"), 6).alias("slope"), F.count("*").alias("n"), F.countDistinct("frame").alias("f")).where("f > 1").drop("f")


@query(f"WITH {TRK}, s AS (SELECT track_id, (CASE WHEN hits % 2 = 0 THEN 0.3 ELSE 0 END + CASE WHEN x_end < x_start THEN 0.25 ELSE 0 END + CASE WHEN conf_sum % 2 = 0 THEN 0.2 ELSE 0 END + CASE WHEN x_end > 300 THEN 0.25 ELSE 0 END)::DOUBLE AS w, hits > 8 AS confirms FROM trk) SELECT track_id, CASE WHEN confirms THEN 'OPEN' WHEN round(w, 6) >= 0.7 THEN 'REJECTED' ELSE 'OPEN' END AS state FROM s")
def verifier_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = {"reflection": F.col("hits") % 2 == 0, "gap_trend": F.col("x_end") < F.col("x_start"), "consistency": F.col("conf_sum") % 2 == 0, "motion": F.col("x_end") > 300}
    return tracks(spark, sf_dir).select("track_id", S.verified(F.lit("OPEN"), evidence, F.col("hits") > 8).alias("state"))


@query(f"""WITH {TRK}, q AS (SELECT *, conf_sum / hits::DOUBLE / 1000 AS c, least(greatest((end_frame - start_frame) / 2 / 60.0::DOUBLE, 0.1), 1.0) AS s FROM trk),
p AS (SELECT a.track_id AS a, b.track_id AS b, abs(a.start_frame - b.start_frame)::DOUBLE AS d, a.c AS ca, b.c AS cb, sqrt(a.s * a.s + b.s * b.s) AS s FROM q a JOIN q b ON a.camera = b.camera AND a.batch = b.batch AND a.track_id < b.track_id AND abs(a.start_frame - b.start_frame) <= 90)
SELECT a, b, round(d / 30.0::DOUBLE * (1 + 0.25::DOUBLE * greatest(0, 1 - (ca + cb) / 2)), 9) AS cost, CASE WHEN d / 60 / s <= 3 THEN round(d / 60 / s / 3 * (1 + 0.25::DOUBLE * greatest(0, 1 - (ca + cb) / 2)), 9) END AS cost_by_sigma FROM p""")
def match_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What it costs to take two tracks of a camera's batch for one, for the pairs inside the gate of an hour and a half: by a fixed tolerance, and by how long the
    tracks are (null beyond three sigmas)."""
    t = tracks(spark, sf_dir).select(*GROUP, "track_id", "start_frame", "end_frame", (F.col("conf_sum") / F.col("hits") / 1000).alias("c"))
    t = t.withColumn("s", S.sigma(F.col("start_frame"), F.col("end_frame"), F.lit(60.0)))
    a = t.select(*GROUP, F.col("track_id").alias("a"), F.col("start_frame").alias("sa"), F.col("c").alias("ca"), F.col("s").alias("ga"), (F.col("start_frame") - 90).alias("lo"), (F.col("start_frame") + 90).alias("hi"))
    b = t.select(*GROUP, F.col("track_id").alias("b"), F.col("start_frame").alias("sb"), F.col("c").alias("cb"), F.col("s").alias("gb"), F.col("start_frame").alias("at"))
    pairs = joins.overlap_pairs(a, b, GROUP, ("lo", "hi"), ("sb", "at"), 180, inclusive=True).where("a < b")
    d = F.abs(F.col("sa") - F.col("sb")).cast("double")
    # Rounded as SQL does, in units of the last digit: a cost half way between two of them may be a double just below.
    rounded = lambda c: F.round(c * 1e9) / 1e9
    return pairs.select("a", "b", rounded(S.match_cost(d, F.col("ca"), F.col("cb"), 90, 30)).alias("cost"), rounded(S.match_cost_by_sigma(d / 60, F.col("ga"), F.col("gb"), F.col("ca"), F.col("cb"))).alias("cost_by_sigma"))


@query(f"""WITH {_BOX}, b AS (SELECT vec_id, 424 + x1 AS a1, 240 + y1 AS b1, 424 + x2 AS a2, 240 + y2 AS b2 FROM bx),
e AS (SELECT *, a1 <= 16.96 OR b1 <= 16.96 OR a2 >= 848 - 16.96 OR b2 >= 480 - 16.96 AS edge FROM b)
SELECT vec_id, edge, trunc(a1 / 50)::INT || ':' || trunc(b1 / 50)::INT AS cell, round(least(greatest((a1 + a2) / 2 - (a2 - a1) * 1.5 / 2, 0), 848), 6) AS left, round(least(greatest((b1 + b2) / 2 - (b2 - b1) * 1.5 / 2, 0), 480), 6) AS top, round(least(greatest((a1 + a2) / 2 + (a2 - a1) * 1.5 / 2, 0), 848), 6) AS "right", round(least(greatest((b1 + b2) / 2 + (b2 - b1) * 1.5 / 2, 0), 480), 6) AS bottom,
  round((0.35 * least(greatest(a2 - a1, 0) * greatest(b2 - b1, 0) / (848.0 * 480) * 4, 1) + 0.25 * greatest(1 - (abs((a1 + a2) / 2 / 848 - 0.5) + abs((b1 + b2) / 2 / 480 - 0.5)), 0) + 0.25 * 0.8 + 0.15 * 0.5) * CASE WHEN edge THEN 0.5 ELSE 1 END, 6) AS score FROM e""")
def snapshot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes near the middle of the frame: whether they touch its edge, their cell, their grown left side, and their score as a snapshot."""
    at = lambda k: (F.col("embedding")[k].cast("double") * 1000).cast("long").cast("double")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", (424 + F.least(at(0), at(1))).alias("a1"), (240 + F.least(at(2), at(3))).alias("b1"), (424 + F.greatest(at(0), at(1))).alias("a2"), (240 + F.greatest(at(2), at(3))).alias("b2"))
    box = tuple(F.col(c) for c in ("a1", "b1", "a2", "b2"))
    return rows.select("vec_id", S.at_edge(box, 848, 480, 16.96).alias("edge"), S.spatial_cell(box[0], box[1]).alias("cell"), *[F.round(side, 6).alias(n) for n, side in zip(("left", "top", "right", "bottom"), S.expanded(box, 1.5, 848, 480))], F.round(S.snapshot_score(box, F.lit(0.8), F.lit(0.5), 848, 480), 6).alias("score"))


@query("""WITH c AS (SELECT s_suppkey AS camera, (s_suppkey % 3) * 640.0::DOUBLE AS width, (s_suppkey % 4) * 10.0::DOUBLE AS fps FROM supplier), r AS (SELECT camera, CASE WHEN width > 0 THEN width ELSE 848 END AS w, CASE WHEN fps > 0 THEN fps ELSE 15 END AS f FROM c)
SELECT camera, greatest(round_even(0.27::DOUBLE * f, 0)::BIGINT, 1) AS min_track, greatest(round_even(1.33::DOUBLE * f, 0)::BIGINT, 1) AS max_missed, greatest(round_even(0.67::DOUBLE * f, 0)::BIGINT, 1) AS separation, round(0.0047::DOUBLE * w, 6) AS static_motion, round(0.0142::DOUBLE * w, 6) AS min_motion, round(0.0094::DOUBLE * w, 6) AS min_speed, round(2.36::DOUBLE * w, 6) AS max_speed, round(0.1415::DOUBLE * w, 6) AS duplicate_distance FROM r""")
def resolved_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as cameras of different widths and rates, some without."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("camera"), ((F.col("s_suppkey") % 3) * 640.0).alias("width"), ((F.col("s_suppkey") % 4) * 10.0).alias("fps"))
    return R.resolved_limits(s, validate.SECONDS, validate.WIDTHS)


@query(f"WITH {_UNITS}, a AS (SELECT batch, camera, count(*) AS local FROM loc GROUP BY ALL), b AS (SELECT batch, camera, count(*) AS units FROM units GROUP BY ALL) SELECT a.batch, a.camera, local, coalesce(units, 0) AS units FROM a LEFT JOIN b USING (batch, camera)")
def local_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local report's totals: segments of a camera's batch beside its units."""
    units_ = master_units(spark, sf_dir).groupBy(*GROUP).agg(F.count("*").alias("units"))
    return local_segments(spark, sf_dir).groupBy(*GROUP).agg(F.count("*").alias("local")).join(units_, GROUP, "left").select(*GROUP, "local", F.coalesce("units", F.lit(0)).alias("units"))


@query()
def revived_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a sensor's detections come to tracks: matched, revived, new or pending."""
    e = events(spark, sf_dir)
    rows = e.select("sensor", F.floor(F.col("frame") / 360).alias("frame"), (F.col("x") % 848).cast("double").alias("x1"), F.lit(100.0).alias("y1"), (F.col("x") % 848 + 120).cast("double").alias("x2"), F.lit(300.0).alias("y2"), (F.col("conf") / 1000).alias("look"), F.col("event_id").alias("key"))
    found = stateful.track_remembering(rows, ["sensor"], stateful.MemoryConfig(gate=150.0, max_missed=4, revive_frames=20, pending_gap=4, sightings=2))
    return found.groupBy("sensor", "how").agg(F.count("*").alias("n"), F.countDistinct("track").alias("tracks"))


@query(f"WITH {SESS} SELECT camera, frame, string_agg(DISTINCT track_id::VARCHAR, ',' ORDER BY track_id::VARCHAR) AS tracks, count(*) AS boxes FROM sess GROUP BY ALL")
def overlay_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is drawn on each frame of a camera: its tracks there, and how many boxes."""
    ids = F.array_sort(F.collect_set(F.col("track_id").cast("string")))
    return sessions(spark, sf_dir).groupBy("camera", "frame").agg(F.array_join(ids, ",").alias("tracks"), F.count("*").alias("boxes"))


@query(f"""WITH {TRK} SELECT a.track_id AS a, b.track_id AS b, round(greatest(least(a.end_frame, b.end_frame) - greatest(a.start_frame, b.start_frame) + 1, 0)::DOUBLE / greatest(least(a.end_frame - a.start_frame, b.end_frame - b.start_frame) + 1, 1), 6) AS share
FROM trk a JOIN trk b ON a.camera = b.camera AND a.batch = b.batch AND a.track_id < b.track_id AND a.start_frame <= b.end_frame AND b.start_frame <= a.end_frame""")
def span_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the shorter of two tracks of a camera's batch the other covers, for those that are seen together."""
    t = tracks(spark, sf_dir)
    side = lambda n: t.select(*GROUP, F.col("track_id").alias(n), F.col("start_frame").alias(f"s_{n}"), F.col("end_frame").alias(f"e_{n}"))
    pairs = joins.overlap_pairs(side("a"), side("b"), GROUP, ("s_a", "e_a"), ("s_b", "e_b"), 720, inclusive=True).where("a < b")
    return pairs.select("a", "b", F.round(S.overlap_of_shorter(F.col("s_a"), F.col("e_a"), F.col("s_b"), F.col("e_b")), 6).alias("share"))


@query("""WITH f AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'broken' ELSE 'cam' || user_id || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.mp4' END AS name FROM events)
SELECT event_id, name, CASE WHEN name <> 'broken' THEN 1706745600 - epoch(strptime(regexp_extract(name, '([0-9]{8}_[0-9]{6})', 1), '%Y%m%d_%H%M%S'))::BIGINT END AS age FROM f""")
def batch_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of recordings with the time in them, and how old each was at the end of the month; names without a time have no age."""
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "error", "broken").otherwise(F.concat(F.lit("cam"), F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".mp4")))
    return e.select("event_id", name.alias("name")).withColumn("age", S.age_seconds(F.col("name"), F.timestamp_seconds(F.lit(1706745600))))
