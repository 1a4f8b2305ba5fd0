"""The derived tables of ``derived.py`` in plain SQL, for checking queries with another engine."""

from __future__ import annotations

VIEWS = {
    "det": """
SELECT camera_id, frame_number, scene * 60.0e0 + k * 0.2e0 AS ts_sec, event_id AS det_id, CAST(cls AS INT) AS class_id,
  CAST(x0 + CASE role WHEN 0 THEN 0 WHEN 1 THEN j - 20 ELSE j + 10 END AS INT) AS x,
  CAST(y0 + CASE role WHEN 0 THEN 0 WHEN 1 THEN j + 70 ELSE j + 5 END AS INT) AS y,
  CASE role WHEN 0 THEN 50 WHEN 1 THEN 100 ELSE 30 END AS w,
  CASE role WHEN 0 THEN 120 WHEN 1 THEN 80 ELSE 30 END AS h,
  0.25e0 + ((event_id * 37) % 75) / 100.0e0 AS conf
FROM (SELECT event_id, role, scene, k, concat('cam', CAST(scene % 3 + 1 AS VARCHAR)) AS camera_id,
        scene * 8 + k AS frame_number,
        (g * 7919) % 1600 + k * ((g * 31) % 61 - 30) AS x0, (g * 104729) % 800 + k * ((g * 17) % 81 - 40) AS y0,
        user_id % 20 - 10 AS j,
        CASE role WHEN 0 THEN 0
                  WHEN 1 THEN CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 5 END
                  ELSE CASE WHEN user_id % 2 = 0 THEN 6 ELSE 7 END END AS cls
      FROM (SELECT event_id, user_id, event_id // 3 AS g, event_id % 3 AS role, event_id // 30 AS scene,
              unnest([0,1,2,3,4,5,6,7]) AS k FROM events) e) b""",
    "cl": """
SELECT camera_id, frame_number, ts_sec, det_id, class_id, greatest(0, x) AS x, greatest(0, y) AS y,
  greatest(0, least(w, 1920 - greatest(0, x))) AS w, greatest(0, least(h, 1080 - greatest(0, y))) AS h, conf FROM det""",
    "light": """
SELECT DISTINCT camera_id, frame_number,
  CASE (frame_number // 8 + (frame_number % 8) // 4) % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN' WHEN 2 THEN 'YELLOW'
  ELSE 'UNKNOWN' END AS light_state FROM det""",
    "viol": """
SELECT event_id AS violation_id, ts AS detected_at, concat('cam', CAST(user_id % 30 AS VARCHAR)) AS camera_id,
  user_id AS track_id,
  CASE event_type WHEN 'click' THEN 'no_helmet' WHEN 'view' THEN 'RED_LIGHT' WHEN 'purchase' THEN 'lane_violation'
       WHEN 'signup' THEN 'stop_line_crossing' ELSE 'red_light_running' END AS violation_type,
  CASE event_id % 5 WHEN 0 THEN 'car' WHEN 1 THEN 'motorcycle' WHEN 2 THEN 'bus' WHEN 3 THEN 'truck' END AS vehicle_type,
  ((event_id * 37) % 100) / 100.0e0 AS confidence, value, props FROM events""",
    "cams": """
SELECT concat('cam', CAST(n_nationkey AS VARCHAR)) AS camera_id, n_name AS name, r_name AS location,
  n_nationkey % 5 <> 0 AS is_active FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pixels": """
SELECT image_id, (image_id * 37 + l_partkey % 25) % 181 AS h, (l_suppkey * 13 + l_partkey) % 256 AS s,
  (l_orderkey * 29 + l_suppkey) % 256 AS v
FROM (SELECT l_orderkey % 20 AS image_id, l_orderkey, l_partkey, l_suppkey FROM lineitem) p""",
    "cfg": """
SELECT * FROM (VALUES
  ('default', 1920, 1080, 640, 30, 'below', 900, 360, 1040, 470, 30),
  ('cam1', 1920, 1080, 700, 30, 'above', 60, 40, 220, 230, 40),
  ('cam2', 1280, 720, 480, 30, 'below', 980, 500, 1110, 610, 30),
  ('cam3', 1280, 720, 421, 30, 'above', 440, 150, 530, 260, 30)
) t(camera_id, fw, fh, stop_y, tolerance, direction, lx1, ly1, lx2, ly2, threshold)""",
    "zone": """
SELECT * FROM (VALUES
  ('cam1', 0, 500, 260), ('cam1', 1, 1420, 280), ('cam1', 2, 1820, 1040), ('cam1', 3, 90, 1000),
  ('cam2', 0, 300, 200), ('cam2', 1, 60, 680), ('cam2', 2, 1180, 690), ('cam2', 3, 900, 210),
  ('cam3', 0, 421, 701), ('cam3', 1, 250, 150), ('cam3', 2, 640, 160), ('cam3', 3, 1010, 690)
) t(camera_id, n, px, py)""",
    "lines": """
SELECT * FROM (VALUES ('cam1', 0, 700, 300, 480, 980, 'solid'), ('cam1', 1, 960, 300, 980, 980, 'dashed'),
  ('cam1', 2, 1220, 310, 1460, 970, 'solid')) t(camera_id, line_id, x1, y1, x2, y2, type)""",
    # scaled to 1920 x 1080
    "cfgs": """
SELECT camera_id, CAST(trunc(stop_y * (1080.0e0 / fh)) AS INT) AS stop_y, tolerance, direction,
  CAST(trunc(lx1 * (1920.0e0 / fw)) AS INT) AS lx1, CAST(trunc(ly1 * (1080.0e0 / fh)) AS INT) AS ly1,
  CAST(trunc(lx2 * (1920.0e0 / fw)) AS INT) AS lx2, CAST(trunc(ly2 * (1080.0e0 / fh)) AS INT) AS ly2, threshold
FROM cfg""",
    "zones": """
SELECT z.camera_id, n, CAST(trunc(px * (1920.0e0 / fw)) AS INT) AS px, CAST(trunc(py * (1080.0e0 / fh)) AS INT) AS py
FROM zone z JOIN cfg USING (camera_id)""",
    "edges": """
SELECT a.camera_id, a.px AS x1, a.py AS y1, b.px AS x2, b.py AS y2
FROM zones a JOIN zones b ON a.camera_id = b.camera_id AND b.n = (a.n + 1) % 4""",
    # clamped boxes whose centre lies in the zone of their camera
    "zoned": """
SELECT cl.* FROM cl JOIN (
  SELECT cl.camera_id, cl.frame_number, cl.det_id, sum(CASE
    WHEN y + h / 2.0e0 > least(y1, y2) AND y + h / 2.0e0 <= greatest(y1, y2) AND x + w / 2.0e0 <= greatest(x1, x2)
     AND (x1 = x2 OR x + w / 2.0e0 <= (y + h / 2.0e0 - y1) * (x2 - x1) / nullif(CAST(y2 - y1 AS DOUBLE), 0) + x1)
    THEN 1 ELSE 0 END) AS toggles
  FROM cl JOIN edges USING (camera_id) GROUP BY ALL) z USING (camera_id, frame_number, det_id)
WHERE toggles % 2 = 1""",
    # side of and distance to every lane line, from the bottom centre
    "sided": """
SELECT p.*, l.line_id, l.type, threshold,
  CASE WHEN abs((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) < 1e-6 THEN 0
       WHEN (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) > 0 THEN 1 ELSE -1 END AS side,
  sqrt(pow(px - (x1 + t * (x2 - x1)), 2) + pow(py - (y1 + t * (y2 - y1)), 2)) AS distance
FROM (SELECT c.*, l.line_id AS lid, greatest(0.0e0, least(1.0e0,
        ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / CAST(pow(x2 - x1, 2) + pow(y2 - y1, 2) AS DOUBLE))) AS t
      FROM (SELECT *, x + w / 2.0e0 AS px, CAST(y + h AS DOUBLE) AS py FROM cl) c JOIN lines l USING (camera_id)) p
JOIN lines l ON l.camera_id = p.camera_id AND l.line_id = p.lid JOIN cfgs ON cfgs.camera_id = p.camera_id""",
    "persons": "SELECT * FROM cl WHERE class_id = 0",
    "bikes": "SELECT * FROM cl WHERE class_id IN (1, 3)",
    "helmets": "SELECT * FROM cl WHERE class_id = 6",
    "heads": "SELECT * FROM cl WHERE class_id = 7",
}

USES = {
    "cl": ["det"], "light": ["det"], "cfgs": ["cfg"], "zones": ["zone", "cfg"], "edges": ["zones"],
    "zoned": ["cl", "edges"], "sided": ["cl", "lines", "cfgs"], "persons": ["cl"], "bikes": ["cl"], "helmets": ["cl"],
    "heads": ["cl"],
}


#: Views that several others or both sides of a join read: computed once.
SHARED = {"det", "cl", "edges", "zoned", "sided", "persons", "bikes", "helmets", "heads"}


def sql_with(views: str, body: str, recursive: bool = False) -> str:
    """``body`` under the named views and whatever they use."""
    order: list[str] = []

    def need(name: str) -> None:
        for used in USES.get(name, []):
            need(used)
        if name not in order:
            order.append(name)

    for name in views.split():
        need(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}({VIEWS[n].strip()})" for n in order) + "\n" + body.strip()


def iou(a: str, b: str) -> str:
    """Overlap ratio of two aliases with x, y, w, h."""
    inter = (f"greatest(0, least({a}.x+{a}.w, {b}.x+{b}.w) - greatest({a}.x, {b}.x)) * "
             f"greatest(0, least({a}.y+{a}.h, {b}.y+{b}.h) - greatest({a}.y, {b}.y))")
    return f"(CAST({inter} AS DOUBLE) / ({a}.w*{a}.h + {b}.w*{b}.h - {inter} + CAST(1e-9 AS DOUBLE)))"


def feet_in(p: str, v: str) -> str:
    return (f"({p}.x + {p}.w/2.0e0 BETWEEN {v}.x AND {v}.x+{v}.w AND {p}.y+{p}.h BETWEEN {v}.y AND {v}.y+{v}.h)")


def head_in(h: str, p: str) -> str:
    return (f"({h}.x + {h}.w/2.0e0 BETWEEN {p}.x AND {p}.x+{p}.w AND "
            f"{h}.y + {h}.h/2.0e0 BETWEEN {p}.y AND {p}.y + {p}.h*0.5e0)")


def strip(p: str, ratio: str = "0.4e0") -> str:
    """Head region of an alias as a subquery-ready column list."""
    return f"{p}.x, {p}.y, {p}.w, CAST(greatest(1, trunc({p}.h * {ratio})) AS INT) AS h"


def tracked(source: str, reach: str = "100", ttl: str = "2") -> str:
    """Views that track the rows of ``source`` one after the other; ``tracks`` has their global track_id and is_new.

    Rows more than ``ttl`` seconds apart share no track, so the pieces between such pauses advance together.
    """
    order = "ts_sec, frame_number, det_id"
    return f"""
, paused AS (SELECT *, x + w / 2.0e0 AS cx, y + h / 2.0e0 AS cy,
    ts_sec - lag(ts_sec) OVER (PARTITION BY camera_id ORDER BY {order}) AS gap FROM {source}),
cut AS (SELECT *, sum(CASE WHEN gap <= {ttl} THEN 0 ELSE 1 END) OVER (PARTITION BY camera_id ORDER BY {order}) AS piece FROM paused),
seq AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY camera_id, piece ORDER BY {order}) AS n FROM cut),
walk AS (
  SELECT camera_id, piece, n, det_id, frame_number, CAST(1 AS BIGINT) AS id, true AS is_new, CAST(1 AS BIGINT) AS used,
    [{{'id': CAST(1 AS BIGINT), 'cx': cx, 'cy': cy, 't': ts_sec, 'f': frame_number}}] AS live FROM seq WHERE n = 1
  UNION ALL
  SELECT camera_id, piece, n, det_id, frame_number, CASE WHEN hit THEN best.id ELSE used + 1 END, NOT hit,
    CASE WHEN hit THEN used ELSE used + 1 END,
    CASE WHEN hit THEN list_transform(live, lambda k: CASE WHEN k.id = best.id
        THEN {{'id': k.id, 'cx': cx, 'cy': cy, 't': ts_sec, 'f': frame_number}} ELSE k END)
      ELSE list_append(live, {{'id': used + 1, 'cx': cx, 'cy': cy, 't': ts_sec, 'f': frame_number}}) END
  FROM (SELECT *, coalesce(best.d <= {reach}, false) AS hit FROM (
    SELECT *, list_sort(list_transform(list_filter(live, lambda k: k.f <> frame_number),
        lambda k: {{'d': sqrt(pow(cx - k.cx, 2) + pow(cy - k.cy, 2)), 'id': k.id}}))[1] AS best FROM (
      SELECT s.*, r.used, list_filter(r.live, lambda k: s.ts_sec - k.t <= {ttl}) AS live
      FROM walk r JOIN seq s ON s.camera_id = r.camera_id AND s.piece = r.piece AND s.n = r.n + 1) a) b) c),
named AS (SELECT camera_id, piece, id, row_number() OVER (PARTITION BY camera_id ORDER BY piece, n) AS track_id FROM walk WHERE is_new),
tracks AS MATERIALIZED (SELECT s.*, named.track_id, walk.is_new FROM walk JOIN seq s USING (camera_id, piece, n)
  JOIN named ON named.camera_id = walk.camera_id AND named.piece = walk.piece AND named.id = walk.id)"""


def recursive(views: str, *parts: str) -> str:
    """``parts`` (more views, each after a comma, then a query) under the named views."""
    return sql_with(views, "", recursive=True).rstrip() + "".join(parts)


#: Kept rows of ``reports`` (track_id, cx, cy): no kept row within 3 s shares their track or lies within 50 px.
KEPT = """
, gone AS (SELECT *, ts_sec - lag(ts_sec) OVER (PARTITION BY camera_id ORDER BY ts_sec, det_id) AS pause FROM reports),
parted AS (SELECT *, sum(CASE WHEN pause < 3 THEN 0 ELSE 1 END) OVER (PARTITION BY camera_id ORDER BY ts_sec, det_id) AS part FROM gone),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY camera_id, part ORDER BY ts_sec, det_id) AS n FROM parted),
fold AS (
  SELECT camera_id, part, n, true AS kept, [{'t': ts_sec, 'k': track_id, 'x': cx, 'y': cy}] AS recent FROM numbered WHERE n = 1
  UNION ALL
  SELECT camera_id, part, n, NOT seen, CASE WHEN seen THEN recent ELSE list_append(recent, {'t': ts_sec, 'k': track_id, 'x': cx, 'y': cy}) END
  FROM (SELECT *, len(list_filter(recent, lambda r: r.k = track_id OR sqrt(pow(cx - r.x, 2) + pow(cy - r.y, 2)) < 50)) > 0 AS seen FROM (
    SELECT s.*, list_filter(f.recent, lambda r: s.ts_sec - r.t < 3) AS recent
    FROM fold f JOIN numbered s ON s.camera_id = f.camera_id AND s.part = f.part AND s.n = f.n + 1) a) b),
kept_rows AS (SELECT s.* FROM numbered s JOIN fold f ON f.camera_id = s.camera_id AND f.part = s.part AND f.n = s.n AND f.kept)"""


#: Lane rule on ``tracks`` (lines 0 and 2 of a camera are solid): first line crossed in a frame, reports of a track 3 s apart.
LANE_WALK = """
, ticks AS (SELECT camera_id, frame_number, dense_rank() OVER (PARTITION BY camera_id ORDER BY frame_number) AS idx
  FROM (SELECT DISTINCT camera_id, frame_number FROM cl)),
sides AS (SELECT camera_id, frame_number, det_id, any_value(threshold) AS threshold,
    max(side) FILTER (line_id = 0) AS s0, max(distance) FILTER (line_id = 0) AS d0,
    max(side) FILTER (line_id = 2) AS s2, max(distance) FILTER (line_id = 2) AS d2 FROM sided GROUP BY ALL),
sights AS MATERIALIZED (SELECT t.*, idx, threshold, s0, d0, s2, d2, row_number() OVER (PARTITION BY camera_id, track_id ORDER BY idx) AS m
  FROM tracks t JOIN ticks USING (camera_id, frame_number) JOIN sides USING (camera_id, frame_number, det_id)),
watch AS (
  SELECT camera_id, track_id, m, idx, nullif(s0, 0) AS p0, nullif(s2, 0) AS p2, CAST(NULL AS INT) AS line, CAST(NULL AS INT) AS was,
    CAST(NULL AS INT) AS now, CAST(NULL AS DOUBLE) AS last, vehicle_type FROM sights WHERE m = 1
  UNION ALL
  SELECT camera_id, track_id, m, idx, CASE WHEN goes_on THEN coalesce(nullif(s0, 0), p0) ELSE nullif(s0, 0) END,
    CASE WHEN NOT goes_on THEN nullif(s2, 0) WHEN f0 THEN p2 ELSE coalesce(nullif(s2, 0), p2) END,
    CASE WHEN kept THEN hit END, CASE WHEN kept AND hit = 0 THEN p0 WHEN kept THEN p2 END, CASE WHEN kept AND hit = 0 THEN s0 WHEN kept THEN s2 END,
    CASE WHEN kept THEN ts_sec ELSE last END, first_type
  FROM (SELECT *, hit IS NOT NULL AND (last IS NULL OR ts_sec - last >= 3) AS kept FROM (
    SELECT *, CASE WHEN f0 THEN 0 WHEN goes_on AND p2 <> s2 AND s2 <> 0 AND d2 < 2 * threshold THEN 2 END AS hit FROM (
      SELECT *, coalesce(goes_on AND p0 <> s0 AND s0 <> 0 AND d0 < 2 * threshold, false) AS f0 FROM (
        SELECT s.*, w.p0, w.p2, w.last, w.vehicle_type AS first_type, s.idx = w.idx + 1 AS goes_on
        FROM watch w JOIN sights s ON s.camera_id = w.camera_id AND s.track_id = w.track_id AND s.m = w.m + 1) a) b) c) d)"""

KIND = "CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' END AS vehicle_type"
