"""The fixture views as DuckDB common table expressions."""

PI = "pi()"
R = "6371000"


def lon(k: str, m: int, off: str = "0") -> str:
    return f"((106620000 + ({k} * {m}) % 26000 + {off}) / CAST(1e6 AS DOUBLE))"


def lat(k: str, m: int, off: str = "0") -> str:
    return f"((10750000 + ({k} * {m}) % 20000 + {off}) / CAST(1e6 AS DOUBLE))"


def pad(prefix: str, k: str, width: int) -> str:
    return f"('{prefix}' || lpad(CAST({k} AS VARCHAR), CAST(greatest({width}, length(CAST({k} AS VARCHAR))) AS INTEGER), '0'))"


def scenario(n: str) -> str:
    return pad("traffic_synthetic_", f"({n} + 1)", 3)


def deg_lat(m: str) -> str:
    return f"({m} / ({R} * {PI} / 180))"


def deg_lon(m: str, y: str) -> str:
    return f"({m} / (CAST({R} AS DOUBLE) * cos(radians({y})) * {PI} / CAST(180 AS DOUBLE)))"


def haversine(x1: str, y1: str, x2: str, y2: str) -> str:
    a = f"(sin(radians({y2} - {y1}) / 2) * sin(radians({y2} - {y1}) / 2))"
    b = f"(sin(radians({x2} - {x1}) / 2) * sin(radians({x2} - {x1}) / 2))"
    return f"(2.0 * {R} * asin(sqrt({a} + cos(radians({y1})) * cos(radians({y2})) * {b})))"


# h holds a hash as hex; a BIGINT from its first n digits
def hex_number(h: str, digits: int) -> str:
    return f"CAST(('0x' || substr({h}, 1, {digits})) AS BIGINT)"


VIEWS = {
    "scenarios": f"""
  SELECT {scenario('n_nationkey')} AS scenario_id, n_nationkey + 1 AS ord,
         TIMESTAMP '2024-01-30 23:30:00' AS time
  FROM nation""",
    "vehicles": f"""
  SELECT {scenario('c_nationkey')} AS scenario_id, c_custkey AS ord, {pad('vehicle_', 'c_custkey', 6)} AS id,
         'vehicle' AS type, c_name AS name, {pad('xe ', '(c_custkey % 1000)', 3)} AS alias,
         {lon('c_custkey', 7919)} AS lon, {lat('c_custkey', 104729)} AS lat
  FROM customer""",
    "cameras": f"""
  SELECT {scenario('s_nationkey')} AS scenario_id, 1000000000000 + s_suppkey AS ord, {pad('camera_', 's_suppkey', 6)} AS id,
         'camera' AS type, s_name AS name, {pad('cam ', '(s_suppkey % 100)', 2)} AS alias,
         {lon('s_suppkey', 6101)} AS lon, {lat('s_suppkey', 15013)} AS lat
  FROM supplier""",
    "zones": f"""
  SELECT scenario_id, ord, id, type, name, alias,
         round(cx - hw, 6) AS x0, round(cy - hh, 6) AS y0, round(cx + hw, 6) AS x1, round(cy + hh, 6) AS y1
  FROM (SELECT *, {deg_lon('(w / 2)', 'cy')} AS hw, {deg_lat('(h / 2)')} AS hh FROM (
    SELECT {scenario('(p_partkey % 25)')} AS scenario_id, 2000000000000 + p_partkey AS ord, {pad('zone_', 'p_partkey', 6)} AS id,
           'polygon' AS type, {pad('Zone ', 'p_partkey', 2)} AS name, {pad('vùng ', 'p_partkey', 2)} AS alias,
           {lon('p_partkey', 3571)} AS cx, {lat('p_partkey', 8837)} AS cy,
           CAST(300 + p_size * 10 AS DOUBLE) AS w, CAST(300 + p_partkey % 500 AS DOUBLE) AS h
    FROM part))""",
    "roads": f"""
  SELECT *, round(x2 + {deg_lon('st', 'y2')} * sin(hd), 6) AS x3, round(y2 + {deg_lat('st')} * cos(hd), 6) AS y3 FROM (
  SELECT *, round(x1 + {deg_lon('st', 'y1')} * sin(hd), 6) AS x2, round(y1 + {deg_lat('st')} * cos(hd), 6) AS y2 FROM (
  SELECT *, round(x0 + {deg_lon('st', 'y0')} * sin(hd), 6) AS x1, round(y0 + {deg_lat('st')} * cos(hd), 6) AS y1 FROM (
    SELECT {scenario('(p_partkey % 25)')} AS scenario_id, 3000000000000 + p_partkey AS ord, {pad('road_', 'p_partkey', 6)} AS id,
           'line' AS type, {pad('Road ', 'p_partkey', 2)} AS name, {pad('đường ', 'p_partkey', 2)} AS alias,
           radians(CAST((p_partkey * 37) % 360 AS DOUBLE)) AS hd, CAST(500 + (p_partkey * 13) % 1000 AS DOUBLE) / 3 AS st,
           {lon('p_partkey', 4409)} AS x0, {lat('p_partkey', 9973)} AS y0
    FROM part)))""",
    "objects": """
  SELECT scenario_id, ord, id, type, name, alias FROM vehicles UNION ALL
  SELECT scenario_id, ord, id, type, name, alias FROM cameras UNION ALL
  SELECT scenario_id, ord, id, type, name, alias FROM zones UNION ALL
  SELECT scenario_id, ord, id, type, name, alias FROM roads""",
    "traj": f"""
  SELECT {scenario('c_nationkey')} AS scenario_id, {pad('vehicle_', 'c_custkey', 6)} AS object_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, ts,
         {lon('c_custkey', 7919, '((event_id * 31) % 2001 - 1000) * 10')} AS lon,
         {lat('c_custkey', 104729, '((event_id * 53) % 2001 - 1000) * 10')} AS lat
  FROM events JOIN customer ON user_id = c_custkey""",
    "docs": f"""
  SELECT d.doc_id, d.text, d.family, d.kind, d.key,
         CASE kind WHEN 'vehicle' THEN {scenario('c_nationkey')} ELSE {scenario('(d.key % 25)')} END AS scenario_id,
         CASE kind WHEN 'vehicle' THEN {pad('vehicle_', 'd.key', 6)} WHEN 'polygon' THEN {pad('zone_', 'd.key', 6)}
                   ELSE {pad('road_', 'd.key', 6)} END AS target_id,
         CASE kind WHEN 'vehicle' THEN c_name WHEN 'polygon' THEN {pad('Zone ', 'd.key', 2)} ELSE {pad('Road ', 'd.key', 2)} END AS target_name
  FROM (SELECT *, CASE kind WHEN 'vehicle' THEN (doc_id * 7) % (SELECT count(*) FROM customer)
                            ELSE (doc_id * 7) % (SELECT count(*) FROM part) END AS key
        FROM (SELECT doc_id, text, doc_id % 10 AS family,
                     CASE WHEN doc_id % 10 IN (3, 5) THEN 'polygon' WHEN doc_id % 10 IN (4, 6) THEN 'line' ELSE 'vehicle' END AS kind
              FROM documents)) d
  LEFT JOIN customer ON kind = 'vehicle' AND c_custkey = d.key""",
    "bps": """
  SELECT doc_id, text, family, kind, scenario_id, target_id, target_name,
         CASE family WHEN 0 THEN 'draw_vehicle_trajectory' WHEN 1 THEN 'show_object_info' WHEN 2 THEN 'highlight_selected_entity'
              WHEN 3 THEN 'objects_inside_polygon' WHEN 4 THEN 'objects_crossing_line' WHEN 5 THEN 'polygon_area'
              WHEN 6 THEN 'line_length' WHEN 7 THEN 'nearby_objects' WHEN 8 THEN 'artifact_modification'
              ELSE 'unsupported_or_ambiguous' END AS task_type,
         'L' || (doc_id % 6) AS difficulty, (doc_id // 10) % 2 = 0 AS sel, doc_id % 11 = 0 AS clarify,
         CASE WHEN family IN (0, 4) AND doc_id % 3 = 0 THEN 'today' END AS c_range,
         CASE WHEN family = 3 AND doc_id % 4 = 3 THEN 'camera' END AS c_type,
         CASE WHEN family = 7 AND doc_id % 4 = 3 THEN 400 END AS c_radius
  FROM docs""",
    "firsts": """
  SELECT scenario_id, type,
         max(CASE WHEN rk = 1 THEN id END) AS id1, max(CASE WHEN rk = 1 THEN name END) AS name1,
         max(CASE WHEN rk = 2 THEN id END) AS id2, max(CASE WHEN rk = 2 THEN name END) AS name2
  FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, type ORDER BY ord) AS rk FROM objects)
  WHERE rk <= 2 GROUP BY scenario_id, type""",
    "negs": """
  SELECT b.doc_id, b.scenario_id, b.kind, b.task_type, b.c_range, b.sel, b.target_id, 1 AS mutation, 'missing_selected' AS negative_type, 'L0' AS difficulty,
         b.target_id AS object_id, CAST(NULL AS VARCHAR) AS shown_type, CAST(NULL AS VARCHAR) AS shown
  FROM bps b WHERE sel
  UNION ALL
  SELECT b.doc_id, b.scenario_id, b.kind, b.task_type, b.c_range, b.sel, b.target_id, 2, 'type_mismatch', 'L5', b.target_id, f.type, f.id1
  FROM bps b JOIN firsts f ON f.scenario_id = b.scenario_id
       AND f.type = CASE b.kind WHEN 'vehicle' THEN 'camera' WHEN 'polygon' THEN 'line' ELSE 'polygon' END
  WHERE sel
  UNION ALL
  SELECT b.doc_id, b.scenario_id, b.kind, b.task_type, b.c_range, b.sel, b.target_id, 3, 'multiple_selected', 'L5', b.target_id, f.type, f.id1 || ',' || f.id2
  FROM bps b JOIN firsts f ON f.scenario_id = b.scenario_id AND f.type = b.kind WHERE f.id2 IS NOT NULL
  UNION ALL
  SELECT b.doc_id, b.scenario_id, b.kind, b.task_type, b.c_range, b.sel, b.target_id, 4, 'nonexistent_id', 'L5', 'vehicle_999_nonexistent',
         NULL, NULL
  FROM bps b WHERE NOT sel""",
    # every sample, with what later steps look at
    "samples": """
  SELECT CAST(substr(scenario_id, 19) AS BIGINT) AS world, 0 AS stage, doc_id, 0 AS mutation, scenario_id, task_type, difficulty, text AS user_request,
         clarify, NOT clarify AND family < 8 AS traced, family, sel, kind, target_id,
         CASE WHEN sel THEN kind END AS shown_type, CASE WHEN sel THEN target_id END AS shown,
         CASE WHEN NOT clarify AND family IN (0, 4) THEN coalesce(c_range, 'last_10_minutes') ELSE '' END AS used_range,
         c_range, CAST(NULL AS VARCHAR) AS negative_type
  FROM bps
  UNION ALL
  SELECT CAST(substr(scenario_id, 19) AS BIGINT), 1, doc_id, mutation, scenario_id, task_type, difficulty, '[auto] ' || task_type || ' task',
         true, false, doc_id % 10, sel, kind, target_id, shown_type, shown, '', c_range, negative_type
  FROM negs""",
}

NEEDS = {
    "firsts": ["objects"],
    "negs": ["bps", "firsts"],
    "samples": ["bps", "negs"],
    "objects": ["vehicles", "cameras", "zones", "roads"],
    "bps": ["docs"],
}


def with_views(names: str, body: str) -> str:
    """`body` behind the WITH clause of the views it needs."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n" + body.strip()


def sample_id(world: str, doc: str, mutation: str) -> str:
    return f"('mapagent_' || substr(sha256({world} || '|' || {doc} || '|' || {mutation} || '|0'), 1, 32))"


SAMPLE_ID = sample_id("scenario_id", "doc_id", "mutation")


def and_views(names: str, ctes: dict[str, str], body: str) -> str:
    """Like `with_views`, with further common table expressions after them."""
    head = with_views(names, "")
    return head.rstrip() + "".join(f",\n{n} AS ({sql})" for n, sql in ctes.items()) + "\n" + body.strip()
