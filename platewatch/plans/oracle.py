"""The registered queries as plain SQL over the same tables, for checking."""

from platewatch.plans.queries import (
    CUTOFF,
    FAST_KMH,
    GROUP_PLATES,
    KNOWN_UNTIL,
    RUN_ID,
    RUN_TIME,
    SOUGHT,
    TRAIL_ROWS,
    WIDER_S,
    WIDE_S,
)
from platewatch.sources.events import SITES

_SITES = ", ".join(
    f"('{name}', CAST({lon} AS DOUBLE), CAST({lat} AS DOUBLE))" for name, (lon, lat) in SITES.items()
)

_SIGHTINGS = f"""
WITH sites (site, lon, lat) AS (VALUES {_SITES}),
s AS (
    SELECT event_id AS id,
           CAST(user_id AS VARCHAR) AS plate,
           'b' || json_extract_string(props, '$.k') AS brand,
           substr(event_type, 1, 1) AS colour,
           date_trunc('second', ts) AS pass_time,
           event_type AS site_id,
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS sec,
           lon, lat
    FROM events LEFT JOIN sites ON event_type = site
)
"""

_TIME = "strftime(pass_time, '%Y-%m-%d %H:%M:%S')"

_KM = """CAST(round(CAST(6370693.5 AS DOUBLE) * acos(greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE),
    sin(a.lat * CAST(0.01745329252 AS DOUBLE)) * sin(b.lat * CAST(0.01745329252 AS DOUBLE))
    + cos(a.lat * CAST(0.01745329252 AS DOUBLE)) * cos(b.lat * CAST(0.01745329252 AS DOUBLE))
      * cos(a.lon * CAST(0.01745329252 AS DOUBLE) - b.lon * CAST(0.01745329252 AS DOUBLE))))) / 1000) AS BIGINT)"""


def _measured(source):
    """Pairs (a, b) with distance, hours and speed, from a FROM clause that names both."""
    return f"""
    SELECT *, CASE WHEN hours = 0 THEN 0 ELSE CAST(floor(distance_km / hours) AS BIGINT) END AS speed_kmh
    FROM (
        SELECT a.plate,
               a.id AS id_a, a.site_id AS site_id_a, a.pass_time AS pass_time_a,
               b.id AS id_b, b.site_id AS site_id_b, b.pass_time AS pass_time_b,
               {_KM} AS distance_km,
               round(abs(b.sec - a.sec) / CAST(3600 AS DOUBLE), 4) AS hours
        FROM {source}
    )"""


_CLOCK12 = """SELECT * REPLACE (CASE WHEN hour(pass_time) = 12 THEN sec - 43200 ELSE sec END AS sec) FROM s"""
_SAME_HOUR = "SELECT * REPLACE (date_trunc('hour', pass_time) AS pass_time, sec - sec % 3600 AS sec) FROM s"

_OUTLIER = """SELECT * REPLACE (CASE WHEN id % 500 = 0 THEN 0 ELSE lon END AS lon, CASE WHEN id % 500 = 0 THEN 0 ELSE lat END AS lat)
    FROM s"""

_ALL_PAIRS = """t a JOIN t b
    ON a.plate = b.plate AND (a.sec < b.sec OR (a.sec = b.sec AND a.id < b.id))"""


def _pairs(rows="SELECT * FROM s", where="speed_kmh > 180"):
    return f"{_SIGHTINGS}, t AS ({rows}), p AS (SELECT * FROM ({_measured(_ALL_PAIRS)}) WHERE {where})"


_NEXT = """(
    SELECT *, lead(id) OVER w AS next_id FROM s
    WINDOW w AS (PARTITION BY plate ORDER BY pass_time, id)
) a JOIN s b ON a.next_id = b.id"""
_LEGS = f"{_SIGHTINGS}, p AS ({_measured(_NEXT)})"

_LEGS12 = f"{_SIGHTINGS}, t AS ({_CLOCK12}), p AS ({_measured(_NEXT.replace('FROM s', 'FROM t').replace('JOIN s b', 'JOIN t b'))})"


def _report(pairs):
    return f"""{pairs},
    d AS (
        SELECT md5(CAST(id_a AS VARCHAR) || '|' || CAST(id_b AS VARCHAR)) AS pair_key, id_a AS id FROM p
        UNION ALL
        SELECT md5(CAST(id_a AS VARCHAR) || '|' || CAST(id_b AS VARCHAR)), id_b FROM p
    )"""


def _sequences(n):
    leads = ", ".join(
        f"lead(site_id, {k}) OVER w AS k{k}, lead(sec, {k}) OVER w AS s{k}" for k in range(n)
    )
    return f"""{_SIGHTINGS},
    g AS (
        SELECT * FROM (SELECT plate, id AS first_id, {leads} FROM s
                       WINDOW w AS (PARTITION BY plate ORDER BY pass_time, id))
        WHERE k{n - 1} IS NOT NULL
    )"""


def _sequence_text(n):
    gram = " || ',' || ".join(f"k{k}" for k in range(n))
    seconds = " || ',' || ".join(f"CAST(s{k} AS VARCHAR)" for k in range(n))
    return f"{_sequences(n)} SELECT plate, first_id, {gram} AS gram, {seconds} AS seconds FROM g"


def _met(tolerance, match="any", allow_self=False, n=3):
    """Pairs of runs on the same sequence that were close enough in time."""
    near = [f"abs(a.s{k} - b.s{k}) <= {tolerance}" for k in range(n)]
    near = (" OR " if match == "any" else " AND ").join(near)
    other = "a.first_id <> b.first_id" if allow_self else "a.plate <> b.plate"
    gram = " || ',' || ".join(f"a.k{k}" for k in range(n))
    same = " AND ".join(f"a.k{k} = b.k{k}" for k in range(n))
    return f"""{_sequences(n)},
    met AS (
        SELECT {gram} AS gram, a.plate AS plate_a, b.plate AS plate_b
        FROM g a JOIN g b ON {same} AND {other}
        WHERE {near}
    ),
    m AS (SELECT DISTINCT gram, plate_a AS plate FROM met)"""


def _groups(size=10_000):
    return f"""SELECT gram, part, string_agg(plate, ',' ORDER BY plate) AS plates
    FROM (SELECT gram, plate,
                 CAST((row_number() OVER (PARTITION BY gram ORDER BY plate) - 1) // {size} AS INTEGER) AS part
          FROM m)
    GROUP BY gram, part"""


def _trail(size):
    return f"""{_SIGHTINGS}
        SELECT plate, part, count(*) AS n,
               string_agg(site_id || '@' || {_TIME}, ';' ORDER BY pass_time, id) AS trail
        FROM (SELECT *, CAST((row_number() OVER (PARTITION BY plate ORDER BY pass_time, id) - 1) // {size} AS BIGINT) AS part
              FROM s)
        GROUP BY plate, part"""


def _texted(sql):
    """The same where ids are text."""
    return sql.replace("SELECT event_id AS id", "SELECT CAST(event_id AS VARCHAR) AS id")


def _spoilt(sql):
    """The same over CSV in which the times of one site cannot be read; ids are text there."""
    readable = "FROM events LEFT JOIN sites ON event_type = site WHERE event_type <> 'signup'"
    sql = sql.replace("FROM events LEFT JOIN sites ON event_type = site", readable)
    return _texted(sql)


_CLONE_TABLE = f"""SELECT CAST(d.id AS VARCHAR) AS id, plate AS hphm, brand AS clpp, colour AS clys, {_TIME} AS tgsj,
               site_id AS kkbh, CAST({RUN_ID} AS BIGINT) AS jsbh
        FROM d JOIN s ON d.id = s.id"""
_FIELDS = "id, plate, brand, colour, pass_time, site_id"
_KNOWN = f"SELECT plate FROM s WHERE pass_time < TIMESTAMP '{KNOWN_UNTIL}'"
_FAST = _pairs(where=f"speed_kmh > {FAST_KMH}")
_COUNTS = f"SELECT plate, count(*) AS times_seen FROM ({_KNOWN}) GROUP BY plate"

_FIRST_ENTRY = f"{_SIGHTINGS} SELECT {_FIELDS} FROM s WHERE plate NOT IN ({_KNOWN})"
_SEEN = f"{_SIGHTINGS} SELECT {_FIELDS} FROM s WHERE plate IN ({_KNOWN})"
_REPEATED = f"""{_SIGHTINGS}
    SELECT s.id, s.plate, s.brand, s.colour, s.pass_time, s.site_id,
           row_number() OVER (PARTITION BY s.id ORDER BY h.id) AS copy
    FROM s JOIN s h ON s.plate = h.plate AND h.pass_time < TIMESTAMP '{KNOWN_UNTIL}'"""
_ALERTS = f"{_FAST} SELECT {_FIELDS} FROM s WHERE plate IN (SELECT plate FROM p)"
_POSITION = "CAST(lon AS VARCHAR) || '_' || CAST(lat AS VARCHAR)"

_SINCE = f"{_SIGHTINGS} SELECT {_FIELDS} FROM s WHERE pass_time > TIMESTAMP '{CUTOFF}'"

_CSV = f"""{_SIGHTINGS}
    SELECT CAST(id AS VARCHAR) AS id, plate, brand, colour, pass_time, site_id, lon, lat FROM s"""

ORACLE = {
    "sightings_since": _SINCE,
    "sightings_since_sql": _SINCE,
    "plate_trail": _trail(10_000),
    "plate_trail_parts": _trail(TRAIL_ROWS),
    "plate_trail_daily": _trail(TRAIL_ROWS),
    "plate_trail_parts_heavy": _trail(TRAIL_ROWS),
    "site_sequences_heavy": _sequence_text(3),
    "clone_plate_pairs_heavy": f"{_pairs()} SELECT * FROM p",
    "clone_watchlist_heavy": f"{_FAST} SELECT DISTINCT plate FROM p",
    "cotravel_members_heavy": f"{_met(180)} SELECT gram, plate FROM m",
    "cotravel_groups_parts": f"{_met(180)} {_groups(GROUP_PLATES)}",
    "cotravel_all_of_five": f"{_met(WIDER_S, 'all', n=5)} {_groups()}",
    "first_entry_without_positions": _spoilt(_FIRST_ENTRY),
    "cotravel_without_positions": _spoilt(f"{_met(180)} SELECT gram, plate FROM m"),
    "stored_sightings_since": _texted(_SINCE),
    "first_entry_stored": _texted(_FIRST_ENTRY),
    "clone_plate_pairs_same_hour": f"""{_pairs(_SAME_HOUR, "speed_kmh > 180 OR (hours = 0 AND distance_km > 0)")}
        SELECT * FROM p""",
    "clone_plate_pairs_outlier": f"{_pairs(_OUTLIER)} SELECT * FROM p",
    "clone_plate_pairs_daily": f"""{_pairs()}
        SELECT * REPLACE (CAST(id_a AS VARCHAR) AS id_a, CAST(id_b AS VARCHAR) AS id_b) FROM p""",
    "watchlist_alerts_as_of": f"""{_FAST}
        SELECT {_FIELDS} FROM s
        WHERE CASE WHEN pass_time < TIMESTAMP '{CUTOFF}' THEN plate IN (SELECT plate FROM p)
                   ELSE plate IN (SELECT plate FROM p WHERE least(pass_time_a, pass_time_b) > TIMESTAMP '{CUTOFF}') END""",
    "stored_lookup": _texted(f"{_SIGHTINGS} SELECT {_FIELDS} FROM s WHERE plate IN {SOUGHT}"),
    "seen_before_bucketed": _REPEATED,
    "first_entry_stream_once": f"""{_SIGHTINGS}
        SELECT {_FIELDS} FROM s WHERE plate NOT IN ({_KNOWN})
        QUALIFY row_number() OVER (PARTITION BY plate ORDER BY pass_time, id) = 1""",
    "leg_speeds_clock12": f"{_LEGS12} SELECT * FROM p",
    "clone_report_all_pairs": f"{_report(_pairs())} {_CLONE_TABLE}",
    "clone_watchlist_at_limit": f"{_pairs()} SELECT DISTINCT plate FROM p",
    "cotravel_groups_self_wide": f"{_met(WIDE_S, allow_self=True)} {_groups()}",
    "watchlist_alerts_refreshed": _ALERTS,
    "watchlist_alerts_two_streams": _ALERTS,
    "watchlist_alerts_restarted": _ALERTS,
    "message_alerts_bad_time": _ALERTS.replace(f"SELECT {_FIELDS} FROM", f"SELECT {_FIELDS[4:]} FROM") + " AND site_id <> 'signup'",
    "last_offset": """SELECT max(event_id) AS "offset" FROM events""",
    "dead_entries": f"""{_SIGHTINGS}
        SELECT CASE WHEN site_id <> 'error' THEN plate END AS plate,
               CASE WHEN site_id = 'signup' THEN 'bad' ELSE {_TIME} END AS time_text,
               CASE WHEN site_id = 'error' THEN 'plate' ELSE 'time' END AS reason
        FROM s WHERE site_id IN ('signup', 'error')""",
    "site_sequences": _sequence_text(3),
    "site_sequences_of_five": _sequence_text(5),
    "clone_plate_pairs": f"{_pairs()} SELECT * FROM p",
    "clone_plate_pairs_since": f"""{_pairs(f"SELECT * FROM s WHERE pass_time > TIMESTAMP '{CUTOFF}'")}
        SELECT * FROM p""",
    "clone_plate_pairs_clock12": f"{_pairs(_CLOCK12)} SELECT * FROM p",
    "clone_plate_pairs_simultaneous": f"""{_pairs(where="speed_kmh > 180 OR (hours = 0 AND distance_km > 0)")}
        SELECT * FROM p""",
    "clone_plate_adjacent": f"{_LEGS} SELECT * FROM p WHERE speed_kmh > 180",
    "leg_speeds": f"{_LEGS} SELECT * FROM p",
    "clone_plate_report": f"""{_report(_pairs())}
        SELECT d.id, pair_key, plate, brand, colour, pass_time, site_id,
               CAST({RUN_ID} AS BIGINT) AS run_id, TIMESTAMP '{RUN_TIME}' AS created_at
        FROM d JOIN s ON d.id = s.id""",
    "clone_report_adjacent": f"""{_report(_LEGS.replace("p AS (", "q AS (") + ", p AS (SELECT * FROM q WHERE speed_kmh > 180)")}
        {_CLONE_TABLE}""",
    "clone_watchlist": f"{_FAST} SELECT DISTINCT plate FROM p",
    "cotravel_members": f"{_met(180)} SELECT gram, plate FROM m",
    "cotravel_groups": f"{_met(180)} {_groups()}",
    "cotravel_groups_daily": f"{_met(180)} {_groups()}",
    "cotravel_groups_self": f"{_met(180, allow_self=True)} {_groups()}",
    "cotravel_all": f"{_met(WIDE_S, 'all')} {_groups()}",
    "cotravel_pairs": f"{_met(180)} SELECT DISTINCT gram, plate_a, plate_b FROM met WHERE plate_a < plate_b",
    "cotravel_result": f"""{_met(180)}
        SELECT md5('{RUN_ID}|["' || replace(gram, ',', '","') || '"]|0') AS "ID", '{RUN_ID}' AS "JSBH",
               string_agg(plate, ',' ORDER BY plate) AS "HPHM", gram AS "KKBH", '{RUN_TIME}' AS "CREATE_TIME"
        FROM m GROUP BY gram""",
    "first_entry": _FIRST_ENTRY,
    "seen_before": f"{_SEEN} AND pass_time > TIMESTAMP '{KNOWN_UNTIL}'",
    "seen_before_counted": f"""{_SIGHTINGS}
        SELECT {_FIELDS}, times_seen FROM s JOIN ({_COUNTS}) USING (plate)""",
    "seen_before_repeated": _REPEATED,
    "watchlist_alerts": _ALERTS,
    "watchlist_alerts_stream": _ALERTS,
    "first_entry_stream": _FIRST_ENTRY,
    "seen_before_stream": _SEEN,
    "seen_before_repeated_stream": _REPEATED,
    "message_alerts_stream": _ALERTS.replace(f"SELECT {_FIELDS} FROM", f"SELECT {_FIELDS[4:]} FROM"),
    "decode_messages": f"{_SIGHTINGS} SELECT {_FIELDS[4:]} FROM s",
    "publish_sightings": """SELECT CAST(count(*) AS BIGINT) AS sightings, true AS within_limit FROM events""",
    "dead_letters": """SELECT event_id, '{[{"KKBH":"error"}]' AS value FROM events WHERE event_type = 'error'""",
    "csv_sightings": _CSV,
    "csv_mixed_headers": _CSV,
    "table_sightings": _CSV,
    "csv_rejected": f"""{_SIGHTINGS}
        SELECT CAST(id AS VARCHAR) AS id, plate, brand, colour,
               CASE WHEN site_id = 'signup' THEN 'bad' ELSE {_TIME} END AS time_text, site_id,
               CASE WHEN site_id = 'error' THEN 'x_y' ELSE {_POSITION} END AS position_text,
               CASE WHEN site_id = 'signup' THEN 'time' ELSE 'position' END AS reason
        FROM s WHERE site_id IN ('signup', 'error')""",
}
