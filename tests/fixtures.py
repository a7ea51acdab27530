"""Small hand-made sightings and brute-force answers."""

import math
from datetime import datetime, timedelta
from itertools import combinations

DAY = datetime(2024, 1, 1)

SCHEMA = (
    "id long, plate string, brand string, colour string, pass_time timestamp_ntz, "
    "site_id string, lon double, lat double"
)


def at(clock, day=DAY):
    """A moment of the day from ``H:M:S`` text."""
    h, m, s = (int(x) for x in clock.split(":"))
    return day + timedelta(hours=h, minutes=m, seconds=s)


def sightings(spark, rows):
    """Rows of (plate, moment, site, lon, lat), numbered in the order given."""
    full = [
        (i, plate, "b", "c", moment if isinstance(moment, datetime) else at(moment), site, lon, lat)
        for i, (plate, moment, site, lon, lat) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, SCHEMA)


def plain(frame):
    """The rows as a sorted list of tuples."""
    return sorted(tuple(r) for r in frame.collect())


def distance(lon_a, lat_a, lon_b, lat_b):
    k = 0.01745329252
    cosine = math.sin(lat_a * k) * math.sin(lat_b * k) + math.cos(lat_a * k) * math.cos(
        lat_b * k
    ) * math.cos((lon_a - lon_b) * k)
    return math.floor(6370693.5 * math.acos(max(-1.0, min(1.0, cosine))) / 1000 + 0.5)


def speed(km, gap):
    hours = round(abs(gap) / 3600, 4)
    return int(km / hours) if hours else 0


def fast_pairs(rows, max_kmh=180):
    """Ids of every fast pair, found by looking at all pairs of a plate."""
    found = set()
    for (i, a), (j, b) in combinations(enumerate(rows, 1), 2):
        if a[0] == b[0] and speed(distance(*a[3:], *b[3:]), (b[1] - a[1]).total_seconds()) > max_kmh:
            found.add((min(i, j), max(i, j)))
    return found


def runs(rows, n=3):
    """(plate, first id, sites, seconds) of every run of n successive sightings."""
    plates = {}
    for i, row in enumerate(rows, 1):
        plates.setdefault(row[0], []).append((row[1], i, row[2]))
    for plate, trail in plates.items():
        trail.sort()
        for k in range(len(trail) - n + 1):
            part = trail[k : k + n]
            yield (
                plate,
                part[0][1],
                tuple(site for _, _, site in part),
                tuple(int((moment - datetime(1970, 1, 1)).total_seconds()) for moment, _, _ in part),
            )


def companions(rows, tolerance=180, match="any", allow_self=False):
    """(sites, plate, other plate) of every pair of runs close enough in time."""
    near = {"any": any, "all": all}[match]
    found = set()
    for a, b in combinations(list(runs(rows)), 2):
        if a[2] == b[2] and (allow_self or a[0] != b[0]):
            if near(abs(s - t) <= tolerance for s, t in zip(a[3], b[3])):
                found |= {(a[2], a[0], b[0]), (a[2], b[0], a[0])}
    return found


def members(rows, **rule):
    return {(sites, plate) for sites, plate, _ in companions(rows, **rule)}


def random_rows(random, count, plates=6, sites=4, span=6000, hot=None):
    """Random sightings; a third of them of one plate where ``hot`` names it."""
    places = {f"k{i}": (113 + 0.3 * i, 22 + 0.2 * i) for i in range(sites)}
    rows = []
    for _ in range(count):
        plate = hot if hot and random.random() < 0.4 else f"p{random.randrange(plates)}"
        site = random.choice(list(places))
        rows.append((plate, DAY + timedelta(seconds=random.randrange(span)), site, *places[site]))
    return rows


def hot_copies(random, count, span=6000):
    """Random sightings of which a third are copies of a single one."""
    rows = random_rows(random, count - count // 3, hot="p0", span=span)
    rows += [("p0", DAY + timedelta(seconds=span // 2), "k0", 113.0, 22.0)] * (count // 3)
    random.shuffle(rows)
    return rows


def plan_of(frame):
    return frame._jdf.queryExecution().toString()

