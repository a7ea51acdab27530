"""Cloned plates: one plate at two places sooner than a vehicle could drive.

Only pairs close enough in time can be that fast.  The widest distance between two
sightings bounds the gap, so the pairs are found by an equi-join on plate and time bin
rather than by comparing all sightings of a plate.

Where few sightings are far from all others, as with a wrong position, one width for all would make the bins of every
plate wide.  Then each plate has layers of bins: a sighting's layer is how far it lies from the plate's
usual place, as a power of two, and a pair meets in the layer of its farther sighting only.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from platewatch.functions.clock import epoch_seconds, gap_hours
from platewatch.functions.geo import (
    KM_A_DEGREE,
    RADIANS,
    SPHERE,
    distance_km,
    longest_flagged_gap_s,
    speed_kmh,
    sphere_columns,
    sphere_distance_km,
    widest_distance_km,
)
from platewatch.model import MAX_KMH
from platewatch.operators.membership import frozen, plate_set, watchlist_alerts
from platewatch.operators.scan import sightings_since, stamp_run
from platewatch.operators.sequences import consecutive
from platewatch.operators.skew import split_rows
from platewatch.session import written

# A plate with more sightings than this has its copies set aside before it is paired.
HEAVY_ROWS = 20_000
# Beyond this many such plates all plates are treated that way, so the list stays short.
HEAVY_PLATES = 10_000
EVERY_PLATE = "every plate"
# Layers are worth it where the widest distance is so many times what plates usually cover.
LAYERED_FROM = 2
# Layers are found by cells of this many degrees; no two places of a cell are further apart than the kilometres.
CELL_DEGREES = 0.1
CELL_KM = 17
LAST_LAYER = 15

_SPOT = ["plate", "site_id", "pass_time", *SPHERE]
_SIDE = ["id", "site_id", "pass_time", "sec", *SPHERE]


def clone_plate_pairs(
    sightings: DataFrame,
    since=None,
    max_kmh: float = MAX_KMH,
    clock12: bool = False,
    flag_simultaneous: bool = False,
    max_gap_s: int | None = None,
    heavy: dict | str | None = None,
    layered: bool | None = None,
) -> DataFrame:
    """Every pair of a plate's sightings that is faster than ``max_kmh``, once.

    ``flag_simultaneous`` also takes two places at the same second, whose speed counts as
    0.  ``max_gap_s``, ``heavy`` and ``layered`` save measuring the sightings where they are known.
    """
    rows, max_gap_s, heavy, layered = _measure(sightings_since(sightings, since), max_kmh, max_gap_s, heavy, layered)
    rule = (max_gap_s, max_kmh, flag_simultaneous, layered)
    light, hot = _split(_timed(rows, clock12), heavy)
    pairs = []
    if light is not None:
        pairs.append(_pair_columns(_fast_pairs(light, *rule)))
    if hot is not None:
        pairs.append(_pair_columns(_all_copies(_fast_pairs(_spots(hot), *rule), hot)))
    return reduce(DataFrame.unionByName, pairs)


def clone_watchlist(
    sightings: DataFrame,
    since=None,
    max_kmh: float = MAX_KMH,
    clock12: bool = False,
    flag_simultaneous: bool = False,
    max_gap_s: int | None = None,
    heavy: dict | str | None = None,
    layered: bool | None = None,
) -> DataFrame:
    """The distinct plates of the fast pairs.

    A heavy plate with a fast pair among successive sightings is settled by that; only the
    other heavy plates have their places and moments, without copies, paired.
    """
    rows, max_gap_s, heavy, layered = _measure(sightings_since(sightings, since), max_kmh, max_gap_s, heavy, layered)
    rule = (max_gap_s, max_kmh, flag_simultaneous, layered)
    light, hot = _split(rows, heavy)
    plates = []
    if light is not None:
        plates.append(_fast_plates(_timed(light, clock12), *rule))
    if hot is not None:
        legs = clone_plate_adjacent(hot, None, max_kmh, clock12, flag_simultaneous)
        settled = written(legs.select("plate").distinct())
        others = hot.join(settled, "plate", "left_anti")
        plates += [settled, _fast_plates(_spots(_timed(others, clock12)), *rule)]
    return reduce(DataFrame.unionByName, plates)


def _split(rows, heavy):
    """Rows of ordinary and of heavy plates, None for a part that cannot have any."""
    if not heavy:
        return rows, None
    if heavy == EVERY_PLATE:
        return None, rows
    return split_rows(rows, "plate", heavy)


def _fast_plates(rows, *rule):
    return _fast_pairs(rows, *rule).select("plate").distinct()


def clone_plate_adjacent(
    sightings: DataFrame,
    since=None,
    max_kmh: float = MAX_KMH,
    clock12: bool = False,
    flag_simultaneous: bool = False,
    **skew,
) -> DataFrame:
    """Fast pairs among successive sightings of a plate only."""
    legs = leg_speeds(sightings, since, clock12, **skew)
    return legs.where(_too_fast(max_kmh, flag_simultaneous))


def leg_speeds(sightings: DataFrame, since=None, clock12: bool = False, **skew) -> DataFrame:
    """Distance, time and speed between each sighting of a plate and its next one."""
    rows = _timed(sightings_since(sightings, since), clock12)
    runs = consecutive(rows, 2, _SIDE, **skew)
    legs = runs.select(
        "plate",
        *[F.col("steps")[i][c].alias(f"{c}_{side}") for i, side in enumerate("ab") for c in _SIDE],
    )
    return _pair_columns(_with_speed(legs))


def clone_plate_report(pairs: DataFrame, sightings: DataFrame, run_id: int, run_time) -> DataFrame:
    """Two rows per pair with the details of its sightings, looked up by id.

    Sightings of plates without a pair are left out before they are shuffled, by a set of plates that is
    broadcast if it is measured to be small.
    """
    pairs = written(pairs.select("plate", "id_a", "id_b"))
    sides = pairs.select(
        pair_key("id_a", "id_b").alias("pair_key"), F.explode(F.array("id_a", "id_b")).alias("id")
    )
    details = sightings.select("id", "plate", "brand", "colour", "pass_time", "site_id")
    details = watchlist_alerts(details, frozen(plate_set(pairs)))
    return stamp_run(sides.join(details, "id"), run_id, run_time)


def pair_key(id_a: str, id_b: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_a).cast("string"), F.col(id_b).cast("string")))


def _measure(rows, max_kmh, max_gap_s, heavy, layered):
    """What is not given of the longest gap of a fast pair, the heavy plates and the need of layers, in one job."""
    if max_gap_s is not None and heavy is not None:
        return rows, max_gap_s, heavy, bool(layered)
    plates = rows.groupBy("plate").agg(
        F.count("*").alias("n"),
        F.min("lon").alias("west"),
        F.min("lat").alias("south"),
        F.max("lon").alias("east"),
        F.max("lat").alias("north"),
        F.hypot(F.stddev_pop("lon"), F.stddev_pop("lat")).alias("spread"),
    )
    many = F.col("n") > HEAVY_ROWS
    # What a plate usually covers: its box, or less where few sightings make the box wide.
    usual = F.least(F.hypot(F.col("east") - F.col("west"), F.col("north") - F.col("south")), 4 * F.col("spread"))
    count, usual_degrees, *box = plates.agg(
        F.count_if(many), F.sum(usual * F.col("n")) / F.sum("n"), F.min("west"), F.min("south"), F.max("east"), F.max("north")
    ).first()
    widest = 0 if None in box else widest_distance_km(*box)
    if layered is None:
        layered = widest > LAYERED_FROM * (usual_degrees or 0) * KM_A_DEGREE + CELL_KM
    if max_gap_s is None:
        max_gap_s = longest_flagged_gap_s(widest, max_kmh) if widest else 0
    if heavy is None:
        if count > HEAVY_PLATES:
            heavy = EVERY_PLATE
        else:
            heavy = dict(plates.where(many).select("plate", "n").collect()) if count else {}
    return rows, max_gap_s, heavy, layered


def _timed(rows, clock12):
    """What speeds are made of; a sighting without time or position has none."""
    return rows.dropna(subset=["pass_time", "lon", "lat"]).select(
        "plate",
        "id",
        "site_id",
        "pass_time",
        epoch_seconds(F.col("pass_time"), clock12).alias("sec"),
        *sphere_columns(F.col("lon"), F.col("lat")),
    )


def _spots(rows):
    """One row per plate, place and moment, under the smallest id seen there."""
    return rows.groupBy(*_SPOT, "sec").agg(F.min("id").alias("id"))


def _on(side, names):
    return [F.col(f"{name}_{side}") for name in names]


def _meetings(rows, max_gap_s, max_kmh, layered):
    """Candidates: sightings (a, b) of a plate in the same time bin, b also in the bin after a's, with the bins' width."""
    width = F.lit(max(1, max_gap_s))
    keys, firsts, seconds = ["bin", "plate"], [], []
    if layered:
        rows, keys = _with_layers(rows), [*keys, "layer", "turn"]
        widths = [min(max_gap_s, longest_flagged_gap_s(2.0 * 2**layer, max_kmh)) for layer in range(LAST_LAYER + 1)]
        width = F.element_at(F.array(*[F.lit(max(1, w)) for w in widths]), F.col("layer") + 1)
        # A sighting takes part in its own layer and those of the plate's farther sightings; of two nearer ones
        # neither looks for the other there: turn 0 is a farther one first, turn 1 a farther one second.
        layers = F.filter(F.sequence("own", F.lit(LAST_LAYER)), lambda at: F.getbit("layers", at) == 1)
        rows = rows.withColumn("layer", F.explode(layers))
        farther = F.col("layer") == F.col("own")
        nearer_too = F.col("layers").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("own")) - 1) != 0
        firsts = ["layer", F.when(farther, 0).otherwise(1).alias("turn")]
        seconds = ["layer", F.explode(F.when(farther & nearer_too, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("turn")]
    cell = F.floor(F.col("sec") / width)
    # A later partner within one bin width is in the same bin or the next.
    earlier = rows.select(
        "plate",
        *firsts,
        F.explode(F.array(cell, cell + 1)).alias("bin"),
        *[F.col(c).alias(f"{c}_a") for c in _SIDE],
    )
    later = rows.select("plate", *seconds, cell.alias("bin"), *[F.col(c).alias(f"{c}_b") for c in _SIDE])
    return earlier.hint("merge").join(later, keys).withColumn("width", width)


def _with_layers(rows):
    """``own``, the layer of each sighting, and ``layers``, those of all sightings of its plate as bits.

    The usual place of a plate is where it was seen most.  Two sightings of layers a <= b are at most
    twice 2 ** b kilometres apart.  Only cells are counted and compared, not sightings.
    """
    lon, lat = F.col("east") / RADIANS, F.asin("sin_north") / RADIANS
    cell = {"cell_x": F.floor(lon / CELL_DEGREES), "cell_y": F.floor(lat / CELL_DEGREES)}
    rows = rows.withColumns(cell)
    cells = rows.groupBy("plate", *cell).agg(F.count("*").alias("n"), F.avg(lon).alias("lon"), F.avg(lat).alias("lat"))
    plate = Window.partitionBy("plate")
    usual = cells.withColumn("usual", F.max_by(F.struct("lon", "lat"), "n").over(plate))
    reach = distance_km(F.col("lon"), F.col("lat"), F.col("usual.lon"), F.col("usual.lat")) + CELL_KM
    layer = F.least(F.ceil(F.log2(reach)), F.lit(LAST_LAYER)).cast("int")
    layers = usual.withColumn("own", layer).withColumn("layers", F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("own"))).over(plate))
    return rows.join(layers.select("plate", *cell, "own", "layers"), ["plate", *cell])


def _fast_pairs(rows, max_gap_s, max_kmh, flag_simultaneous, layered):
    gap = F.col("sec_b") - F.col("sec_a")
    ordered = gap > 0
    if flag_simultaneous:
        ordered = ordered | ((gap == 0) & (F.col("id_a") < F.col("id_b")))
    elsewhere = F.lit(False)
    for one, other in zip(_on("a", SPHERE), _on("b", SPHERE)):
        elsewhere = elsewhere | (one != other)
    near = _meetings(rows, max_gap_s, max_kmh, layered).where(ordered & (gap <= F.col("width")) & elsewhere)
    return _with_speed(near).where(_too_fast(max_kmh, flag_simultaneous))


def _with_speed(pairs):
    km = sphere_distance_km(_on("a", SPHERE), _on("b", SPHERE))
    hours = gap_hours(F.col("sec_b") - F.col("sec_a"))
    return pairs.withColumns({"distance_km": km, "hours": hours}).withColumn(
        "speed_kmh", speed_kmh(F.col("distance_km"), F.col("hours"))
    )


def _too_fast(max_kmh, flag_simultaneous):
    fast = F.col("speed_kmh") > max_kmh
    if flag_simultaneous:
        fast = fast | ((F.col("hours") == 0) & (F.col("distance_km") > 0))
    return fast


def _all_copies(spot_pairs, rows):
    """Put every sighting of the two spots back in place of the spot."""
    for side in "ab":
        copies = rows.select(*[F.col(c).alias(f"copy_{c}") for c in _SPOT], F.col("id").alias("copy_id"))
        same = F.col("plate") == F.col("copy_plate")
        for c in _SPOT:
            if c != "plate":
                # A missing site is a place like any other: its copies are found as well.
                same = same & F.col(f"{c}_{side}").eqNullSafe(F.col(f"copy_{c}"))
        spot_pairs = (
            spot_pairs.drop(f"id_{side}")
            .join(copies, same)
            .drop(*[f"copy_{c}" for c in _SPOT])
            .withColumnRenamed("copy_id", f"id_{side}")
        )
    # The same second has no earlier side: keep the smaller id first, as elsewhere.
    turn = (F.col("sec_a") == F.col("sec_b")) & (F.col("id_a") > F.col("id_b"))
    turned = {}
    for c in _SIDE:
        a, b = F.col(f"{c}_a"), F.col(f"{c}_b")
        turned[f"{c}_a"] = F.when(turn, b).otherwise(a)
        turned[f"{c}_b"] = F.when(turn, a).otherwise(b)
    return spot_pairs.withColumns(turned)


def _pair_columns(pairs):
    fields = ["id", "site_id", "pass_time"]
    return pairs.select("plate", *_on("a", fields), *_on("b", fields), "distance_km", "hours", "speed_kmh")
