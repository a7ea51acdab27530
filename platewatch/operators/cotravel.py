"""Vehicles that travel together: the same sequence of sites, close in time.

Runs of sites are sorted by time within each sequence, position and stretch of time;
stretches overlap by the tolerance.  Company is then a matter of neighbours in that order,
so the plates are found in one pass, without listing pairs.

Rows of plates or sites too common for one task are first reduced to cells: one per
sequence, position and second, with the smallest and largest plate.  A stretch holds no
more cells than seconds, and the reduction combines before it shuffles.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewatch.functions.clock import epoch_seconds
from platewatch.model import SEQUENCE_LENGTH, TOLERANCE_S
from platewatch.operators.scan import sightings_since
from platewatch.operators.sequences import site_sequences
from platewatch.operators.skew import PIECE_ROWS, heavy_keys, is_heavy, ranked
from platewatch.session import new_folder, written

GROUP_PLATES = 10_000
LOOKUP_POSITIONS = 3
# As many members without company at the first position are looked up one by one.
MOST_OPEN = 50_000
# Numbers first: sorting settles most comparisons on them.
_CELL = ["sec", "pos", "gram"]
_GROUP = ["stretch", "pos", "gram"]


def cotravel_members(
    sightings: DataFrame,
    since=None,
    n: int = SEQUENCE_LENGTH,
    tolerance_s: int = TOLERANCE_S,
    match: str = "any",
    allow_self: bool = False,
    clock12: bool = False,
    **skew,
) -> DataFrame:
    """Distinct ``gram``, ``plate`` of plates that had company on a sequence of sites.

    Company is another plate on the same sequence, within the tolerance at any one
    position or at all of them (``match``).  With ``allow_self`` a second run of the same
    plate counts too.
    """
    if match not in ("any", "all"):
        raise ValueError(f"match is 'any' or 'all', not {match!r}")
    runs, crowded = _runs(sightings, since, n, tolerance_s, clock12, **skew)
    if match == "any":
        members = _neighbours(_positions(runs), crowded, tolerance_s, allow_self)
    else:
        members = _accompanied_throughout(runs, crowded, n, tolerance_s, allow_self)
    return _sites(members.select("gram", "plate").distinct())


def sequence_runs(
    sightings: DataFrame, n: int = SEQUENCE_LENGTH, tolerance_s: int = TOLERANCE_S, clock12: bool = False, **skew
) -> tuple[DataFrame, Column | None]:
    """``gram``, ``plate``, ``seconds`` of every run, and the test that tells its crowded places.

    ``gram`` is the sequence as one text, as ``run_positions`` and ``members_among`` take it.
    """
    runs, crowded = _runs(sightings, None, n, tolerance_s, clock12, **skew)
    return runs.select("gram", "plate", "seconds"), crowded


def run_positions(runs: DataFrame) -> DataFrame:
    """``gram``, ``plate``, ``pos``, ``sec`` of every place of these runs."""
    return _positions(runs)


def members_among(
    positions: DataFrame,
    crowded: Column | None,
    tolerance_s: int = TOLERANCE_S,
    allow_self: bool = False,
    others: DataFrame | None = None,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """``gram``, ``plate`` with company at any of these positions, in the columns of ``cotravel_members``.

    ``positions`` are all places of some runs, ``others`` places of further runs, whose members may be given
    twice; without them members are distinct.  One position is enough, so the first one is looked at alone: where
    it settles all but ``most_open`` members, only stretches that those are in are looked at for the
    other positions.  ``positions`` are read several times.
    """
    every = positions if others is None else positions.unionByName(others)
    if crowded is not None:
        return _sites(_neighbours(every, crowded, tolerance_s, allow_self).distinct())
    asked, company = _beside(every.where("pos = 0").select(*_CELL, "plate"), ["plate"], tolerance_s, allow_self)
    found = _kept(asked.groupBy("gram", "plate").agg(F.max(company).alias("met")), "first-positions")
    met, rest = found.where("met").select("gram", "plate"), every.where("pos > 0")
    left = found.where("not met").select("gram", "plate")
    if others is not None:
        left = left.unionByName(others.select("gram", "plate"))  # their first place may not be among these
    left = _kept(left.distinct(), "open-members")
    if left.count() > most_open:
        return _sites(met.unionByName(_neighbours(rest, None, tolerance_s, allow_self)).distinct())
    # What is kept has a known size, so a short list goes to all tasks and the places are not shuffled for it.
    groups = _overlapping(rest.join(left, ["gram", "plate"], "left_semi"), tolerance_s, both_sides=False)
    groups = _kept(groups.select(*_GROUP).distinct(), "open-groups")
    asked, company = _beside(rest.select(*_CELL, "plate"), ["plate"], tolerance_s, allow_self, groups)
    late = asked.where(company).select("gram", "plate").join(left, ["gram", "plate"], "left_semi").distinct()
    return _sites(met.unionByName(late))


def _kept(rows, name):
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def cotravel_groups(
    members: DataFrame, group_plates: int = GROUP_PLATES, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """The plates of each sequence as sorted arrays: ``gram``, ``part``, ``plates``.

    A sequence with more than ``group_plates`` plates goes on in further rows: ``part`` counts
    them from 0 in the order of the plates, and all but the last are full.
    """
    members = written(members.select("gram", "plate"))
    sizes = members.groupBy("gram").agg(F.count("*").alias("n"))
    # Large sequences go by a number while their plates are ranked.
    large = sizes.where(F.col("n") > group_plates).select("gram", "n").withColumn("_number", F.monotonically_increasing_id())
    large = _kept(large, "large-sequences")
    total = large.agg(F.sum("n")).first()[0]
    if not total:
        return _grouped(members.withColumn("part", F.lit(0)))
    small = members.join(large, "gram", "left_anti").withColumn("part", F.lit(0))
    numbered = ranked(members.join(large, "gram").select("_number", "plate"), ["_number"], ["plate"], total, piece_rows)
    part = F.floor(F.col("_rank") / group_plates).cast("int")
    parts = _grouped(numbered.withColumn("part", part), "_number").join(large.select("_number", "gram"), "_number")
    return _grouped(small).unionByName(parts.select("gram", "part", "plates"))


def _grouped(members, key="gram"):
    return members.groupBy(key, "part").agg(F.array_sort(F.collect_list("plate")).alias("plates"))


def cotravel_pairs(
    sightings: DataFrame,
    since=None,
    n: int = SEQUENCE_LENGTH,
    tolerance_s: int = TOLERANCE_S,
    clock12: bool = False,
    **skew,
) -> DataFrame:
    """Distinct ``gram``, ``plate_a`` < ``plate_b`` that met at a position of a sequence.

    Only runs already known to have company are paired, within bins of the tolerance.
    """
    runs, crowded = _runs(sightings, since, n, tolerance_s, clock12, **skew)
    rows = _accompanied(_positions(runs), crowded, tolerance_s, False)
    rows = rows.select(*_CELL, "plate")
    rows = written(rows if crowded is None else rows.distinct())
    width = tolerance_s + 1
    cell = F.floor(F.col("sec") / width)
    one = rows.select(
        "gram",
        "pos",
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("bin"),
        F.col("sec").alias("sec_a"),
        F.col("plate").alias("plate_a"),
    )
    other = rows.select(
        "gram", "pos", cell.alias("bin"), F.col("sec").alias("sec_b"), F.col("plate").alias("plate_b")
    )
    met = (F.col("plate_a") < F.col("plate_b")) & (
        F.abs(F.col("sec_a") - F.col("sec_b")) <= tolerance_s
    )
    pairs = one.hint("merge").join(other, ["bin", "pos", "gram"]).where(met)
    return _sites(pairs.select("gram", "plate_a", "plate_b").distinct())


def cotravel_result(groups: DataFrame, run_id: int, run_time) -> DataFrame:
    """The groups as rows of the co-travel table: all text, lists joined by commas."""
    key = F.md5(F.concat_ws("|", F.lit(str(run_id)), F.to_json("gram"), F.col("part").cast("string")))
    return groups.select(
        key.alias("ID"),
        F.lit(str(run_id)).alias("JSBH"),
        F.array_join("plates", ",").alias("HPHM"),
        F.array_join("gram", ",").alias("KKBH"),
        F.lit(str(run_time)).alias("CREATE_TIME"),
    )


def _stretch(tolerance_s):
    """Length of the stretches of time that are looked at one by one."""
    return max(900, 4 * tolerance_s)


def _runs(sightings, since, n, tolerance_s, clock12, heavy=None, heavy_places=None, piece_rows=PIECE_ROWS):
    """Runs of sites, and the test that tells their crowded positions.

    Crowded is a position of a heavy plate, or at a site and in a stretch of time that
    together hold too many sightings.
    """
    rows = sightings_since(sightings, since).dropna(subset=["plate", "site_id", "pass_time"])
    rows = rows.withColumn("site_id", _escaped(F.col("site_id")))
    second = epoch_seconds(F.col("pass_time"), clock12)
    if heavy is None or heavy_places is None:
        total = rows.count()
        if heavy is None:
            heavy = heavy_keys(rows, "plate", total=total)
        if heavy_places is None:
            places = rows.select(_place(F.col("site_id"), second, tolerance_s).alias("place"))
            heavy_places = heavy_keys(places, "place", total=total)
    crowded = None
    if heavy or heavy_places:
        site = F.get(F.split("gram", ","), F.col("pos"))
        place = _place(site, F.col("sec"), tolerance_s)
        crowded = is_heavy(F.col("plate"), heavy) | is_heavy(place, heavy_places)
    runs = site_sequences(rows, n, None, clock12, heavy=heavy, piece_rows=piece_rows)
    return runs.withColumn("gram", F.array_join("gram", ",")), crowded


def _escaped(site):
    """A site without commas, so that a sequence can be one text while it is shuffled."""
    return F.replace(F.replace(site, F.lit("~"), F.lit("~0")), F.lit(","), F.lit("~1"))


def _sites(rows):
    """The sequence of sites as an array again."""

    def plain(site):
        return F.replace(F.replace(site, F.lit("~1"), F.lit(",")), F.lit("~0"), F.lit("~"))

    return rows.withColumn("gram", F.transform(F.split("gram", ","), plain))


def _place(site, second, tolerance_s):
    return F.concat_ws("@", site, F.floor(second / _stretch(tolerance_s)).cast("string"))


def _positions(runs):
    return runs.select("gram", "plate", F.posexplode("seconds").alias("pos", "sec"))


def _items(rows: DataFrame, crowded: Column | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows with ``low`` and ``high`` plate and count ``n``; crowded ones as cells.

    The second result is the crowded rows the cells stand for.
    """
    alone = [F.col("plate").alias("low"), F.col("plate").alias("high"), F.lit(1).cast("long").alias("n")]
    if crowded is None:
        return rows.select("*", *alone), None
    hot = rows.where(crowded)
    cells = hot.groupBy(*_CELL).agg(
        F.min("plate").alias("low"), F.max("plate").alias("high"), F.count("*").alias("n")
    )
    light = rows.where(~crowded).select("*", *alone)
    return light.unionByName(cells, allowMissingColumns=True), hot


def _overlapping(items, tolerance_s, both_sides):
    """Give each item to its own stretch and to those it reaches within the tolerance."""
    length = _stretch(tolerance_s)
    sides = (-tolerance_s, 0, tolerance_s) if both_sides else (0, tolerance_s)
    reach = [F.floor((F.col("sec") + d) / length) for d in sides]
    return items.withColumn("stretch", F.explode(F.array_distinct(F.array(*reach))))


def _neighbours(rows, crowded, tolerance_s, allow_self):
    """(gram, plate) of rows with company, possibly repeated.

    Between a row and a partner of another plate the plate changes somewhere, first right
    after a row of its own plate and within the tolerance.  So for the plates it is enough
    to compare each item with the one before it and the one after it.
    """
    items, hot = _items(rows.select(*_CELL, "plate"), crowded)
    bounds = ["low", "high"] if hot is not None else ["plate"]
    inside = (F.col("n") > 1) if allow_self else (F.col("low") != F.col("high"))
    items, company = _beside(items, bounds, tolerance_s, allow_self)
    if hot is None:
        return items.where(company).select("gram", "plate")
    # A cell's plates all have company if it is not alone, or holds more than one itself.
    full = items.where(company | inside).where(F.col("plate").isNull()).select(*_CELL).distinct()
    return (
        items.where(company & F.col("plate").isNotNull())
        .select("gram", "plate")
        .unionByName(hot.join(full, _CELL, "left_semi").select("gram", "plate"))
    )


def _beside(items, bounds, tolerance_s, allow_self, groups=None):
    """Items in their stretches, or in those of ``groups``, and the test whether the one before or after is company."""
    order = Window.partitionBy(*_GROUP).orderBy("sec")
    beside = {}
    for name, shift in (("before", F.lag), ("after", F.lead)):
        for c in ("sec", *([] if allow_self else bounds)):
            beside[f"{c}_{name}"] = shift(c).over(order)
    items = _overlapping(items, tolerance_s, both_sides=False)
    if groups is not None:
        items = items.join(groups, _GROUP, "left_semi")
    items = items.withColumns(beside)
    company = F.lit(False)
    for name in ("before", "after"):
        meets = F.abs(F.col("sec") - F.col(f"sec_{name}")) <= tolerance_s
        if not allow_self:
            differ = F.lit(False)
            for c in bounds:
                differ = differ | (F.col(c) != F.col(f"{c}_{name}"))
            meets = meets & differ
        company = company | F.coalesce(meets, F.lit(False))
    return items, company


def _accompanied(rows, crowded, tolerance_s, allow_self):
    """The rows that have another row, or plate, within the tolerance.

    The nearest row of another plate lies just before the row's run of equal plates, or
    just after it; the latter is the former in the opposite order.
    """
    items, hot = _items(rows, crowded)
    items = _overlapping(items, tolerance_s, both_sides=True)
    inside = F.col("n") > 1 if allow_self else F.col("low") != F.col("high")
    company = inside
    for turn in (1, -1):
        sec, low, high = (F.col(c) if turn > 0 else F.col(c).desc() for c in ("sec", "low", "high"))
        order = Window.partitionBy(*_GROUP).orderBy(sec, low, high)
        previous = F.lag("sec").over(order)
        if not allow_self:
            same = (F.lag("low").over(order) == F.col("low")) & (F.lag("high").over(order) == F.col("high"))
            changed = F.when(inside | ~same, previous)
            items = items.withColumn("_changed", changed)
            so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            previous = F.last("_changed", ignorenulls=True).over(so_far)
        company = company | F.coalesce(F.abs(F.col("sec") - previous) <= tolerance_s, F.lit(False))
        items = items.withColumn(f"_company_{turn}", company)
        company = F.col(f"_company_{turn}")
    home = F.floor(F.col("sec") / _stretch(tolerance_s))
    good = items.where(company & (F.col("stretch") == home))
    if hot is None:
        return good.select(*rows.columns)
    cells = good.where(F.col("plate").isNull()).select(*_CELL)
    light = good.where(F.col("plate").isNotNull()).select(*rows.columns)
    return light.unionByName(hot.join(cells, _CELL, "left_semi").select(*rows.columns))


def _accompanied_throughout(runs, crowded, n, tolerance_s, allow_self):
    """Runs with another run of the sequence within the tolerance at every position.

    Runs without company at the first position are out; what is left is written down, as
    it is used three times.  It falls into boxes one tolerance wide in every position.
    All runs of a box are near each other, so a box with two plates settles them all.  Only
    the others look for partners, in boxes so wide that a run reaches two at most in each of the
    first positions: at most eight rows a run, whatever the length of the sequence.
    """
    first = runs.select("gram", "plate", "first_id", "seconds", F.lit(0).alias("pos")).withColumn(
        "sec", F.col("seconds")[0]
    )
    width = tolerance_s + 1
    names = [f"box_{i}" for i in range(n)]
    boxes = [F.floor(F.col("seconds")[i] / width).alias(name) for i, name in enumerate(names)]
    who = "first_id" if allow_self else "plate"
    rows = _accompanied(first, crowded, tolerance_s, allow_self)
    rows = rows.select("gram", "plate", F.col(who).alias("who"), "seconds", *boxes)
    if crowded is not None and not allow_self:
        rows = rows.distinct()
    rows = written(rows)

    crowds = rows.groupBy(*names, "gram").agg((F.min("who") != F.max("who")).alias("crowd"))
    rows = rows.join(crowds, [*names, "gram"])
    settled = rows.where("crowd").select("gram", "plate")

    lone = rows.where(~F.col("crowd")).drop("crowd")
    wide = 2 * tolerance_s + 1
    names = names[:LOOKUP_POSITIONS]
    for i, name in enumerate(names):
        reach = [F.floor((F.col("seconds")[i] + d) / wide) for d in (-tolerance_s, tolerance_s)]
        lone = lone.withColumn(name, F.explode(F.array_distinct(F.array(*reach))))
    others = rows.select(
        "gram",
        *[F.floor(F.col("seconds")[i] / wide).alias(name) for i, name in enumerate(names)],
        F.col("who").alias("other"),
        F.col("seconds").alias("other_seconds"),
    )
    near = F.col("other") != F.col("who")
    for i in range(n):
        near = near & (F.abs(F.col("seconds")[i] - F.col("other_seconds")[i]) <= tolerance_s)
    found = lone.join(others, [*names, "gram"]).where(near).select("gram", "plate")
    return settled.unionByName(found)

