"""A plate's sightings in order: neighbours, sequences of sites and whole trails."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewatch.functions.clock import epoch_seconds
from platewatch.model import SEQUENCE_LENGTH
from platewatch.operators.scan import sightings_since
from platewatch.operators.skew import PIECE_ROWS, heavy_keys, in_pieces, ranked, split_rows

ORDER = ["pass_time", "id"]
TRAIL_ROWS = 10_000


def consecutive(
    sightings: DataFrame,
    n: int,
    carry: list[str],
    heavy: dict | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Every run of ``n`` successive sightings of a plate: ``plate``, ``steps``.

    ``steps`` is an array of structs of the carried columns, in order of passing.
    Ordinary plates take one window.  A heavy plate is cut into pieces: runs inside a
    piece come from a window per piece, runs across a cut from a second window over the
    ``n - 1`` rows on either side of every cut, which is all such a run can touch.
    Sightings without a plate belong to no run.
    """
    if n < 2:
        raise ValueError("a sequence has at least two sightings")
    rows = sightings.where(F.col("plate").isNotNull()).select(
        "plate", *ORDER, F.struct(*carry).alias("step")
    )
    if heavy is None:
        heavy = heavy_keys(rows, "plate")
    if not heavy:
        return _runs(rows, n)
    light, hot = split_rows(rows, "plate", heavy)
    return _runs(light, n).unionByName(_runs_across_pieces(hot, n, heavy, piece_rows))


def _followers(window, n):
    return [F.lead("step", k).over(window).alias(f"_{k}") for k in range(1, n)]


def _runs(rows, n):
    window = Window.partitionBy("plate").orderBy(*ORDER)
    followed = rows.select("plate", "step", *_followers(window, n))
    return followed.where(F.col(f"_{n - 1}").isNotNull()).select(
        "plate", F.array("step", *[f"_{k}" for k in range(1, n)]).alias("steps")
    )


def _runs_across_pieces(rows, n, heavy, piece_rows):
    rows = in_pieces(rows, heavy, ["plate", *ORDER], piece_rows)
    inside = Window.partitionBy("plate", "_piece").orderBy(*ORDER)
    rows = rows.select(
        "*",
        *_followers(inside, n),
        F.lag("step", n - 1).over(inside).isNull().alias("_head"),
        F.lead("step", n - 1).over(inside).isNull().alias("_tail"),
    )
    # Rows near a cut meet in one group per plate; the others stay with their piece.
    group = F.when(F.col("_head") | F.col("_tail"), F.lit(-1)).otherwise(F.col("_piece"))
    edges = Window.partitionBy("plate", "_group").orderBy(*ORDER)
    rows = rows.withColumn("_group", group).select(
        "*", *[F.lead("step", k).over(edges).alias(f"_e{k}") for k in range(1, n)]
    )
    steps = [F.when(F.col("_tail"), F.col(f"_e{k}")).otherwise(F.col(f"_{k}")) for k in range(1, n)]
    return (
        rows.select("plate", F.array("step", *steps).alias("steps"))
        .where(F.col("steps")[n - 1].isNotNull())
    )


def site_sequences(
    sightings: DataFrame, n: int = SEQUENCE_LENGTH, since=None, clock12: bool = False, **skew
) -> DataFrame:
    """Runs of ``n`` sites a plate passed one after the other.

    ``plate``, ``first_id`` (unique per row), ``gram`` (array of sites), ``seconds`` (array
    of passing times).
    """
    rows = sightings_since(sightings, since).withColumn(
        "sec", epoch_seconds(F.col("pass_time"), clock12)
    )
    runs = consecutive(rows, n, ["id", "site_id", "sec"], **skew)
    return runs.select(
        "plate",
        F.col("steps")[0]["id"].alias("first_id"),
        F.col("steps.site_id").alias("gram"),
        F.col("steps.sec").alias("seconds"),
    )


def plate_trail(
    sightings: DataFrame,
    since=None,
    trail_rows: int = TRAIL_ROWS,
    heavy: dict | None = None,
    piece_rows: int = PIECE_ROWS,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Each plate's sightings in order, as arrays: ``plate``, ``part``, ``n``, ``trail``.

    A trail longer than ``trail_rows`` continues in further rows, so that no array grows
    without bound.  ``part`` counts them from 0; all but a plate's last are full.  ``starts`` (``plate``, ``n``) tells
    how many earlier sightings a plate has elsewhere: its first row here then goes on with the part they end in.
    """
    rows = sightings_since(sightings, since).where(F.col("plate").isNotNull())
    rows = rows.select("plate", "pass_time", "id", "site_id")
    if heavy is None:
        heavy = heavy_keys(rows, "plate")
    place = F.row_number().over(Window.partitionBy("plate").orderBy(*ORDER)) - 1
    if not heavy:
        return _parts(rows.withColumn("_rank", place), trail_rows, starts)
    light, hot = split_rows(rows, "plate", heavy)
    numbered = ranked(hot, ["plate"], ORDER, sum(heavy.values()), piece_rows)
    return _parts(light.withColumn("_rank", place), trail_rows, starts).unionByName(_parts(numbered, trail_rows, starts))


def _parts(rows, trail_rows, starts):
    if starts is not None:
        # Most sightings of a stretch are of plates that the list has: it is as long as there are plates.
        rows = rows.join(starts.select("plate", F.col("n").alias("_start")), "plate", "left")
        rows = rows.withColumn("_rank", F.col("_rank") + F.coalesce("_start", F.lit(0))).drop("_start")
    stop = F.struct("pass_time", "id", "site_id")
    return (
        rows.withColumn("part", F.floor(F.col("_rank") / trail_rows))
        .groupBy("plate", "part")
        .agg(F.count("*").alias("n"), F.array_sort(F.collect_list(stop)).alias("trail"))
    )
