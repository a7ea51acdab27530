"""The analyses from input to result rows, as a job would run them.

Each returns rows in the layout of its result table; ``sinks.results.write_results``
appends them to a database.
"""

from pyspark.sql import DataFrame

from platewatch.model import MAX_KMH, SEQUENCE_LENGTH, TOLERANCE_S
from platewatch.operators.clone import clone_plate_adjacent, clone_plate_pairs, clone_plate_report
from platewatch.operators.cotravel import cotravel_groups, cotravel_members, cotravel_result
from platewatch.operators.membership import first_entry, plate_set
from platewatch.operators.scan import sightings_since
from platewatch.sinks.results import clone_result


def cloned_plates(
    sightings: DataFrame,
    run_id: int,
    run_time,
    since=None,
    max_kmh: float = MAX_KMH,
    scope: str = "all_pairs",
    **options,
) -> DataFrame:
    """Rows for the clone table: both sightings of every pair that is too fast.

    ``scope`` compares all pairs of a plate's sightings or only ``adjacent`` ones.
    """
    find = {"all_pairs": clone_plate_pairs, "adjacent": clone_plate_adjacent}[scope]
    pairs = find(sightings, since, max_kmh, **options)
    return clone_result(clone_plate_report(pairs, sightings, run_id, run_time))


def travelling_together(
    sightings: DataFrame,
    run_id: int,
    run_time,
    since=None,
    n: int = SEQUENCE_LENGTH,
    tolerance_s: int = TOLERANCE_S,
    match: str = "any",
    allow_self: bool = False,
    **options,
) -> DataFrame:
    """Rows for the co-travel table: the plates of every sequence of sites with company."""
    members = cotravel_members(sightings, since, n, tolerance_s, match, allow_self, **options)
    return cotravel_result(cotravel_groups(members), run_id, run_time)


def first_entries(arrivals: DataFrame, known: DataFrame, since=None) -> DataFrame:
    """Arrivals of plates the known sightings do not hold."""
    return first_entry(sightings_since(arrivals, since), plate_set(known))
