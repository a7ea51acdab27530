"""Finding keys that hold too many rows for one task, and keeping them apart."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from platewatch.session import written

# A key is heavy when it holds more rows than one task should sort, whatever the size of the table.
HEAVY_ROWS = 5_000_000
# Beyond this many heavy keys all keys are treated as heavy, so the list stays short.
HEAVY_KEYS = 10_000

# Rows of a heavy key that go into one piece.
PIECE_ROWS = 2_000_000


class EveryKey(dict):
    """Stands for all keys, under the number of all rows."""

    def __init__(self, total: int):
        super().__init__({None: total})


def heavy_keys(
    rows: DataFrame,
    key: str,
    min_rows: int = HEAVY_ROWS,
    most_keys: int = HEAVY_KEYS,
    total: int | None = None,
) -> dict:
    """Heavy values of a column with their row counts, or ``EveryKey`` if they are more than ``most_keys``.

    Which of the two ways a key goes changes the plan, never the rows.  Counting reads one
    column and combines before its shuffle.  A table with no more than ``min_rows`` rows is
    not grouped at all.
    """
    if total is None:
        total = rows.count()
    if total <= min_rows:
        return {}
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    found = counts.where(F.col("n") > min_rows).select(key, "n").limit(most_keys + 1).collect()
    return EveryKey(total) if len(found) > most_keys else dict(found)


def split_rows(rows: DataFrame, key: str, heavy: dict) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of heavy keys."""
    inside = is_heavy(F.col(key), heavy)
    return rows.where(~inside), rows.where(inside)


def is_heavy(key: Column, heavy: dict) -> Column:
    if isinstance(heavy, EveryKey):
        return F.lit(True)
    return F.coalesce(key.isin([k for k in heavy if k is not None]), F.lit(False))


def in_pieces(rows: DataFrame, heavy: dict, order: list[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Cut the rows into contiguous runs of the given order and number the runs in ``_piece``.

    The range partitioner splits on the whole order, so one key, or one moment of one key,
    spreads over as many pieces as it needs.
    """
    pieces = max(1, -(-sum(heavy.values()) // piece_rows))
    return rows.repartitionByRange(pieces, *order).withColumn(
        "_piece", F.spark_partition_id().cast(LongType())
    )


def ranked(rows: DataFrame, keys: list[str], order: list[str], total: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Rows with ``_rank``, their place from 0 within the keys by the order, however many a key has.

    Each piece numbers its own rows and adds the rows of its key in the pieces before it.  The
    pieces are written down, as their cuts are sampled and have to be the same for both uses.
    """
    pieces = written(in_pieces(rows, {None: total}, [*keys, *order], piece_rows))
    counts = pieces.groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    numbered = pieces.join(offsets, [*keys, "_piece"]).withColumn(
        "_rank", F.row_number().over(inside) - 1 + F.col("_before")
    )
    return numbered.drop("_piece", "_before")
