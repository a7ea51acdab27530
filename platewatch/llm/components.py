"""Connected components of a graph given as links between numbers.

Alternates two steps that keep the components and turn every tree into a star around its
smallest node: each node hands its larger neighbours, then its smaller ones, to the
smallest node it knows.  The smallest neighbour is an aggregate, combined before its
shuffle, and joined back, so a hub's links may be spread over tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewatch.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Columns node, root (smallest node of its component), for nodes with a link.

    Links of a node with itself and repeated or turned links change nothing; nulls are
    ignored; no links give no rows.  Each round is written to the shared folder.
    """
    stars = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    )
    stars = stored(stars.distinct(), "links")
    state = _state(stars)
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        previous, state = state, _state(stars)
        if state == previous:
            break
    tops = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.unionByName(tops)


def _state(stars):
    """Equal for equal sets of links: their number and the sum of their hashes."""
    pair = F.xxhash64("node", "root").cast("decimal(20,0)")
    return tuple(stars.agg(F.count("*"), F.sum(pair)).first())


def _with_smallest(links):
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    return links.join(least, "node").withColumn("least", F.least("least", "node"))


def _large_star(stars):
    """Hand the larger neighbours to the smallest neighbour."""
    both = stars.select("node", F.col("root").alias("other")).unionByName(
        stars.select(F.col("root").alias("node"), F.col("node").alias("other"))
    )
    moved = _with_smallest(both).where(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(stars):
    """Hand the smaller neighbours, and the node itself, to the smallest neighbour."""
    known = _with_smallest(stars.select("node", F.col("root").alias("other")))
    others = known.select(F.col("other").alias("node"), F.col("least").alias("root"))
    selves = known.select("node", F.col("least").alias("root"))
    moved = others.unionByName(selves).where(F.col("node") != F.col("root"))
    return moved.distinct()
