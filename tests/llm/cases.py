"""Awkward documents that every operator has to take."""

from pyspark.sql import functions as F


SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "_hash string, slot string, Epoch string, shard string, spans string, _key map<string,int>"
)
LONG = "the quick onder of brown " * 20_000
ROWS = [
    (1, "plain words that stand here for a text of some length", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (4, " \t\n ", "en", "a", 4),
    (5, LONG, "en", "b", len(LONG)),
    (6, "plain words that stand here for a text of some length", "en", "b", 1),
    (6, "plain words that stand here for a text of some length", "en", "b", 1),
    (None, "a text without an id but with words", None, "c", 7),
    (None, None, None, None, None),
    (9, "one", "en", "c", 3),
    (9, "two", "en", "c", 3),
]


def awkward(spark, rows=ROWS):
    extra = ("x", "y", None, "z", "w", {"k": 1})
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3)


def nothing(spark):
    return awkward(spark).where(F.lit(False))
