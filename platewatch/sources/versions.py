"""Versions of a set of plates, and which of them a micro-batch saw."""

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewatch.operators.membership import BROADCAST_BYTES, frozen
from platewatch.sinks.alerts import read_or_empty

VERSIONS = "version long, folder string"
CHOICES = "stream string, batch_id long, version long"


@dataclass
class PlateVersions:
    """A table of plates, such as a watchlist, that is replaced as a whole from time to time.

    A version is written to a folder of its own and then published by one row of a list, so it is seen whole or not
    at all.  Versions count from 1.  A micro-batch takes the latest version and notes which one that was
    before it is joined; repeated after a failure it takes the noted one, so it sees the plates it saw before.  A
    version is read and measured once per driver, however many micro-batches use it.  One writer publishes at a time.
    """

    path: str
    max_broadcast: int = BROADCAST_BYTES
    _at_hand: dict[int, DataFrame] = field(default_factory=dict, repr=False)

    def publish(self, plates: DataFrame) -> int:
        """Add a version; its number."""
        spark = plates.sparkSession
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        plates.write.parquet(folder)
        number = self.latest(spark) + 1
        _note(spark, f"{self.path}/versions", VERSIONS, (number, folder))
        return number

    def latest(self, spark: SparkSession) -> int:
        """The number of the newest version, 0 before the first."""
        return self._versions(spark).agg(F.max("version")).first()[0] or 0

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        """One version as it was published."""
        found = self._versions(spark).where(F.col("version") == version).agg(F.min("folder")).first()[0]
        if found is None:
            raise ValueError(f"no version {version} under {self.path}")
        return spark.read.parquet(found)

    def seen_by(self, spark: SparkSession, stream: str, batch_id: int) -> DataFrame:
        """The plates a micro-batch is joined with: the noted version, or the latest, which is noted."""
        own = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
        version = read_or_empty(spark, f"{self.path}/choices", CHOICES).where(own).agg(F.min("version")).first()[0]
        if version is None:
            version = self.latest(spark)
            if not version:
                raise ValueError(f"nothing has been published under {self.path}")
            _note(spark, f"{self.path}/choices", CHOICES, (stream, batch_id, version))
        if version not in self._at_hand:
            self._at_hand.clear()
            self._at_hand[version] = frozen(self.read(spark, version), self.max_broadcast)
        return self._at_hand[version]

    def _versions(self, spark):
        return read_or_empty(spark, f"{self.path}/versions", VERSIONS)


def _note(spark, path, schema, row):
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
