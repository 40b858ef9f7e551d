"""Which files of a folder are new, changed or gone since they were last taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import versions

NEW, CHANGED, GONE = "new", "changed", "gone"


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def difference(now: DataFrame, before: DataFrame) -> DataFrame:
    """(path, change) of the files that differ between two inventories."""
    old = before.select("path", F.struct("length", "modified").alias("old"))
    both = now.select("path", F.struct("length", "modified").alias("own")).join(old, "path", "full")
    change = (
        F.when(F.col("old").isNull(), NEW)
        .when(F.col("own").isNull(), GONE)
        .when(F.col("own") != F.col("old"), CHANGED)
    )
    return both.select("path", change.alias("change")).where("change IS NOT NULL")


class ChangeSet:
    """The changes of a folder since the last :meth:`done`, which are fixed when it is made.

    ``changes`` has (path, change). :meth:`paths` are the files to read. A job reads them, stores
    what it made of them, and then calls :meth:`done`; if it dies before, the same files come
    again. Files that change while the job runs come with the next change set. The inventories are
    a versioned table below ``store``.
    """

    def __init__(self, spark: SparkSession, path: str, store: str, pattern: str = "*"):
        self.spark, self.store = spark, store
        # Listed once and written, so that what is done is what was compared.
        self.listed = f"{store.rstrip('/')}-listed"
        versions.replace(inventory(spark, path, pattern), self.listed)
        self.now = versions.read(spark, self.listed)
        known = versions.version(spark, store)
        before = self.now.limit(0) if known is None else versions.read(spark, store, known)
        self.changes = difference(self.now, before)

    def paths(self, *kinds: str) -> list[str]:
        """Files that are new or changed, or of the given ``kinds``: what a reader takes as paths."""
        rows = self.changes.where(F.col("change").isin(*(kinds or (NEW, CHANGED)))).collect()
        return sorted(row["path"] for row in rows)

    def done(self) -> None:
        versions.replace(self.now, self.store)
        for table in (self.store, self.listed):
            versions.vacuum(self.spark, table)
