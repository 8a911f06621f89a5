"""A small table that is replaced as a whole, batch by batch, with old versions removed.

Versions take turns in a fixed number of slots. A version is first written to
its slot; the manifest of that slot, written after it, is the commit. Readers
take the newest manifest and the slot it names, so they see the version before
until the commit, and a writer that dies in between leaves that one whole.
Writing to a slot replaces the version that was there: the number of files stays
the same however many batches come.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.readers import path_exists

#: A reader may go on with its version while SLOTS - 2 newer ones are written.
SLOTS = 4
MANIFEST = "version bigint, slot int, batch bigint"


def newest_manifest(spark: SparkSession, path: str) -> Row | None:
    """The last committed version: one row per slot is read."""
    folder = f"{path}/manifest"
    if not path_exists(spark, folder):
        return None
    found = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(folder)
    return found.filter("version IS NOT NULL").orderBy(F.desc("version")).first()


def _slot(path: str, slot: int) -> str:
    return f"{path}/data/{slot}"


def read_version(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table of the last committed version; with a schema, no rows before the first commit."""
    last = newest_manifest(spark, path)
    if last is None:
        if schema is None:
            raise FileNotFoundError(f"no version of {path} was committed")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_slot(path, last.slot))


def replace_version(
    spark: SparkSession, path: str, batch: int, make: Callable[[DataFrame | None], DataFrame], schema=None, slots: int = SLOTS
) -> int:
    """Commit ``make(previous version)`` as the next version, unless ``batch`` is committed already.

    ``make`` gets None before the first version. Batches must be numbered in
    their order; a batch that was stopped before its commit is made again from
    the same previous version. One writer at a time.
    """
    last = newest_manifest(spark, path)
    if last is not None and last.batch >= batch:
        return last.version
    version = 0 if last is None else last.version + 1
    slot = version % slots
    before = None if last is None else read_version(spark, path, schema)
    make(before).coalesce(1).write.mode("overwrite").parquet(_slot(path, slot))
    manifest = spark.createDataFrame([(version, slot, batch)], MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{slot}")
    return version
