"""Readers, writers and file-level checks."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def persist_tables(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> tuple[DataFrame, ...]:
    """Mark frames for caching (spill to disk when memory is short) for repeated
    interactive queries; cached blocks lost with an executor are recomputed from
    lineage.  Pair with ``unpersist_tables``."""
    return tuple(f.persist(level) for f in frames)


def unpersist_tables(*frames: DataFrame) -> None:
    for f in frames:
        f.unpersist()
