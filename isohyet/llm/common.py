"""What the corpus operators share: reading tables, cutting lineage, words, mixing of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.scratch import collecting, hand_over, remove, shared_dir, written

__all__ = ["collecting", "hand_over", "remove", "shared_dir", "written"]

#: A word is a run of characters outside this class (blank and the five control characters TAB to CR).
SPACES = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, rows: int, per_task: int) -> int:
    """Number of groups that holds each to about per_task rows."""
    return max(1, -(-rows // per_task))


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names with as many underscores before them as set them apart from those that are taken."""
    low = {t.lower() for t in taken}
    out = []
    for name in names:
        name = "_" + name
        while name.lower() in low:
            name = "_" + name
        out.append(name)
    return out


def ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads the bits of uint64 keys."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
