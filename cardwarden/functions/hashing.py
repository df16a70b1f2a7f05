"""A uniform draw per row that depends on the row key only.

``rand`` and ``randomSplit`` change with the partitioning and on task retries. The draw here is a
salted digest of the key, so a split or a sample is the same on every cluster and in every run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: str | list[str], seed: int = 42) -> Column:
    """32 hex digits whose text order is a random order of the keys."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys])))


def uniform(key: str | list[str], seed: int = 42) -> Column:
    """The first 32 digest bits as a double in [0, 1)."""
    head = F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(2**32))
