"""Projections that the optimizer keeps apart.

Merged into one, a long chain of columns is evaluated once per use, filters on it are evaluated below it again, and the
generated method grows beyond the 8000 bytes up to which the JVM compiles a method: above that it is interpreted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def step(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns added or replaced, by a generator of one element."""
    kept = df.columns if keep is None else keep
    if not columns:
        return df.select(*kept)
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_step")
    return df.select(*[c for c in kept if c not in columns], made).select(*[c for c in kept if c not in columns], "_step.*")
