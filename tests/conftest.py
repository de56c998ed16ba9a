from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from gaugeflow.session import local_session

    return local_session(8)


@pytest.fixture
def values(spark):
    """Evaluate columns over one row of named literals: ``values(expr, a=1)``."""
    from pyspark.sql import functions as F

    def run(*columns, **literals):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()] or ["id"])
        row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run
