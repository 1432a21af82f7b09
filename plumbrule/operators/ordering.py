"""Global order by one shuffle that does not depend on how often a row is repeated.

A range shuffle sends equal sort keys to one task. Where a third of all rows may be copies of one row, that task would get a third
of the data. Two more keys behind the asked ones cut such runs: a hash of the row, which spreads rows that agree in the asked keys
but differ elsewhere, and a number that tells copies of one row apart. That number depends on the order in which a task
meets its rows, but only among equal rows: should a lost task run again and meet them in another order, copies of one
row change places and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.functions.columns import column

SPREAD, COPY = "__spread", "__copy"


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of `df` in the order of `keys`."""
    told_apart = df.withColumns({SPREAD: F.xxhash64(*(column(name) for name in df.columns)), COPY: F.monotonically_increasing_id()})
    return told_apart.orderBy(*(column(key) for key in keys), SPREAD, COPY).drop(SPREAD, COPY)
