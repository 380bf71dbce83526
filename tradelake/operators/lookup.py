"""Left lookups whose broadcast is decided by bytes: Spark's own estimate, then the measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: Column | str | list[str],
           small: bool | None = None, how: str = "left") -> DataFrame:
    """Join ``dim`` onto ``fact``; no job runs while the plan is built.

    A ``dim`` below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, so ``fact`` is not moved: at once
    where the files tell its size, else by AQE when it has been computed.  A larger one is joined by a
    shuffle, where AQE splits the fact side of a hot key over many tasks.  ``small=True`` is for a caller that
    has a bound on the size of ``dim``: it is broadcast whatever Spark estimates.
    """
    return fact.join(F.broadcast(dim) if small else dim, on, how)
