"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_null(names: list[Column]) -> Column:
    """The different non-NULL ones of several texts, in order.

    Unlike ``array_compact`` this has no lambda and stays inside generated code.
    """
    return F.array_except(F.array(*names), F.array(F.lit(None).cast("string")))
