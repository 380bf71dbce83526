"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelake.schemas import SURROGATE_NULL


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the text of ``cols`` joined by ``-``, NULL parts replaced by a fixed mark."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
