"""Trade analytics on Spark: batch, streaming and warehouse operators over DataFrames."""

from tradelake import fixtures, schemas, session, sinks, sources, streaming
from tradelake.functions import envelope, keys, parse
from tradelake.operators import (
    dedup,
    dims,
    enrich,
    lookup,
    maintenance,
    merge,
    ordered,
    quality,
    search,
    windows,
)
from tradelake.plans import jobs, marts
from tradelake.sources import confirmations

__all__ = [
    "confirmations", "dedup", "dims", "enrich", "envelope", "fixtures", "jobs", "keys",
    "lookup", "maintenance", "marts", "merge", "ordered", "parse", "quality", "schemas",
    "search", "session", "sinks", "sources", "streaming", "windows",
]
