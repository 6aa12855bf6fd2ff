"""Queries on the driver's tables, each beside its SQL equivalent."""

from strataflow.queries import (  # noqa: F401  (importing registers the queries)
    averages,
    counts,
    files,
    freshness,
    measures,
    medallion,
    messages,
    streams,
    tables,
    texts,
)
from strataflow.queries.registry import ORACLES, QUERIES  # noqa: F401
