"""Registered queries and, where SQL can say it, the same result in DuckDB SQL."""

from burnish.registry import (  # noqa: F401 - importing registers the queries
    audit,
    actions,
    decisions,
    detection,
    domains,
    expressions,
    injection,
    loading,
    profiles,
    scores,
    streams,
)
from burnish.registry.base import ORACLES, QUERIES  # noqa: F401
