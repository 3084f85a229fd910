"""Imports every query module, so that the registry is complete."""

from verification import (  # noqa: F401
    queries_ingest, queries_joins, queries_maintained, queries_metrics, queries_more, queries_players,
    queries_results, queries_teams,
)
from verification.registry import QUERIES, SQL  # noqa: F401
