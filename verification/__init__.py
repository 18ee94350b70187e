"""Registered queries and their SQL counterparts over the test tables."""

from __future__ import annotations


def all_entries() -> dict:
    """Name -> entry, in the order of the operator inventory."""
    from verification import (  # noqa: F401
        queries_clusters,
        queries_games,
        queries_models,
        queries_players,
    )
    from verification.registry import ENTRIES

    return dict(sorted(ENTRIES.items()))
