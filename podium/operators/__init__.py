"""Relational operators: ingest, ranking, streaks, medians."""

from podium.operators import ingest, medians, ranking, streaks

__all__ = ["ingest", "medians", "ranking", "streaks"]
