"""Structured Streaming ingest of landed leaderboard files."""
