"""Sources (stored results, landed boards, derived fixture views) and sinks."""

from podium.sources import fixtures
from podium.sources.sinks import append_results, overwrite_partitions, write_marker, write_messages
from podium.sources.tables import parse_board_text, read_board, read_results, read_results_raw

__all__ = [
    "append_results",
    "fixtures",
    "overwrite_partitions",
    "parse_board_text",
    "read_board",
    "read_results",
    "read_results_raw",
    "write_marker",
    "write_messages",
]
