"""Report plans composed from the operators."""

from podium.plans import reports

__all__ = ["reports"]
