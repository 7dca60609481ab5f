"""Small-area statistics on Spark: clean, key, count, join and model area tables."""

from areastats.config import KEY

__all__ = ["KEY"]
