"""Regularly sampled market snapshots from raw equity quote and trade ticks, on Spark."""

__version__ = "0.1.0"
