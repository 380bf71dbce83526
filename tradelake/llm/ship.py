"""Gives the executors' Python workers this package."""

from tradelake.ship import ship

__all__ = ["ship"]
