"""Behaviour analytics for clocked, turn-based games, written as Spark jobs."""

__version__ = "0.1.0"
