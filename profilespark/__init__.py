"""Profiling, cleaning, evaluating and explaining labelled tables on Spark."""

from profilespark.spec import TableSpec

__all__ = ["TableSpec"]
