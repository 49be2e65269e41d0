"""A Spark engine for profiling, drawing, correcting and certifying tables against known distributions."""

__version__ = "0.1.0"
