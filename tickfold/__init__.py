"""Equity-factor analytics on Spark: panel -> factors -> model -> portfolio."""

__version__ = "0.1.0"
