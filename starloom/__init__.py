"""Incremental retail star schema on Spark: extract, stage, merge, publish, report."""

__version__ = "0.1.0"
