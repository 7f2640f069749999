"""Spark-first document extraction, reconciliation and record-linkage engine."""

__version__ = "0.1.0"
