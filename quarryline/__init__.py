"""Spark-first analytics engine for time-ordered event streams and evidence graphs."""
