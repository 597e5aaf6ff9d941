"""Spark-first data engine for sensor datasets, annotations and robot fleets."""
