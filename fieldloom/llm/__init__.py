"""Operators for training-data pipelines over document tables. Nothing else in fieldloom imports this package."""
