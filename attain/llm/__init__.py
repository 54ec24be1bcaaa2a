"""Operators for training-data pipelines: text, vectors and pages at corpus scale."""
