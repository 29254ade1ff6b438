"""Pipelines composed of operators."""
