"""Whole plans: pipelines and named queries."""
