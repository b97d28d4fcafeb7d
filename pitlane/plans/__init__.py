"""Composed plans: the full pipeline, the test view and the driver queries."""
