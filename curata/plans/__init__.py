"""Composed jobs, inputs derived from the driver tables, and the query catalog."""
