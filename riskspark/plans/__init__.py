"""Operators composed into the daily run, the serving reads and the checked queries."""
