"""Operators of a training-data pipeline: text in, kept text, spans, scores and packed sequences out.

Nothing outside this package imports it.
"""
