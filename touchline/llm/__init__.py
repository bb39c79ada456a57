"""Operators for training-data pipelines over text, pages and benchmarks.

Nothing outside this folder imports it. ``queries.py`` registers one query
per operator; each operator module keeps its own general interface.
"""
