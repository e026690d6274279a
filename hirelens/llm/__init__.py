"""Operators for large training-data pipelines.

Nothing outside this folder imports it. Each module holds one operator with
its own interface; ``queries`` holds the thin registered queries.
"""
