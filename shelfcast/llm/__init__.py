"""Operators of a training-data pipeline: one module each, DataFrame in, DataFrame out.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries,
``oracles`` their SQL counterparts.
"""
