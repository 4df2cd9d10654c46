"""Spark library for daily retail demand forecasting.

``functions``  column expressions (business rules, bins, scores)
``sources``    table readers with declared schemas, sinks, model storage
``operators``  DataFrame to DataFrame building blocks
``plans``      whole jobs and the command line that runs them
``catalog``    the registered queries with their SQL counterparts
``standins``   the library's input tables derived from the given test tables
"""
