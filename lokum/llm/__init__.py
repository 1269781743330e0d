"""Training-data operators: language ID, dedup (exact, near, line), source mixing,
quality scoring, chat formatting, WARC bundles, nearest neighbours and packing.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; ``queries.py`` holds the thin registered
queries and ``oracles.py`` their SQL.
"""
