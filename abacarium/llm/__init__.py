"""Operators for training text: language, copies, contamination, privacy, tokens, shards, toxicity.

Nothing else in the package imports this one. Python code for the executors is
shipped by value, so that they need numpy, pandas and pyarrow but not this package.
"""
