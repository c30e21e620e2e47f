"""Abacarium: Spark-native sales reporting, warehouse loading and ledger analytics.

Every operator is a function from DataFrames to a DataFrame, built on the
DataFrame and SQL APIs, and takes column names and thresholds as parameters.
"""
