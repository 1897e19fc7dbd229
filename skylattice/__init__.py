"""Reusable PySpark operators for time-stamped event tables.

Profiling and cleaning, time-keyed and as-of joins, trailing-window and graph
features, correlation based feature selection, blocked time folds and fold-wise
MLlib training. Everything takes and returns DataFrames.
"""
