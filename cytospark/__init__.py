"""Spark operators for wide single-cell measurement tables.

Every operator takes and returns DataFrames and is parameterised by column
names, so it runs on any table with one row per observation.
"""

__version__ = "0.1.0"
