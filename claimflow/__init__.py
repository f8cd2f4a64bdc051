"""Spark-native analytics for insurance-claim tables.

Every function takes and returns DataFrames or Columns.  Nothing here creates a
session; callers bring their own.
"""
