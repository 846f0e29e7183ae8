"""Spark-native analytics over the tables and streams a data platform produces.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or
Column).  Reference times, ordering tiebreaks and slice widths are arguments, so
a result never depends on the wall clock, on partition order or on key skew.
"""
