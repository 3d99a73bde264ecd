"""Sky-survey analytics as PySpark DataFrame operators.

Every operator takes DataFrames (or Columns) and returns a lazy DataFrame (or
Column); see the README for the few places that store an intermediate table.
"""
