"""closepass: Spark analytics over tables of timestamped close-approach events.

Every operator takes and returns lazy DataFrames built from built-in Spark
expressions.  See README.md for the module map.
"""
