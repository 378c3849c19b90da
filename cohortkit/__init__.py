"""cohortkit — cohort analytics on Spark DataFrames.

DataFrame in, DataFrame out; column names as arguments; built-in Spark
expressions only on the hot path.
"""

__version__ = "0.1.0"
