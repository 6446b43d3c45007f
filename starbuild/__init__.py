"""starbuild: layered warehouse building blocks for PySpark.

Every operator is a plain function from DataFrames to a DataFrame.  Dates and
batch identifiers are arguments, so the same inputs always give the same table.
"""

__version__ = "0.1.0"
