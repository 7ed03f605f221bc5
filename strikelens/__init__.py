"""strikelens: incident analytics written as Spark DataFrame operators.

Every operator is a plain function from DataFrames (or Columns) to DataFrames
(or Columns). Operators that do not rank rows take batch and streaming frames
alike, so the streaming jobs reuse the batch logic unchanged.
"""

__version__ = "0.1.0"
