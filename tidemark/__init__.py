"""tidemark: change-data lakehouse operators for PySpark.

Every operator is a plain function over DataFrames (or Columns), so the same code runs in
batch and inside a Structured Streaming micro-batch.
"""

__version__ = "0.1.0"
