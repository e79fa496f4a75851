"""screenrank: recommendation analytics expressed as Spark DataFrame plans.

Every operator is a function from DataFrames (plus keyword parameters) to a
DataFrame, so the same code runs in batch, inside a ``foreachBatch`` of a
Structured Streaming query, and against an independent SQL oracle.
"""

__version__ = "0.1.0"
