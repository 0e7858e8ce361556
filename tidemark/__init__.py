"""Tidemark: keep analytical tables in step with changing sources, on Spark.

Everything is expressed with the DataFrame, SQL and Structured Streaming
APIs; see README.md for the map of modules.
"""

__version__ = "0.1.0"
