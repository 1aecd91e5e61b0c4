"""stagecraft: load large numbers of staged files into tables, in order, with Spark.

The manifest (one row per staged file) is a DataFrame; every state change
is a DataFrame transform; loads, sizing and monitoring are Spark jobs.
"""

__version__ = "0.1.0"
