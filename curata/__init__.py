"""curata: config-driven table loading and curation on Spark.

Every operator is a DataFrame -> DataFrame function built from the Spark SQL
and Structured Streaming APIs, so the same code serves batch loads and
micro-batches.
"""

__version__ = "0.1.0"
