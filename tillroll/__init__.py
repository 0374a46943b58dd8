"""tillroll: retail sales ingestion and monthly data marts on Spark.

Every operator is a DataFrame -> DataFrame function written with Spark's
public API; the caller owns the SparkSession.
"""

__version__ = "0.1.0"
