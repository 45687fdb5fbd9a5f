"""sparkrec: recommendation analytics on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and runs
as one distributed job for any number of users or items.
"""

__version__ = "0.1.0"
