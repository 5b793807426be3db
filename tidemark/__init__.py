"""tidemark: change-history marts on Spark.

Turns repeated loads of semi-structured records into an analytical star
schema: landing and typing, latest record per key, type 2 history with
validity dates, JSON arrays to bridge tables, and incremental maintenance
by high-watermark append or keyed upsert.  Every operator is a function
from DataFrames to a DataFrame built from Spark's own functions.
"""

__version__ = "0.1.0"
