"""parlato: preparing and scoring speech-transcript corpora on Spark.

Every operator is a function over DataFrames or Columns. Nothing here opens a
session; callers pass theirs in.
"""
