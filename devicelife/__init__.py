"""devicelife: device-lifecycle analytics on Spark.

Read multi-table device reports, clean and resample their readings into
fixed time buckets, derive time-series features and forward-looking failure
labels, then split, balance, train, evaluate, save and score failure
classifiers; every step is a Spark DataFrame or Spark ML operation.
"""

__version__ = "0.1.0"
