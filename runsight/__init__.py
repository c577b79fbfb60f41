"""runsight: pipeline-observability analytics on PySpark.

Every operator is a pure function from DataFrames to a DataFrame.  Nothing
reads the wall clock: callers pass ``as_of`` explicitly, so a run can be
replayed and a stream agrees with the batch form.
"""

__version__ = "0.1.0"
