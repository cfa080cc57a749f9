"""moundlake: Spark-native pitch and batted-ball analytics.

Every operator is a function ``DataFrame -> DataFrame`` whose column names and
thresholds are arguments, so the same code runs on pitch data and on any
star-schema or event table, in batch and (for ingest) as a stream.
"""

import sys as _sys

from moundlake.session import get_spark, checkpoint_dir

# Functions that run in Python workers (the ordered scans' mapInPandas) are shipped by
# value, so executors need no installed copy of this package (works on any cluster
# and when the driver imports it from a path the workers do not have).
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pyspark: fall back to by-reference pickling
    pass

__all__ = ["get_spark", "checkpoint_dir"]
