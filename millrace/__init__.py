"""millrace: a Spark-native file-to-mart pipeline.

Folders of CSV, Excel and Parquet files are fingerprinted, landed in Bronze as
text with lineage, typed and cleaned into Silver, and shaped into dimension,
fact and mart tables that are quality-checked and exported.  Every step is a
DataFrame / Spark SQL plan.
"""

import sys as _sys

__version__ = "0.1.0"

# The few Python functions that run inside tasks (mapInPandas / applyInPandas
# bodies) are shipped by value, so executors need no installed copy of this
# package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler: ship with --py-files instead
    pass
