"""Document ingest and retrieval as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Arrow tasks get the helpers of this package with the task itself, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
