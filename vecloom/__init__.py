"""Data work around text embedding models, as Spark jobs."""

import sys

from pyspark import cloudpickle

# What a task needs of this package travels with it, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
