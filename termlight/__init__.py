"""Document search, ranking evaluation and query refinement as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; the workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
