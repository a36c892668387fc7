"""Discussion analytics on Spark: posts, their comments, and user comment histories."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
