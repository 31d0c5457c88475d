"""shelfseek: vector and full-text product search as Spark jobs."""

import sys

from pyspark import cloudpickle

# Send the package's functions along with the tasks that use them, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
