"""Text enrichment and analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# What runs in Python tasks travels with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
