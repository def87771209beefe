"""Log analytics, experiment analysis and drift operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers get the helpers of this package with the task, so that a cluster needs
# no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
