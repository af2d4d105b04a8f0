"""tillwork: composable Spark operators for retail-transaction analytics."""

import sys

from pyspark import cloudpickle

# Python functions used inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
