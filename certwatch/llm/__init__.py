"""Operators for preparing training data; nothing else in certwatch imports this package."""

import sys

from pyspark import cloudpickle

# ship the code with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
