"""Operators for training-data pipelines; each module holds one operator and its query.

The package is pickled by value, so executors need no copy of it on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
