"""Operators of a training-data pipeline over documents and pages.

Their Python functions travel to the executors by value, so that these need Python, numpy and
pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
