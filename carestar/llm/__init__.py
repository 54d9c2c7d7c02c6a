"""Operators of a training-data pipeline over documents, labels, benchmark and conversations.

Nothing else in the library imports this package. Functions that run in Python workers are
sent by value, so executors need none of these modules on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
