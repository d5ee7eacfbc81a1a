"""Operators of a training-data pipeline, one module each, and their queries.

Functions of this package that run in tasks are sent with the task, so executors need
no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
