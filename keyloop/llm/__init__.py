"""Operators of a training-data pipeline over large text tables.

Each module holds one operator; ``queries`` registers them.  Their functions run inside Spark
tasks, so the package is pickled by value: executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
