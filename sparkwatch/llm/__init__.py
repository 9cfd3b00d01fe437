"""Operators for preparing training data at corpus scale.

Functions that run inside tasks are sent to the executors by value, so a cluster needs
numpy and pyarrow, but not this package, on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
