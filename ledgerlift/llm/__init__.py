"""Operators that prepare text and vectors for training language models.

Nothing else in the library imports this package. Its task functions travel to executors
by value, so an executor needs numpy, pyarrow and the named third-party libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
