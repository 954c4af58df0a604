"""Operators for training-data pipelines.

Nothing else in the library imports this subpackage.  Its functions are pickled
by value, so executors need no copy of the package: the tasks carry the code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
