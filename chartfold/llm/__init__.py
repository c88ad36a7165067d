"""Training-data pipeline operators.  Nothing else in the library imports this subpackage.

Functions of this subpackage that run on executors are sent by value, so a
cluster needs no copy of the repository on its workers.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
