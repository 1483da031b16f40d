"""Operators for training data: decontamination, quality, duplicates, licences, mixing.

Nothing outside this package imports it. Functions that run in Python workers
travel by value, so the workers need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
