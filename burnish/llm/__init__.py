"""Operators for preparing large training corpora; nothing else in the library needs them.

Functions that run in Python workers travel with the job, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
