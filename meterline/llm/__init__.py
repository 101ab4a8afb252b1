"""Operators that prepare training text, with their queries.

Functions that run in Python workers are shipped with the job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
