"""Training-data operators: each module is one operator, ``queries.py`` registers them.

Nothing outside this folder imports it. Functions that run in Python tasks are shipped by value,
so the executors need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
