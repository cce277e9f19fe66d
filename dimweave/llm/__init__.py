"""Training-data operators: quality, de-duplication, formatting, packing, mixing.

Nothing else in the library imports this package.  Worker functions are
shipped to the executors by value, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
