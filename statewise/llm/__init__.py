"""Training-data operators: one module per operator, their queries in ``queries``.

Functions of this subpackage travel by value with each job, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
