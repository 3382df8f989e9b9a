"""Training-data operators: the thirteen jobs a large text pipeline needs, each a Spark job.

Nothing outside this folder imports it. Functions of this package that run inside tasks are
pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
