"""leadloom: cleaning, matching, merging and counting sales leads on Spark."""

import sys

from pyspark import cloudpickle

# Python workers get the few UDF bodies by value, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
