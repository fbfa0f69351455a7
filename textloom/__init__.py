"""Web-text analytics on Spark: extraction, cleaning, keywords, ranked search."""

import sys

from pyspark import cloudpickle

# Send the package's functions to Python workers inside the task itself, so a
# cluster needs no copy of it installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
