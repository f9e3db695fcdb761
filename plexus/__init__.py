"""plexus: multimodal property graph, vector search and document processing on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# ship task functions by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
