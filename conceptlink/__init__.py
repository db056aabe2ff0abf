"""Relate documents to concepts through word vectors, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with them, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
