"""timewise: time-aware tabular features, evaluation and scoring on Spark DataFrames.

Every fit is a distributed aggregation that returns a small state object;
every transform is a column projection (or a partitioned window) that
Catalyst can optimise and that works on batch and streaming frames alike.

Task functions of this package are pickled by value, so executors need the
public libraries only, not this package on their path.
"""
import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

cloudpickle.register_pickle_by_value(sys.modules[__name__])
