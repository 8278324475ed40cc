"""Operators of a training-data pipeline over large text tables.

Task functions of this package are pickled by value, so executors need the
public libraries only, not this package on their path.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
