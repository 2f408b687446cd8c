"""Operators for preparing large text corpora, and the queries that apply them.

Functions of this subpackage that run in tasks travel there by value, so
executors need numpy, pandas and pyarrow, but no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
